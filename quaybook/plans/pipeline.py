"""The whole chain, frames to both cross-exchange views.

What several later steps read is written to the shared folder once, as topics would
hold it between jobs: no step computes the ones before it anew, and a lost executor costs
one step.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaybook.functions.times import Clock, now, stamped
from quaybook.operators import aggregate, book, extract, scale, validate
from quaybook.operators.intervals import running
from quaybook.sources.io import landed


@dataclass
class Views:
    """The outputs of the chain."""

    validated: DataFrame
    rejected: DataFrame
    controls: DataFrame
    snapshots: DataFrame
    union: Callable[[], DataFrame]

    @cached_property
    def unioned(self) -> DataFrame:
        """Planned at its first use: unions write steps of their own, which who reads snapshots alone doesn't need."""
        return self.union()

    @cached_property
    def merged(self) -> DataFrame:
        return aggregate.merged(self.unioned)


def from_events(events: DataFrame, factors: DataFrame, precisions: DataFrame, final_only: bool = False, clock: Clock = now) -> Views:
    """Every record carries the stamps of the stages that it has passed."""
    judged = landed(validate.verdicts(events), "judged")
    validated = validate.accepted(judged, clock)
    based = scale.rebased(validated, factors)
    scaled = stamped(based.where("reject IS NULL").drop("reject"), "rebase", clock)
    ready = landed(stamped(scale.precise(scaled, precisions), "precision", clock), "ready")
    snapshots = stamped(book.books(ready, final_only), "book_build", clock)

    def union() -> DataFrame:
        return aggregate.unioned(book.split(snapshots)) if final_only else aggregate.unions(ready)

    late = validate.dead_letters(based.where("reject IS NOT NULL"), "reject", "rebase", clock)
    rejected = validate.rejected(judged, clock).drop("event").unionByName(late.drop("event"))
    return Views(validated, rejected, validate.controls(judged), snapshots, union)


def numbered(events: DataFrame) -> DataFrame:
    """Events of (ord, pos) with a new ord: their number among all events, by offset, exchange and place in the frame, which may hold any number.

    No two have the same, so books of one pair have an order across exchanges.
    """
    return running(events, [], "ord", {"n": F.lit(1)}, then=("exchange_id", "pos")).withColumn("ord", F.col("n")).drop("pos", "n")


def from_frames(frames: DataFrame, pair_lookup: DataFrame, factors: DataFrame, precisions: DataFrame, final_only: bool = False, clock: Clock = now) -> Views:
    events = extract.events(extract.extracted(frames, pair_lookup))
    ordered = landed(stamped(numbered(events), "pair_extract", clock), "events")
    return from_events(ordered, factors, precisions, final_only, clock)
