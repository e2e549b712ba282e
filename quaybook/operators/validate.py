"""Sequence rules: one tagged row for each output of an event.

A market's order is cut into parts, and no task goes through more than one at a time. What a part
leaves behind depends on what it finds: so each is first walked from a guess, the parts'
entries are chained, and those that were walked from another entry than theirs are walked again.
Most parts leave the same behind whatever they find, as an accepted event settles the state; and where nothing in a
part can move a state, its summary tells so without a walk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from quaybook.functions.ids import minted, pair_key, restamped
from quaybook.functions.times import Clock, stamped
from quaybook.operators.steps import ACCEPTED, Part, Sequence
from quaybook.sources.io import landed

MARKET = ["exchange_id", "pair_id"]
#: Events of a part: at most twice as many.
PART = 1 << 21
_EVENT = ("type", "sequence_id", "sequence_jump", "event_time")
_STATE = pa.struct([("last", pa.int64()), ("awaiting", pa.bool_()), ("baseline_pending", pa.bool_()), ("last_time", pa.int64()), ("requested", pa.bool_())])
_STATE_SQL = "struct<last:bigint,awaiting:boolean,baseline_pending:boolean,last_time:bigint,requested:boolean>"
_WALKED = [("part", pa.int64()), ("entry", _STATE), ("exit", _STATE), ("top", pa.int64()), ("top_snapshot", pa.int64()), ("top_free", pa.int64()), ("least_jump", pa.int64())]
_WALKED_SQL = f"part bigint, entry {_STATE_SQL}, exit {_STATE_SQL}, top bigint, top_snapshot bigint, top_free bigint, least_jump bigint"


def _parted(events: DataFrame, entries: DataFrame | None = None) -> DataFrame:
    """Events of (…, _part) by market, part and order; with the entries of their parts if there are any."""
    if entries is not None:
        known = entries.select(*(F.col(c).alias(f"_{c}") for c in (*MARKET, "part")), F.col("entry").alias("_entry"))
        on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in MARKET]
        events = events.withColumn("_here", F.col("_part")).drop("_part").join(known, [*on, F.col("_here") == F.col("_part")]).drop("_here", *(f"_{c}" for c in MARKET))
    return events.repartition(*MARKET, "_part").sortWithinPartitions(*MARKET, "_part", "_order")


def _listed(column: pa.Array) -> list:
    """column.to_pylist(); of whole numbers and text by way of numpy, which takes a tenth of the time."""
    if not (pa.types.is_integer(column.type) or pa.types.is_string(column.type)):
        return column.to_pylist()
    if pa.types.is_integer(column.type) and column.null_count:
        out = column.fill_null(0).to_numpy(zero_copy_only=False).tolist()
        for i in column.is_null().to_numpy(zero_copy_only=False).nonzero()[0].tolist():
            out[i] = None
        return out
    return column.to_numpy(zero_copy_only=False).tolist()


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(exchange, pair, part, type, sequence, jump, time) of a batch's events."""
    return zip(*(_listed(batch.column(c)) for c in (*MARKET, "_part", *_EVENT)), strict=True)


def _walks(batches: Iterator[pa.RecordBatch], keys: list[pa.Field]) -> Iterator[pa.RecordBatch]:
    """A row for each part: what it was entered with, what it leaves, and what could move a state."""
    names = [f.name for f in keys] + [n for n, _ in _WALKED]
    types = [f.type for f in keys] + [t for _, t in _WALKED]
    here, part = None, None

    def out() -> pa.RecordBatch:
        row = (*here, dict(zip(_STATE.names, part.entry, strict=True)), dict(zip(_STATE.names, astuple(part.state), strict=True)), part.top, part.top_snapshot, part.top_free, part.least_jump)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

    for batch in batches:
        entries = batch.column("_entry") if "_entry" in batch.schema.names else None
        for i, (exchange, pair, at, *event) in enumerate(_rows(batch)):
            if (exchange, pair, at) != here:
                if here is not None:
                    yield out()
                here = (exchange, pair, at)
                entry = entries[i].as_py() if entries is not None else None  # all of a part have the same
                part = Part(Sequence(**entry) if entry else Sequence.guessed(*event))
            part.step(*event)
    if here is not None:
        yield out()


def _chained(batches: Iterator[pa.RecordBatch], keys: list[pa.Field]) -> Iterator[pa.RecordBatch]:
    """(market, part, entry, known): of sorted walks, each part's entry, and whether it was walked from there or can't move it."""
    names, types = [*(f.name for f in keys), "part", "entry", "known"], [*(f.type for f in keys), pa.int64(), _STATE, pa.bool_()]
    here, state, rows = None, Sequence(), []

    def through(walks: list[dict]) -> tuple:
        nonlocal state
        entry = dict(zip(_STATE.names, astuple(state), strict=True))
        exits = [w["exit"] for w in walks if w["entry"] == entry]
        if exits:
            state = Sequence(**exits[0])
        elif passed := state.passing(*(walks[0][c] for c in ("top", "top_snapshot", "top_free", "least_jump"))):
            state = passed
        else:
            state = Sequence(**walks[-1]["exit"])  # most likely
            return (*here, entry, False)
        return (*here, entry, True)

    def emitted() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
        rows.clear()
        return made

    walks: list[dict] = []
    for batch in batches:
        for walk in batch.to_pylist():
            key = (walk["exchange_id"], walk["pair_id"], walk["part"])
            if key != here:
                if walks:
                    rows.append(through(walks))
                if here is None or key[:2] != here[:2]:
                    state = Sequence()
                here, walks = key, []
            walks.append(walk)
        if len(rows) > 10_000:
            yield emitted()
    if walks:
        rows.append(through(walks))
    if rows:
        yield emitted()


def entries(events: DataFrame) -> DataFrame:
    """(market, part, entry): the state in which the rules come to each part of events (…, _part, _order).

    Each round walks, side by side, the parts whose entry isn't settled. The first of a market
    always is after it, so the rounds end; only where every part leaves something else
    behind for another entry are they as many as parts.
    """
    slim = landed(events.select(*MARKET, "_part", "_order", *_EVENT), "order")
    arrow = [pa.field(f.name, pa.int64() if f.dataType.simpleString() == "bigint" else pa.int32()) for f in slim.select(*MARKET).schema]
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.select(*MARKET).schema)

    def walked(rows: DataFrame, number: int) -> DataFrame:
        found = rows.mapInArrow(lambda b: _walks(b, arrow), f"{keys}, {_WALKED_SQL}").withColumn("number", F.lit(number))
        return landed(found, "walks")

    walks, number = walked(_parted(slim), 0), 0
    while True:
        chained = landed(walks.repartition(*MARKET).sortWithinPartitions(*MARKET, "part", "number").mapInArrow(lambda b: _chained(b, arrow), f"{keys}, part bigint, entry {_STATE_SQL}, known boolean"), "chained")
        again = chained.where("NOT known")
        if again.isEmpty():
            return chained.drop("known")
        number += 1
        walks = walks.unionByName(walked(_parted(slim, again), number))


def _parts(events: DataFrame, order: str, part: int) -> DataFrame:
    """(market, _slice, _part): the slices of `part` places that a market's events are in, put together to parts by their numbers of events."""
    slices = events.groupBy(*MARKET, F.floor(F.col(order) / part).cast("long").alias("_slice")).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*MARKET).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return slices.select(*MARKET, "_slice", F.floor(F.coalesce(F.sum("_n").over(earlier), F.lit(0)) / part).cast("long").alias("_part"))


def verdicts(events: DataFrame, order: str = "ord", part: int = PART) -> DataFrame:
    """events with verdict (accepted, or the reason against it), request and reset. `order` numbers a market's events, each once.

    Parts are counted in events of their own market: where none has more than `part`, nothing is walked twice.
    """
    schema = StructType([*events.schema.fields, StructField("verdict", StringType()), StructField("request", BooleanType()), StructField("reset", BooleanType())])
    names = events.columns
    placed = events.withColumn("_order", F.col(order))
    parts = landed(_parts(events, order, part), "parts")
    many = not parts.where("_part > 0").isEmpty()
    if many:
        known = parts.select(*(F.col(c).alias(f"_{c}") for c in MARKET), "_slice", "_part")
        on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in MARKET]
        parted = placed.join(known, [*on, F.floor(F.col(order) / part) == F.col("_slice")]).drop("_slice", *(f"_{c}" for c in MARKET))
    else:
        parted = placed.withColumn("_part", F.lit(0).cast("long"))
    ready = _parted(parted, entries(parted) if many else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state = None, Sequence()
        for batch in batches:
            out = []
            for i, (exchange, pair, at, *event) in enumerate(_rows(batch)):
                if (exchange, pair, at) != here:
                    entry = batch.column("_entry")[i].as_py() if many else None
                    here, state = (exchange, pair, at), Sequence(**entry) if entry else Sequence()
                out.append(state.step(*event))
            verdict, request, reset = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(verdict, pa.string()), pa.array(request, pa.bool_()), pa.array(reset, pa.bool_())], names=[*names, "verdict", "request", "reset"])

    return ready.mapInArrow(run, schema)


def accepted(judged: DataFrame, clock: Clock | None = None) -> DataFrame:
    """What goes on: accepted events, restamped, and after a gap a reset with the gap as its parent.

    With a clock they are stamped; a reset has the stamps of this stage alone.
    """
    tags = F.when(F.col("verdict") == ACCEPTED, "event").when(F.col("reset"), "reset")
    rows = judged.withColumn("tag", tags).where("tag IS NOT NULL")
    is_reset = F.col("tag") == "reset"
    side = rows.schema["asks"].dataType
    rows = rows.withColumns({
        "type": F.when(is_reset, "reset").otherwise(F.col("type")), "sequence_id": F.when(~is_reset, F.col("sequence_id")), "sequence_jump": F.when(is_reset, 0).otherwise(F.col("sequence_jump")).cast("long"),
        "asks": F.when(is_reset, F.lit(None).cast(side)).otherwise(F.col("asks")), "bids": F.when(is_reset, F.lit(None).cast(side)).otherwise(F.col("bids")),
    })
    if clock:
        rows = stamped(rows, "type_validate", clock, fresh=is_reset)
    return restamped(rows, "validate", F.col("tag"), F.col("id")).drop("tag", "verdict", "request", "reset")


def dead_letters(rows: DataFrame, reason: str = "verdict", stage: str = "validate", clock: Clock | None = None) -> DataFrame:
    """Envelopes of rejected events: the event as it came, under an id of the envelope's own.

    With a clock the envelope has rejected_at, and the event the stamp of coming in, none of going out.
    """
    timed = {"validate": "type_validate"}.get(stage, stage)
    if clock:
        rows = stamped(rows, timed, clock, ("in",))
    names = [c for c in rows.columns if c not in ("verdict", "request", "reset", reason)]
    return rows.select(
        F.struct(*names).alias("event"), minted(stage, "rejected", F.col("id")).alias("id"), F.array("id").alias("source_ids"), F.col(reason).alias("reject_reason"), "exchange_id", "pair_id", "ord",
        *([clock(timed, "out").cast("long").alias("rejected_at")] if clock else []),
    )


def rejected(judged: DataFrame, clock: Clock | None = None) -> DataFrame:
    return dead_letters(judged.where(F.col("verdict") != ACCEPTED), clock=clock)


def controls(judged: DataFrame) -> DataFrame:
    """Requests for a snapshot, one for each gap or missing baseline, keyed by market."""
    return judged.where("request").select(
        F.lit("snapshot_request").alias("action"), "exchange_id", "pair_id", "simulation", minted("validate", "control", F.col("id")).alias("id"), F.array("id").alias("source_ids"), pair_key(F.col("exchange_id"), F.col("pair_id")).alias("key"), "ord",
    )
