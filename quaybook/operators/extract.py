"""Frames to events of known pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaybook.functions.ids import minted
from quaybook.sources.frames import from_topics, parsed


def each_event(read: DataFrame) -> DataFrame:
    """A row for each of a frame's events, as (pos, e).

    Of an inner explode Spark infers a filter, puts it below the parsers and reads each frame five times; of an outer one it doesn't.
    """
    rest = [c for c in read.columns if c != "events"]
    return read.select(*rest, F.posexplode_outer("events").alias("pos", "e")).where("pos IS NOT NULL")


def extracted(frames: DataFrame, pair_lookup: DataFrame) -> DataFrame:
    """A row for each event of a frame, with outcome: ok or why it is dropped.

    A frame without events leaves no row. An event without a lineage id is dropped before
    its market is looked at.
    """
    read = parsed(from_topics(frames))
    bad = F.col("outcome") != "ok"
    events = read.withColumn("events", F.when(bad, F.array(F.lit(None).cast("struct<market:string,type:string,sequence_id:bigint,sequence_jump:bigint,event_time:bigint,asks:array<struct<price:string,quantity:string>>,bids:array<struct<price:string,quantity:string>>>"))).otherwise(F.col("events")))
    rows = each_event(events.select("exchange_id", F.col("offset").alias("ord"), "simulation", "parent", "outcome", "events")).select("*", "e.*").drop("e")
    rows = rows.join(pair_lookup, ["exchange_id", "market"], "left")
    outcome = F.when(F.col("outcome") != "ok", F.col("outcome")).when(F.col("parent").isNull(), "no_id").when(F.col("pair_id").isNull(), "unknown_market").otherwise("ok")
    return rows.withColumn("outcome", outcome)


def events(rows: DataFrame) -> DataFrame:
    """The ok rows of extracted() as raw events."""
    return rows.where("outcome = 'ok'").select(
        "exchange_id", "pair_id", "ord", "pos", "type", "simulation", minted("extract", F.col("exchange_id"), F.col("ord"), F.col("pos")).alias("id"), F.array("parent").alias("source_ids"),
        "sequence_id", "sequence_jump", "event_time", "asks", "bids",
    )


def drop_counters(rows: DataFrame) -> DataFrame:
    """(exchange_id, outcome, n) of what was dropped."""
    return rows.where("outcome <> 'ok'").groupBy("exchange_id", "outcome").agg(F.count("*").alias("n"))
