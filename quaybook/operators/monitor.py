"""Topics: what is provisioned, what is watched, what is stale and since when."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaybook.functions.ids import side_topic, stage_topic
from quaybook.schema import CONTROL_TOPIC, REJECTED_TOPIC, STAGE_TOPICS

HOUR = 3_600_000
RAW_KEPT, INPUT_KEPT, OUTPUT_KEPT = 168 * HOUR, HOUR, 6 * HOUR


def topic_plan(provisioned: DataFrame) -> DataFrame:
    """(topic, retention_ms) of all topics that the pairs (exchange_id, pair_id) need."""
    pairs = provisioned.select("exchange_id", "pair_id").distinct()
    stages = pairs.select(F.explode(F.array(*(stage_topic(F.col("exchange_id"), F.col("pair_id"), s) for s in (*STAGE_TOPICS, REJECTED_TOPIC)))).alias("topic"), F.lit(INPUT_KEPT).alias("retention_ms"))
    raw = pairs.select("exchange_id").distinct().select(F.format_string("ex%d-raw", "exchange_id").alias("topic"), F.lit(RAW_KEPT).alias("retention_ms"))
    views = F.array(*(side_topic(F.col("pair_id"), F.lit(s), m) for s in ("asks", "bids") for m in (False, True)))
    out = pairs.select("pair_id").distinct().select(F.explode(views).alias("topic"), F.lit(OUTPUT_KEPT).alias("retention_ms"))
    control = pairs.sparkSession.createDataFrame([(CONTROL_TOPIC, HOUR)], "topic string, retention_ms int")
    return reduce(DataFrame.unionByName, (stages, raw, out, control)).select("topic", F.when(F.col("topic").endswith(REJECTED_TOPIC), RAW_KEPT).when(F.col("topic").endswith("-raw-flink"), INPUT_KEPT).otherwise(F.col("retention_ms")).cast("long").alias("retention_ms"))


def watch_list(subscribed: DataFrame, manual: DataFrame | None = None, source: str = "both", default: int = 60, output: int = 10) -> DataFrame:
    """(topic, threshold): stage topics of subscribed pairs and their views; manual entries win.

    source is db, config or both; anything else counts as both. Dead letters are never watched.
    """
    source = source if source in ("db", "config") else "both"
    row = F.coalesce(F.col("threshold"), F.lit(default))
    stages = subscribed.select(F.explode(F.array(*(stage_topic(F.col("exchange_id"), F.col("pair_id"), s) for s in STAGE_TOPICS))).alias("topic"), row.cast("int").alias("threshold"))
    views = subscribed.select("pair_id").distinct().select(F.explode(F.array(*(side_topic(F.col("pair_id"), F.lit(s)) for s in ("asks", "bids")))).alias("topic"), F.lit(output).alias("threshold"))
    derived = stages.unionByName(views).groupBy("topic").agg(F.max("threshold").alias("threshold"))
    if source == "db" or manual is None:
        return derived if source != "config" else derived.limit(0)
    by_hand = manual.select("topic", F.col("threshold").alias("manual"))
    if source == "config":
        return by_hand.select("topic", F.col("manual").alias("threshold"))
    return derived.join(by_hand, "topic", "full").select("topic", F.coalesce("manual", "threshold").alias("threshold"))


def dropped(known: DataFrame, current: DataFrame) -> DataFrame:
    """Topics no longer watched."""
    return known.join(current.select("topic"), "topic", "left_anti")


def last_seen(records: DataFrame) -> DataFrame:
    """(topic, last_ts): the newest record of a topic, from the last one of each partition."""
    ends = records.groupBy("topic", "partition").agg(F.max_by("timestamp", "offset").alias("ts"))
    return ends.groupBy("topic").agg(F.max("ts").alias("last_ts"))


def staleness(watched: DataFrame, seen: DataFrame, now: int) -> DataFrame:
    """(topic, threshold, last_ts, seconds, stale): stale strictly beyond the threshold, or without data (-1 seconds)."""
    seconds = (F.lit(now) - F.col("last_ts")) / 1000
    out = watched.join(seen, "topic", "left")
    return out.select("topic", "threshold", F.coalesce("last_ts", F.lit(0)).alias("last_ts"), F.coalesce(seconds, F.lit(-1.0)).alias("seconds"), F.coalesce((seconds > F.col("threshold")).cast("int"), F.lit(1)).alias("stale"))


def episodes(polls: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """(topic, since, recovered, duration) from polls (topic, now, stale): gaps and islands.

    An episode lasts from the first stale poll to the next healthy one; recovered and
    duration are null while it lasts. A topic in `removed` (topic, at) closes then; an
    episode that begins after that isn't touched.
    """
    by_topic = Window.partitionBy("topic").orderBy("now")
    marked = polls.withColumn("was", F.lag("stale", 1, 0).over(by_topic)).where("stale <> was")
    turns = marked.withColumn("recovered", F.lead("now").over(by_topic)).where("stale = 1").select("topic", F.col("now").alias("since"), "recovered")
    if removed is not None:
        turns = turns.join(removed, "topic", "left").withColumn("recovered", F.coalesce("recovered", F.when(F.col("at") >= F.col("since"), F.col("at")))).drop("at")
    return turns.withColumn("duration", F.col("recovered") - F.col("since"))


def open_episodes(history: DataFrame) -> DataFrame:
    """The newest open episode of each topic, as it is taken up after a restart."""
    return history.where("recovered IS NULL").groupBy("topic").agg(F.max("since").alias("since"))


def resumed(polls: DataFrame, history: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """episodes() of polls after a restart: open episodes of the history go on from where they began."""
    begun = open_episodes(history).select("topic", F.col("since").alias("now"), F.lit(1).alias("stale"))
    return episodes(polls.select("topic", "now", "stale").unionByName(begun), removed)


def recorded(history: DataFrame, turns: DataFrame) -> DataFrame:
    """The history (topic, since, recovered, duration) after an upsert of turns: a row for each topic and beginning.

    An end that is known stays; so turns that are recorded again, after a lost run, change nothing.
    """
    both = history.select(*turns.columns).unionByName(turns)
    return both.groupBy("topic", "since").agg(F.min("recovered").alias("recovered"), F.min("duration").alias("duration"))


def metrics(polls: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for each topic: the last poll's gauges, those of its episodes, and two counters.

    polls: (topic, now, stale, threshold, last_ts), turns: their episodes(). stale_seconds
    gives an interval between two polls to the state that it began in. 0 stands for
    none, -1 for seconds since a record where there was none. Times are in milliseconds.
    """
    before = Window.partitionBy("topic").orderBy("now")
    spent = polls.withColumn("spent", F.when(F.lag("stale").over(before) == 1, F.col("now") - F.lag("now").over(before)))
    last = spent.groupBy("topic").agg(F.max_by(F.struct("now", "stale", "threshold", "last_ts"), "now").alias("poll"), F.coalesce(F.sum("spent") / 1000, F.lit(0.0)).alias("stale_seconds")).select("topic", "poll.*", "stale_seconds")
    ended = turns.groupBy("topic").agg(
        F.count("*").alias("episodes"), F.max(F.when(F.col("recovered").isNull(), F.col("since"))).alias("stale_since"), F.max("recovered").alias("last_recovery"),
        (F.max_by("duration", "recovered") / 1000).alias("last_stale_seconds"),
    )
    out = last.join(ended, "topic", "left")
    seconds = F.when(F.col("last_ts") > 0, (F.col("now") - F.col("last_ts")) / 1000).otherwise(-1.0)
    gauges = [F.coalesce(c, F.lit(0)).alias(c) for c in ("stale_since", "last_recovery")]
    return out.select("topic", seconds.alias("seconds_since"), "stale", "threshold", "last_ts", *gauges, F.coalesce("last_stale_seconds", F.lit(0.0)).alias("last_stale_seconds"), F.coalesce("episodes", F.lit(0)).alias("episodes"), "stale_seconds")


def subscriptions(rows: DataFrame, reverse: bool = False) -> DataFrame:
    """(exchange, market, action) to send; `disable` and incomplete rows are left out, reverse swaps the actions."""
    complete = rows.where("trim(exchange) <> '' AND trim(market) <> '' AND trim(action) <> ''").select(*(F.trim(c).alias(c) for c in ("exchange", "market", "action"))).where("action <> 'disable'")
    if reverse:
        return complete.withColumn("action", F.when(F.col("action") == "subscribe", "unsubscribe").otherwise("subscribe"))
    return complete
