"""One stream to many topics: what the sequence rules say goes to a topic for each record.

A micro-batch is written sink by sink. Each write is an append to the log under the sink's name and the number of the
micro-batch, so a micro-batch that comes again after a failure between two sinks adds what is
missing and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quaybook.functions.ids import pair_key, stage_topic
from quaybook.operators import validate
from quaybook.schema import CONTROL_TOPIC, REJECTED_TOPIC
from quaybook.sources import io, topic_log

MARKET = ["exchange_id", "pair_id"]
#: A record of a topic: what it is keyed by, where it stood in its market, and all of it as JSON.
RECORD = "topic string, partition int, offset bigint, key string, ord bigint, id string, kind string, value string"
#: Bits of an offset that count within a micro-batch.
OFFSET_BITS = 32
Sink = Callable[[DataFrame], DataFrame]


def _market_topic(stage: str):  # noqa: ANN202
    return stage_topic(F.col("exchange_id"), F.col("pair_id"), stage)


def validated(judged: DataFrame) -> DataFrame:
    """Accepted events and resets, by market."""
    rows = validate.accepted(judged)
    return rows.select("*", _market_topic("type-validated-raw-flink").alias("topic"), F.when(F.col("type") == "reset", "reset").otherwise("event").alias("kind"))


def rejected(judged: DataFrame) -> DataFrame:
    """Dead letters, by market."""
    return validate.rejected(judged).select("*", _market_topic(REJECTED_TOPIC).alias("topic"), F.lit("rejected").alias("kind"))


def controls(judged: DataFrame) -> DataFrame:
    """Requests for snapshots, all in one topic."""
    return validate.controls(judged).select("*", F.lit(CONTROL_TOPIC).alias("topic"), F.lit("control").alias("kind"))


SINKS: dict[str, Sink] = {"validated": validated, "rejected": rejected, "controls": controls}


def records(rows: DataFrame, batch: int) -> DataFrame:
    """rows (topic, kind, ...) as records of the log: offsets rise with the micro-batch, in it with `ord`."""
    place = F.row_number().over(Window.partitionBy("topic").orderBy("ord", "exchange_id", "pair_id", "kind", "id")) - 1  # of one micro-batch, which is bounded
    value = F.to_json(F.struct(*(c for c in rows.columns if c not in ("topic", "kind", "ord"))))
    told = rows.select("topic", "exchange_id", "pair_id", "ord", "id", "kind", value.alias("value"))
    return told.select("topic", F.lit(0).alias("partition"), (F.lit(batch << OFFSET_BITS) + place).cast("long").alias("offset"), pair_key(F.col("exchange_id"), F.col("pair_id")).alias("key"), "ord", "id", "kind", "value")


def to_topics(judged: DataFrame, path: str, checkpoint: str, sinks: dict[str, Sink] | None = None) -> StreamingQuery:
    """A stream of verdicts to the log at `path`, which no other query writes under these sinks' names."""
    known = SINKS if sinks is None else sinks

    def write(rows: DataFrame, batch: int) -> None:
        rows.persist()
        try:
            for name, sink in known.items():
                topic_log.append(records(sink(rows), batch), path, f"{name}-{batch:012d}", together=True)
        finally:
            rows.unpersist()

    with io.few_states(judged.sparkSession):
        return judged.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint).start()
