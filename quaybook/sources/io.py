"""Where frames and records come from and go to: files, Kafka, Avro.

The Kafka and Avro connectors aren't part of every Spark: without them the functions
here say so, and the same plans read and write files of (topic, partition, offset, value).
"""

from __future__ import annotations

import re
import struct
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quaybook.schema import FRAME
from quaybook.sources import topic_log

RAW_PATTERN = "ex[0-9]+-raw"
#: Records of each topic in a micro-batch; all of them may be of one key.
TRIGGER_ROWS = 50_000
#: The same where a task lets go of a record before the next one, or keeps two numbers of it: more tasks read the micro-batch, none of them more. Each micro-batch costs seconds, whatever it holds.
PASSING_ROWS = 1_000_000
AGGREGATED_PATTERN = "^p[0-9]+-(asks|bids)$"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share; only a session on one machine that has none gets a local folder."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.getCheckpointDir() is None:
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quaybook-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def landed(df: DataFrame, name: str) -> DataFrame:
    """df as files in the shared folder, read again."""
    path = f"{shared_dir(df.sparkSession)}/landed/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def streamed(df: DataFrame, transform: Callable[[DataFrame], DataFrame], name: str, topic: Column, order: str = "ord", rows: int = TRIGGER_ROWS, like: DataFrame | None = None) -> DataFrame:
    """df as a log of topics by `order`, read as a stream of bounded micro-batches through `transform`, and its output read again.

    What is stepped through together has to be of one topic: topics are read side by side, each by its own offsets.
    `like` has the columns that topic and order are of, and about df's places, where df itself is costly.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/streamed/{name}-{uuid.uuid4().hex}"
    place = {"topic": topic, "partition": F.lit(0), "offset": F.col(order).cast("long")}
    if like is not None:
        like = like.select(*(c.alias(n) for n, c in place.items()))
    topic_log.append(df, f"{folder}/log", "all", min(rows, topic_log.SEGMENT_ROWS), like, derived=place)
    stream = topic_log.stream(spark, f"{folder}/log", df.withColumns(place).select(*df.columns).schema, f"{folder}/state", rows=rows)
    out = transform(stream)
    until_read(to_files(out, f"{folder}/out", f"{folder}/state", available_now=False))
    return spark.read.schema(out.schema).parquet(f"{folder}/out")


@contextmanager
def few_states(spark: SparkSession) -> Iterator[None]:
    """Streams that start in here have a state partition for each core, if the session has more shuffle partitions: each costs a task and a commit in every micro-batch, whatever it holds."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def until_read(query: StreamingQuery) -> None:
    """Wait until a query has read what is there, and stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def to_files(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream to Parquet, each row once; with available_now what is there is done and the query ends."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    with few_states(stream.sparkSession):
        return (writer.trigger(availableNow=True) if available_now else writer).start(path)


def _connector(spark: SparkSession, name: str) -> None:
    loader = spark._jvm.org.apache.spark.sql.execution.datasources.DataSource
    try:
        loader.lookupDataSource(name, spark._jsparkSession.sessionState().conf())
    except Exception as e:  # noqa: BLE001
        raise RuntimeError(f"Spark has no {name} connector here; start it with the spark-sql-kafka or spark-avro package, or read files") from e


def kafka_stream(spark: SparkSession, servers: str, pattern: str = RAW_PATTERN, starting: str = "latest") -> DataFrame:
    """Frames of all topics that match, as they come; `earliest` with an availableNow trigger replays until quiet."""
    _connector(spark, "kafka")
    rows = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribePattern", pattern).option("startingOffsets", starting).load()
    return rows.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"), F.unix_millis("timestamp").alias("processing_time"))


def file_stream(spark: SparkSession, path: str, schema: str = FRAME) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def write_topics(df: DataFrame, topic: Column, servers: str | None = None, path: str | None = None, key: Column | None = None) -> None:
    """Each record as JSON to a topic of its own: to Kafka, or to files partitioned by topic."""
    out = df.select(topic.alias("topic"), (key if key is not None else F.lit(None).cast("string")).alias("key"), F.to_json(F.struct("*")).alias("value"))
    if servers:
        _connector(df.sparkSession, "kafka")
        out.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    else:
        out.write.mode("append").partitionBy("topic").parquet(path)


def framed_schema_id(value: Column) -> Column:
    """Schema id of a record in registry framing (a zero byte, the id in four, the datum); null for others."""
    number = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")
    return F.when((F.octet_length(value) >= 5) & (F.hex(F.substring(value, 1, 1)) == "00"), number)


def framed_datum(value: Column) -> Column:
    return F.substring(value, 6, 1 << 30)


def frame(schema_id: int, datum: bytes) -> bytes:
    return struct.pack(">bI", 0, schema_id) + datum


def from_registry(records: DataFrame, schemas: dict[int, str]) -> DataFrame:
    """records with `record`: each known schema's datums decoded by it; others are skipped."""
    _connector(records.sparkSession, "avro")
    from pyspark.sql.avro.functions import from_avro

    if len(schemas) != 1:
        raise ValueError("one schema a frame: filter by framed_schema_id first")
    ((number, schema),) = schemas.items()
    return records.where(framed_schema_id(F.col("value")) == number).withColumn("record", from_avro(framed_datum(F.col("value")), schema))
