"""What is true just now: the newest books, held as state and read from outside; silent topics, by timers; lookups that change while a stream runs."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from quaybook.schema import EXCHANGE_BOOK
from quaybook.sources import io
from quaybook.sources.reference import Refreshing
from quaybook.streaming.market import on_rocks

VIEW = ["pair_id", "exchange_id", "side"]


class _Newest(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.book = handle.getValueState("book", "ord long, event_time long, levels string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        newest = max(((o, t, x) for pdf in rows for o, t, x in zip(pdf["ord"].tolist(), pdf["event_time"].tolist(), pdf["levels"].tolist(), strict=True)), key=lambda x: x[0])
        if not self.book.exists() or self.book.get()[0] <= newest[0]:
            self.book.update(newest)
            yield pd.DataFrame([(*key, *newest)], columns=[*VIEW, "ord", "event_time", "levels"])

    def close(self) -> None:
        pass


def _told(rows: DataFrame) -> DataFrame:
    return rows.withColumn("levels", F.from_json("levels", f"array<{EXCHANGE_BOOK}>"))


def _lasting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of what a task reads of a micro-batch the newest book of each view: no other can be that of the micro-batch."""
    found: dict[tuple, tuple[int, pa.RecordBatch]] = {}
    for batch in batches:
        here: dict[tuple, tuple[int, int]] = {}
        for i, (o, *key) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("ord", *VIEW)), strict=True)):
            key = tuple(key)
            if key not in here or here[key][0] < o:
                here[key] = (o, i)
        for key, (o, i) in here.items():
            if key not in found or found[key][0] < o:
                found[key] = (o, batch.take(pa.array([i])))  # a copy: the batch can go
    yield from (row for _, row in found.values())


def newest(books: DataFrame) -> DataFrame:
    """A stream of books (pair_id, exchange_id, side, ord, event_time, levels; exchange 0 is the union of all): of each micro-batch the newest one of each view, for serve.messages().

    The state holds the newest book of each view; held() reads it. All books are read, but only a task's newest of each view go on to the state.
    """
    on_rocks(books.sparkSession)
    read = books.select(*VIEW, "ord", "event_time", "levels")
    packed = read.mapInArrow(_lasting, read.schema).withColumn("levels", F.to_json("levels"))
    return _told(packed.groupBy(*VIEW).transformWithStateInPandas(_Newest(), "pair_id int, exchange_id int, side string, ord long, event_time long, levels string", "update", "none"))


def held(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """All newest books that a query over newest() knows, after its last micro-batch or after `batch`: what a client that selects gets first."""
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "book")
    state = (reader if batch is None else reader.option("batchId", batch)).load()
    return _told(state.select("key.*", "value.*"))


class _Silence(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "last long, threshold long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        parts = [pdf[["timestamp", "threshold"]].to_numpy(np.int64) for pdf in rows]
        if self.seen.exists():
            parts.insert(0, np.array([self.seen.get()], np.int64))
        heard = np.concatenate(parts)
        first = 1 if self.seen.exists() else 0  # what was known stands before all that comes
        heard[first:] = heard[first:][np.lexsort((heard[first:, 1], heard[first:, 0]))]
        before, now = heard[:-1], heard[1:, 0]
        since = before[:, 0] + before[:, 1] + 1
        ended = pd.DataFrame({"topic": key[0], "since": since, "recovered": now, "duration": now - since})[since <= now]
        last, threshold = heard[-1].tolist()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last + threshold + 1)
        self.seen.update((last, threshold))
        yield ended

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield pd.DataFrame([(*key, expiredTimerInfo.getExpiryTimeInMs())], columns=["topic", "since"]).assign(recovered=pd.array([None], "Int64"), duration=pd.array([None], "Int64"))

    def close(self) -> None:
        pass


def silences(records: DataFrame) -> DataFrame:
    """Episodes (topic, since, recovered, duration) of topics that say nothing for more than their threshold.

    records: (topic, timestamp, threshold) in milliseconds. An episode comes when it begins, with recovered null, by a timer and
    without a record, and again when the next record ends it; monitor.recorded() makes one row of both. What time it
    is, the newest record of any topic tells; a record that comes later than that is left out.
    """
    on_rocks(records.sparkSession)
    timed = records.select("topic", F.col("timestamp"), F.col("threshold").cast("long").alias("threshold"), F.timestamp_millis("timestamp").alias("at")).withWatermark("at", "0 seconds")
    return timed.groupBy("topic").transformWithStateInPandas(_Silence(), "topic string, since long, recovered long, duration long", "update", "eventTime")


def with_fresh(stream: DataFrame, lookup: Refreshing, use: Callable[[DataFrame, DataFrame], DataFrame], path: str, checkpoint: str, every: float = 60.0) -> StreamingQuery:
    """use(micro-batch, lookup) for each micro-batch, the lookup loaded again when it is `every` seconds old; a failed load keeps the last good rows.

    A micro-batch is written to a folder of its own, and once more to the same one if it comes again.
    """
    loaded = time.monotonic()

    def write(rows: DataFrame, batch: int) -> None:
        nonlocal loaded
        if time.monotonic() - loaded >= every:
            lookup.refresh()
            loaded = time.monotonic()
        use(rows, lookup.current).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    with io.few_states(stream.sparkSession):
        return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
