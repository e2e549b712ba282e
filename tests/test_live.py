"""The live view as of a micro-batch, silences by timers, and lookups that change, fail or are empty while a stream runs."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quaybook.operators import book, monitor, serve, validate
from quaybook.operators.quality import superseded_sources, walk
from quaybook.plans import queries
from quaybook.sources import feed, io, topic_log
from quaybook.sources.reference import Refreshing
from quaybook.streaming import live

SF = "/root/testdata/sf0.001"


def streamed(df, tmp, order, rows):
    records = df.withColumns({"log": F.lit("all"), "partition": F.lit(0), "offset": F.col(order)})
    records = records.withColumnRenamed("topic", "own").withColumnRenamed("log", "topic") if "topic" in df.columns else records.withColumnRenamed("log", "topic")
    topic_log.append(records, f"{tmp}/log", "all", rows)
    stream = topic_log.stream(df.sparkSession, f"{tmp}/log", records.schema, f"{tmp}/state", rows=rows).drop("topic", "partition", "offset")
    return stream.withColumnRenamed("own", "topic") if "topic" in df.columns else stream


def test_view_as_of_a_batch(spark, tmp_path):
    books = book.split(book.books(validate.accepted(validate.verdicts(feed.events(spark, SF))))).select(*live.VIEW, "ord", "event_time", "levels").where("side = 'asks'").cache()
    ends, told = [], []

    def see(rows, batch):
        told.append(rows.count())
        ends.append(rows.agg(F.max("ord")).first()[0])

    messages = serve.messages(live.newest(streamed(books, tmp_path, "ord", 150)))
    io.until_read(live.newest(streamed(books, f"{tmp_path}/b", "ord", 150)).writeStream.foreachBatch(see).outputMode("update").option("checkpointLocation", f"{tmp_path}/b/state").start())
    assert "value" in messages.columns
    assert len(ends) >= 3
    for batch in (0, 1, len(ends) - 1):
        got = live.held(spark, f"{tmp_path}/b/state", batch).orderBy(*live.VIEW).collect()
        want = serve.latest(books.where(F.col("ord") <= ends[batch])).select(got[0].__fields__).orderBy(*live.VIEW).collect()
        assert got == want
    chosen = live.held(spark, f"{tmp_path}/b/state")
    assert serve.selected(chosen, 2, 3).count() == 1
    assert max(told) <= chosen.count()


def test_a_task_sends_only_its_newest_books_to_the_state():
    """Whatever the batches and the order in them; the books that go on are copies."""
    rows = [(1, 0, "asks", o, o * 10, [{"price": str(o)}]) for o in (3, 9, 4)] + [(1, 2, "bids", o, None, []) for o in (7, 6)]
    table = pa.table({c: [r[i] for r in rows] for i, c in enumerate((*live.VIEW, "ord", "event_time", "levels"))})
    batches = table.to_batches(max_chunksize=2)
    assert len(batches) == 3
    got = [r for b in live._lasting(iter(batches)) for r in b.to_pylist()]
    assert [(r["exchange_id"], r["ord"], r["event_time"], r["levels"]) for r in got] == [(0, 9, 90, [{"price": "9"}]), (2, 7, None, [])]
    assert list(live._lasting(iter([]))) == []


def test_state_partitions_follow_the_cores(spark, tmp_path):
    """Not the session's shuffle partitions, which are as before when the stream has started."""
    books = spark.range(50).select((F.col("id") % 3).cast("int").alias("pair_id"), F.lit(1).alias("exchange_id"), F.lit("asks").alias("side"), F.col("id").alias("ord"), F.col("id").alias("event_time"), F.expr("array()").cast("array<struct<exchange_id:int,simulation:int,source_id:string,price:string,quantity:string>>").alias("levels"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        with io.few_states(spark):
            query = live.newest(streamed(books, tmp_path, "ord", 20)).writeStream.format("noop").outputMode("update").option("checkpointLocation", f"{tmp_path}/state").start()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
        io.until_read(query)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {p["stateOperators"][0]["numShufflePartitions"] for p in query.recentProgress if p["numInputRows"]} == {spark.sparkContext.defaultParallelism}
    assert sorted((r.pair_id, r.ord) for r in live.held(spark, f"{tmp_path}/state").collect()) == [(0, 48), (1, 49), (2, 47)]


def test_several_tasks_read_a_micro_batch(spark):
    """A log of one topic: its segments stay small whatever a micro-batch may hold."""
    rows = spark.range(50_000).select("id")
    stream, folder = queries._log_of(rows, "few", F.lit("all"), "id", io.PASSING_ROWS)
    index = spark.read.parquet(f"{folder}/in/index/all")
    assert index.agg(F.max("n")).first()[0] <= topic_log.SEGMENT_ROWS
    query = stream.writeStream.format("noop").option("checkpointLocation", f"{folder}/state").start()
    io.until_read(query)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [50_000]


class Known:
    """A value state and timers in memory."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, *_):  # noqa: N802
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def listTimers(self):  # noqa: N802
        return iter(self.timers)

    def deleteTimer(self, t):  # noqa: N802
        self.timers.remove(t)

    def registerTimer(self, t):  # noqa: N802
        self.timers.append(t)


def test_silences_of_many_records():
    """Half a million records of one topic, in frames and out of order: what ends is as one by one."""
    at = np.cumsum(np.random.default_rng(1).integers(0, 300, 500_000))
    frame = pd.DataFrame({"timestamp": at, "threshold": np.where(at % 2 == 0, 250, 100)})
    known = Known()
    steps = live._Silence()
    steps.init(known)
    got = []
    for part in (frame.iloc[:200_000], frame.iloc[200_000:]):
        mixed = part.sample(frac=1, random_state=2)
        got += [tuple(r) for out in steps.handleInputRows(("t",), iter([mixed.iloc[i::7] for i in range(7)]), None) for r in out.itertuples(index=False)]
    want, last = [], None
    for t, limit in sorted(zip(frame["timestamp"].tolist(), frame["threshold"].tolist(), strict=True)):
        if last is not None and t - sum(last) > 0:
            want.append(("t", sum(last) + 1, t, t - sum(last) - 1))
        last = (t, limit)
    assert got == want
    assert known.value == last and known.timers == [sum(last) + 1]
    assert steps.seen.get() == last


def test_silences(spark, tmp_path):
    """a falls silent twice and comes back once; b never; c is heard once, long before the end."""
    heard = [("a", 0), ("a", 100), ("a", 1000), ("b", 50), ("c", 60), *(("b", t) for t in range(100, 3000, 90))]
    rows = spark.createDataFrame([(t, at, 200) for t, at in heard], "topic string, timestamp long, threshold int").withColumn("place", F.col("timestamp") * 10 + F.ascii("topic") % 10)
    out = live.silences(streamed(rows, tmp_path, "place", 3))
    told = []
    query = out.writeStream.foreachBatch(lambda df, _: told.extend(map(tuple, df.collect()))).outputMode("update").option("checkpointLocation", f"{tmp_path}/state").start()
    io.until_read(query)
    assert set(told) == {("a", 301, None, None), ("a", 301, 1000, 699), ("a", 1201, None, None), ("c", 261, None, None)}
    turns = spark.createDataFrame(told, out.schema)
    assert sorted(map(str, monitor.recorded(turns.limit(0), turns).collect())) == sorted(map(str, spark.createDataFrame([("a", 301, 1000, 699), ("a", 1201, None, None), ("c", 261, None, None)], out.schema).collect()))


def test_lookups_change_fail_and_are_empty(spark, tmp_path):
    answers = iter([{"x": 1}, {"x": 2}, RuntimeError("database is down"), {}, {"x": 3}])

    def load():
        now = next(answers)
        if isinstance(now, Exception):
            raise now
        return spark.createDataFrame(list(now.items()), "k string, v int")

    lookup = Refreshing(load, keep_if_empty=True)
    assert lookup.current.first().v == 1
    rows = spark.range(40).select("id", F.lit("x").alias("k"))
    query = live.with_fresh(streamed(rows, tmp_path, "id", 10), lookup, lambda df, known: df.join(known, "k", "left"), f"{tmp_path}/out", f"{tmp_path}/state", every=0)
    io.until_read(query)
    got = spark.read.parquet(f"{tmp_path}/out").groupBy("batch").agg(F.collect_set("v").alias("v"), F.count("*").alias("n")).orderBy("batch").collect()
    assert [(r.v, r.n) for r in got] == [([2], 10), ([2], 10), ([2], 10), ([3], 10)]


def test_first_load_fails_fast(spark):
    def load():
        raise RuntimeError("no database")

    with pytest.raises(RuntimeError, match="no database"):
        Refreshing(load)
    gone = iter([spark.createDataFrame([("x", 1)], "k string, v int"), spark.createDataFrame([], "k string, v int")])
    assert Refreshing(lambda: next(gone)).refresh().isEmpty()


def test_lineage_walk(spark):
    edges = spark.createDataFrame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("c", "z"), ("q", "r")], "child string, parent string")
    starts = spark.createDataFrame([("d",), ("b",), ("lone",), ("d",)], "id string")
    got = sorted(map(tuple, walk(starts, edges).collect()))
    assert got == [("b", "a", 1), ("d", "a", 2), ("d", "z", 2), ("lone", "lone", 0)]
    assert walk(starts.limit(0), edges).isEmpty()
    circle = spark.createDataFrame([("a", "b"), ("b", "a")], "child string, parent string")
    with pytest.raises(ValueError, match="hops"):
        walk(spark.createDataFrame([("a",)], "id string"), circle, most=3)


def test_superseded_sources(spark):
    snapshots = spark.createDataFrame([(1, 1, 5, "old"), (1, 1, 9, "new"), (1, 2, 7, "other")], "pair_id int, exchange_id int, ord long, id string")
    view = spark.createDataFrame([(1, "asks", [(1, "10", "new"), (1, "11", "old"), (2, "10", "other"), (3, "10", "none")])], "pair_id int, side string, levels array<struct<exchange_id:int,price:string,source_id:string>>")
    assert sorted(r.source for r in superseded_sources(view, snapshots).collect()) == ["none", "old"]
