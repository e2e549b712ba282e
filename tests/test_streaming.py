"""Streams in several micro-batches give what batch gives: state is carried from one to the next, and over restarts."""

import json
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quaybook.operators import aggregate, book, validate
from quaybook.operators.steps import Book, Sequence, Union
from quaybook.sources import feed, io, topic_log
from quaybook.streaming import market, sinks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return feed.events(spark, SF).cache()


def logged(df, path, topic, parts=1, rows=60):
    """df as a log: appended in `parts`, by ord, in segments of `rows`; and a way to stream it."""
    records = df.withColumns({"topic": topic, "partition": F.lit(0), "offset": F.col("ord")})
    low, high = df.agg(F.min("ord"), F.max("ord")).first()
    step = (high - low) // parts + 1
    for i in range(parts):
        assert topic_log.append(records.where(F.col("ord").between(low + i * step, low + (i + 1) * step - 1)), path, f"part{i}", rows)
    return lambda checkpoint: topic_log.stream(df.sparkSession, path, records.schema, checkpoint, rows=rows).drop("topic", "partition", "offset")


def ran(stream, tmp, batches=3):
    query = io.to_files(stream, f"{tmp}/out", f"{tmp}/state", available_now=False)
    io.until_read(query)
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) >= batches
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{tmp}/out")


def same(got, want):
    columns = sorted(got.columns)
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))


def test_verdicts(spark, tmp_path, events):
    stream = logged(events, f"{tmp_path}/log", F.lit("all"))
    got = ran(market.verdicts(stream(f"{tmp_path}/state")), tmp_path)
    want = validate.verdicts(events)
    assert want.columns == got.columns
    same(got, want)


def test_a_restarted_query_goes_on_where_it_was(spark, tmp_path, events):
    """The log grows between runs; what has been read isn't read again."""
    records = events.withColumns({"topic": F.lit("all"), "partition": F.lit(0), "offset": F.col("ord")})
    cuts = [0, 300, 301, 650, 1 << 40]
    for i, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        topic_log.append(records.where(F.col("ord").between(low, high - 1)), f"{tmp_path}/log", f"part{i}", 70)
        stream = topic_log.stream(spark, f"{tmp_path}/log", records.schema, f"{tmp_path}/state", rows=70).drop("topic", "partition", "offset")
        io.until_read(io.to_files(market.verdicts(stream), f"{tmp_path}/out", f"{tmp_path}/state", available_now=False))
    want = validate.verdicts(events)
    same(spark.read.schema(want.schema).parquet(f"{tmp_path}/out"), want)


def test_books(spark, tmp_path, events):
    kept = validate.accepted(validate.verdicts(events)).cache()
    got = ran(market.books(logged(kept, f"{tmp_path}/log", F.lit("all"))(f"{tmp_path}/state")), tmp_path)
    same(got, book.books(kept).select(*got.columns))


@pytest.mark.parametrize("rows", [130, 250])
def test_chain(spark, tmp_path, events, rows):
    """Three stateful steps in one query, for different cuts into micro-batches."""
    stream = logged(events, f"{tmp_path}/log", F.concat(F.lit("p"), "pair_id"), rows=rows // 5)
    got = ran(market.chained(stream(f"{tmp_path}/state")), tmp_path)
    want = aggregate.unioned(book.split(book.books(validate.accepted(validate.verdicts(events)))))
    same(got.select("pair_id", "side", "ord", "event_time", "levels"), want.select("pair_id", "side", "ord", "event_time", "levels"))


def test_state_written_follows_changed_levels(spark, tmp_path):
    """A book of 3000 levels; then one level changes in each micro-batch: what is written doesn't grow with the book."""
    def event(i, kind, prices):
        levels = [(str(p), "1") for p in prices]
        return (1, 1, i, kind, 0, f"e{i}", ["s"], i, 1, i, levels, None)

    rows = [event(1, "snapshot", range(1, 3001)), *(event(i, "update", [i]) for i in range(2, 8))]
    schema = events_schema(spark)
    stream = logged(spark.createDataFrame(rows, schema), f"{tmp_path}/log", F.lit("all"), rows=1)
    query = io.to_files(market.books(stream(f"{tmp_path}/state")), f"{tmp_path}/out", f"{tmp_path}/state", available_now=False)
    io.until_read(query)
    puts = [p["stateOperators"][0]["customMetrics"]["rocksdbPutCount"] for p in query.recentProgress if p["numInputRows"]]
    assert puts[0] >= 3000
    assert len(puts) == 7
    assert max(puts[1:]) < 50


def events_schema(spark):
    return feed.events(spark, SF).schema


def test_a_replayed_batch_leaves_each_record_once(spark, tmp_path, events):
    """The job dies between two sinks, and again; what the topics hold in the end is what one run gives."""
    stream = logged(events, f"{tmp_path}/log", F.lit("all"), rows=300)
    failures = {1, 3}
    calls = []

    def failing(judged):
        calls.append(1)
        if len(calls) in failures:
            raise RuntimeError("lost")
        return sinks.rejected(judged)

    known = {"validated": sinks.validated, "rejected": failing, "controls": sinks.controls}
    for _ in range(3):
        query = sinks.to_topics(market.verdicts(stream(f"{tmp_path}/state")), f"{tmp_path}/out", f"{tmp_path}/state", known)
        try:
            io.until_read(query)
        except Exception as e:  # noqa: BLE001
            assert "lost" in str(e)
    got = topic_log.read(spark, f"{tmp_path}/out", sinks.RECORD)
    judged = validate.verdicts(events)
    want = None
    for sink in sinks.SINKS.values():
        rows = sink(judged).select("topic", "ord", "id", "kind")
        want = rows if want is None else want.unionByName(rows)
    same(got.select("topic", "ord", "id", "kind"), want)
    assert len(calls) >= 5
    assert got.count() == got.select("topic", "partition", "offset").distinct().count()
    by_topic = got.groupBy("topic").agg(F.sort_array(F.collect_list(F.struct("offset", "ord"))).alias("r")).select(F.transform("r", lambda x: x["ord"]).alias("o"))
    assert by_topic.where(F.col("o") != F.sort_array("o")).isEmpty()


def test_topics_by_name_and_start(spark, tmp_path):
    rows = spark.range(90).select(F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    path = f"{tmp_path}/log"
    assert topic_log.append(rows, path, "a", 10)
    assert not topic_log.append(rows, path, "a", 10)

    def seen(checkpoint, **options):
        out = []
        query = topic_log.stream(spark, path, rows.schema, f"{tmp_path}/{checkpoint}", **options).writeStream.foreachBatch(lambda df, _: out.append([tuple(r) for r in df.collect()])).option("checkpointLocation", f"{tmp_path}/{checkpoint}").start()
        io.until_read(query)
        return [b for b in out if b]

    assert sorted(r for b in seen("one", pattern="t1") for r in b) == [("t1", 0, i) for i in range(1, 90, 3)]
    batches = seen("two", pattern="t[02]", rows=10)
    assert max(len(b) for b in batches) <= 20
    assert len(batches) == 3
    assert seen("three", starting="latest") == []
    topic_log.append(rows.withColumn("offset", F.col("offset") + 100), path, "b", 10)
    assert sum(map(len, seen("one", pattern="t1"))) == 30
    assert topic_log.read(spark, path, rows.schema).count() == 180
    assert topic_log.read(spark, f"{tmp_path}/none", rows.schema).isEmpty()


@pytest.mark.parametrize(
    ("steps", "want"),
    [
        ([("update", 5, 1, 0)], [("no_baseline", True, False)]),
        ([("update", 5, 1, 0), ("update", 6, 1, 0)], [("no_baseline", True, False), ("no_baseline", False, False)]),
        ([("snapshot", 5, 1, 0), ("update", 6, 1, 1), ("update", 6, 1, 2)], [("accepted", False, False), ("accepted", False, False), ("stale_or_duplicate", False, False)]),
        ([("snapshot", 5, 1, 0), ("update", 8, 1, 1), ("update", 9, 1, 2), ("snapshot", 10, 1, 3)], [("accepted", False, False), ("sequence_gap", True, True), ("awaiting_snapshot", False, False), ("accepted", False, False)]),
        ([("snapshot", None, 0, 9), ("update", 77, 1, 10), ("update", 78, 1, 11)], [("accepted", False, False)] * 3),
        ([("snapshot", None, 0, 9), ("snapshot", None, 0, 8)], [("accepted", False, False), ("out_of_order", False, False)]),
        ([("snapshot", 5, 300, 0), ("update", 305, 300, 1)], [("accepted", False, False)] * 2),
    ],
)
def test_sequence_rules(steps, want):
    rules = Sequence()
    assert [rules.step(*s) for s in steps] == want


def test_book_steps():
    held = Book()
    held.step("snapshot", "a", [("2", "1"), ("10", "5")], [("1", "1"), ("1.5", "2")])
    assert held.sides() == ([("2", "1", "a"), ("10", "5", "a")], [("1.5", "2", "a"), ("1", "1", "a")])
    held.step("update", "b", [("2", "0"), ("3", "0")], None)
    assert held.sides()[0] == [("10", "5", "a")]
    held.step("snapshot", "c", None, [])
    assert held.sides() == ([("10", "5", "a")], [])
    held.step("reset", "d", None, None)
    assert held.sides() == ([], [])


def test_texts_of_books():
    """As sides() has them, also after a level has changed, gone and come again."""
    held = Book()
    for step in (("snapshot", 'a"', [("2", "1"), ("10", "5")], [("1", "1"), ("1.5", "2")]), ("update", "b", [("2", "0"), ("10", "6")], [("1.5", "2")]), ("update", "c", [("2", "3")], None), ("snapshot", "d", None, [("7", "7")])):
        held.step(*step)
        assert [[tuple(x.values()) for x in json.loads(t)] for t in held.texts()] == list(held.sides())


@pytest.mark.parametrize("side", ["asks", "bids"])
def test_views_share_their_levels(side):
    """They are what view() gives after each book, over several blocks; in a block a level stands once, however many views it lasts."""
    def level(e, i, price, quantity):
        return {"exchange_id": e, "simulation": i % 2, "source_id": f"b{i}", "price": price, "quantity": quantity}

    books = [{"exchange_id": i % 3, "ord": i, "snapshot_id": f"s{i}", "event_time": 1000 - i % 7, "levels": [] if i % 5 == 4 else [level(i % 3, i, str(i % 11 + k), str(k + 1)) for k in (9, 1, 10)]} for i in range(150)]
    plain, want = Union(), []
    for b in books:
        plain.step(str(b["exchange_id"]), b["event_time"], b["levels"])
        time, levels = plain.view(side)
        want.append((b["ord"], b["snapshot_id"], time, json.loads(levels)))
    steps = market._Unions()
    steps.union, steps.stepped = Union(), set()
    blocks = [r for frame in steps.made((1, side), [(b["ord"], "", json.dumps(b)) for b in books]) for r in frame.itertuples(index=False)]
    got = []
    for r in blocks:
        known = json.loads(r.levels)
        assert len(known) == len({json.dumps(x) for x in known})
        got += [(o, s, t, [known[j] for j in r.at[b : b + n]]) for o, s, t, b, n in zip(r.ord, r.snapshot_id, r.event_time, r.begin, r.size, strict=True)]
    assert got == want
    assert len(blocks) == 3 and steps.union.held == plain.held
    assert sum(len(json.loads(r.levels)) for r in blocks) < sum(len(w[3]) for w in want) / 2


def test_neighbours_travel_as_blocks():
    """A row for each run of a key, of no more than BLOCK_ROWS events and about BLOCK_CHARS characters; nothing is lost or turned round."""
    keys = [1] * 450 + [2, None, None, 1] + [3] * 5
    big = ["x" * 700_000 if k == 3 else f"e{i}" for i, k in enumerate(keys)]
    batch = pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(range(len(keys))), pa.array([""] * len(keys)), pa.array(big)], ["k", "ord", "event", "brief"])
    (out,) = market._blocks(iter([batch.slice(0, 0), batch]), ["k"])
    rows = out.to_pylist()
    assert [r["k"] for r in rows[:7]] == [1, 1, 1, 2, None, None, 1]
    assert len(rows) < 12
    assert max(len(r["ord"].split("\n")) for r in rows) == market.BLOCK_ROWS
    assert [int(o) for r in rows for o in r["ord"].split("\n")] == list(range(len(keys)))
    assert [b for r in rows for b in r["brief"].split("\n")] == big
    assert all(len(r["event"].split("\n")) == len(r["ord"].split("\n")) for r in rows)


def test_what_is_appended_is_reckoned_once(spark, tmp_path):
    """Records that are costly aren't computed again to deal them out; segments stay apart and of about so many records."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    plain = spark.range(0, 3000, 3).select(F.concat(F.lit("t"), (F.col("id") % 2).cast("string")).alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    topic_log.append(plain.mapInArrow(counted, plain.schema), f"{tmp_path}/log", "a", 50, plain)
    assert seen.value == 1000
    assert topic_log.read(spark, f"{tmp_path}/log", plain.schema).count() == 1000
    index = spark.read.parquet(f"{tmp_path}/log/index/a").orderBy("topic", "first").collect()
    assert max(r["n"] for r in index) <= 50 and len(index) <= 40
    assert all(x["topic"] != y["topic"] or x["last"] < y["first"] for x, y in zip(index, index[1:], strict=False))


def test_an_index_is_made_of_footers(spark, tmp_path):
    """It says what a scan of the segments says, of odd names, nulls and an empty append too; its plan reads no records and shuffles nothing."""
    topics = F.element_at(F.array(*map(F.lit, ("plain", "a b", "x%y", "c=d:e")), F.lit(None).cast("string")), (F.col("id") % 5 + 1).cast("int"))
    rows = spark.range(600).select(topics.alias("topic"), (F.col("id") % 2).cast("int").alias("partition"), (F.col("id") * 7 - 100).alias("offset"), F.col("id").cast("string").alias("value"))
    topic_log.append(rows, f"{tmp_path}/log", "a", 25)
    written = spark.read.schema(rows.schema).parquet(f"{tmp_path}/log/segments/a")
    below = F.substring_index("file", "/segments/", -1).alias("file")
    want = written.select(F.col("_metadata.file_path").alias("file"), *rows.columns).groupBy(below, "topic", "partition").agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.count("*").alias("n"))
    same(spark.read.parquet(f"{tmp_path}/log/index/a").withColumn("file", below), want)
    plan = topic_log._index(written)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FileScan" not in plan
    assert topic_log.append(rows.limit(0), f"{tmp_path}/log", "b") and spark.read.parquet(f"{tmp_path}/log/index/b").isEmpty()
    assert topic_log.read(spark, f"{tmp_path}/log", rows.schema).count() == 600


def test_books_share_their_levels():
    """After each event of several blocks they are what texts() gives; in a block a level stands once, however many books it lasts."""
    def said(i):
        return None if i % 7 == 3 else [{"p": str((i * 5) % 23 + k), "q": str((i + k) % 4)} for k in (9, 1, 10, 1)]

    events = [{"type": "reset" if i % 41 == 40 else "snapshot" if i % 53 == 0 else "update", "id": f"e{i}", "asks": said(i), "bids": said(i + 2)} for i in range(150)]
    plain, want = Book(), []
    for e in events:
        plain.step(e["type"], e["id"], *(None if e[s] is None else [(x["p"], x["q"]) for x in e[s]] for s in book.SIDES))
        want.append([json.loads(t) for t in plain.texts()])
    steps = market._Books()
    steps.book = Book()
    blocks = [r for frame in steps.made((1, None), [(i, "", json.dumps({**e, "event_time": i, "sequence_id": None if i % 2 else 1 << 60})) for i, e in enumerate(events)]) for r in frame.to_dict("records")]
    got = []
    for r in blocks:
        known = [json.loads(r[s]) for s in book.SIDES]
        assert all(len(x) == len({json.dumps(y) for y in x}) for x in known)
        for j in range(len(r["ord"])):
            at = [r[f"{s}_at"][r[f"{s}_begin"][j] :][: r[f"{s}_size"][j]] for s in book.SIDES]
            got.append([[x[i] for i in places] for x, places in zip(known, at, strict=True)])
    assert got == want
    assert [t for r in blocks for t in r["sequence_id"]] == [None if i % 2 else 1 << 60 for i in range(150)]
    assert len(blocks) == 3 and steps.book == plain
    assert sum(len(json.loads(r[s])) for r in blocks for s in book.SIDES) < sum(len(x) for w in want for x in w) / 2


def test_a_task_reads_many_small_topics(spark, tmp_path):
    """Tasks follow the records, not the topics: no more than SEGMENT_ROWS together, each record once, also where a micro-batch begins and ends inside segments."""
    rows = spark.range(300).select(F.concat(F.lit("t"), (F.col("id") % 30).cast("string")).alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.col("id").cast("string").alias("value"))
    topic_log.append(rows, f"{tmp_path}/log", "a")
    reader = topic_log.LogReader({"path": f"{tmp_path}/log", "startingoffsets": "earliest"}, rows.select("value").schema)
    start, end = {f"t{i}/0": 45 for i in range(5)}, {k: min(to, 280) for k, to in reader.latestOffset().items()}
    shares = reader.partitions(start, end)
    assert len(end) == 30 and len(shares) == 1
    got = [v for x in shares for b in reader.read(x) for v in b.column("value").to_pylist()]
    assert sorted(map(int, got)) == [i for i in range(280) if not (i % 30 < 5 and i < 45)]
    reader.known = {f"t{i}/0": [(0, 9, 9_000, "one"), (10, 19, 9_000, "two"), (20, 29, 15_000, "three")] for i in range(2)}
    assert [[file for file, _, _ in x.segments] for x in reader.partitions({}, dict.fromkeys(reader.known, 30))] == [["one", "two"], ["three"], ["one", "two"], ["three"]]


def test_a_column_of_an_event_travels_once(spark, tmp_path, events):
    """What goes to the state as key, place or for the rules isn't in the event's text; odd texts, nulls and types come back as they were."""
    odd = events.select(
        "exchange_id", F.col("pair_id").cast("long").alias("pair_id"), F.col("ord").cast("int").alias("ord"), "type",
        F.when(F.col("ord") % 7 == 0, F.lit('a\n"b"\\n\u2028')).otherwise(F.col("id")).alias("id"), "source_ids", (F.col("sequence_id") + F.lit(1 << 60)).alias("sequence_id"), "sequence_jump",
        F.col("event_time").cast("double").alias("event_time"), F.when(F.col("ord") % 5 == 0, F.lit("")).alias("note"), F.lit(None).cast("string").alias("none"), "asks",
    )
    plan = market.verdicts(events)._jdf.queryExecution().analyzed().toString()
    sent = re.search(r"to_json\(struct\((.*?)\), [^,]* AS event#", plan)[1]
    assert "source_ids" in sent and not any(f"{c}," in sent for c in ("exchange_id", "pair_id", "ord", "type", "sequence_id", "sequence_jump", "event_time"))
    got = ran(market.verdicts(logged(odd, f"{tmp_path}/log", F.lit("all"), rows=300)(f"{tmp_path}/state")), tmp_path)
    want = validate.verdicts(odd)
    assert got.schema.simpleString() == want.schema.simpleString()
    same(got, want)
    keyless = odd.withColumn("exchange_id", F.when(F.col("ord") % 13 != 0, F.col("exchange_id")))
    back = ran(market.verdicts(logged(keyless, f"{tmp_path}/keyless/log", F.lit("all"), rows=300)(f"{tmp_path}/keyless/state")), f"{tmp_path}/keyless")
    same(back.select(*odd.columns), keyless)


def test_derived_columns_are_not_dealt_out(spark, tmp_path):
    """Topic, partition and offset that follow from a record's columns are made again after the shuffle; the log is the same."""
    rows = spark.range(500).select((F.col("id") % 3).alias("market"), F.when(F.col("id") % 11 != 0, F.col("id") * 3).otherwise(F.col("id") * 3 + 1).alias("ord"), F.col("id").cast("string").alias("value"))
    place = {"topic": F.concat_ws("-", F.lit("m"), "market"), "partition": F.lit(0), "offset": F.col("ord")}
    whole = rows.withColumns(place)
    plan = topic_log._cut(rows, whole, 40, place)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    (dealt,) = [i for i, x in enumerate(plan) if "RepartitionByExpression" in x]
    assert "value#" in plan[dealt + 1] and "topic#" not in plan[dealt + 1] and "offset#" not in plan[dealt + 1]
    topic_log.append(rows, f"{tmp_path}/log", "a", 40, derived=place)
    topic_log.append(whole, f"{tmp_path}/plain", "a", 40)
    same(topic_log.read(spark, f"{tmp_path}/log", whole.schema), topic_log.read(spark, f"{tmp_path}/plain", whole.schema))
    a, b = (spark.read.parquet(f"{tmp_path}/{x}/index/a").drop("file") for x in ("log", "plain"))
    same(a, b)
