"""The registered queries of the order-book engine.

Results are flat: a side is written as price@quantity joined by commas, null if the event
says nothing about it, so that they compare with an SQL engine's.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaybook.functions import exact, times
from quaybook.functions.times import stamped
from quaybook.operators import aggregate, book, extract, monitor, quality, scale, serve, validate
from quaybook.plans import pipeline
from quaybook.schema import STAGES
from quaybook.sources import avro, feed, io, reference, topic_log
from quaybook.sources.frames import PARSERS, from_topics, parsed
from quaybook.streaming import market as streaming
from quaybook.streaming import live, sinks

MARKET = ["exchange_id", "pair_id"]
NOW = 1_706_000_000_000
#: In places of the feed: where the history's second run begins, and when topics are dropped.
HISTORY_CUT, HISTORY_END = 700, 10**12


def written(levels: str | Column, *fields: str) -> Column:
    fields = fields or ("price", "quantity")
    return F.array_join(F.transform(levels, lambda x: F.concat_ws("@", *(x[f].cast("string") for f in fields))), ",")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.verdicts(feed.events(spark, sf_dir))


def _books(spark: SparkSession, sf_dir: str, final_only: bool = False) -> DataFrame:
    return book.books(validate.accepted(_judged(spark, sf_dir)), final_only)


def _unioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.unions(validate.accepted(_judged(spark, sf_dir)))


def _last_union(books: DataFrame) -> DataFrame:
    """The last union of each pair, of each exchange's last book: earlier ones don't reach it."""
    return serve.latest(aggregate.unioned(book.split(books)))


def scan_topic_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_topics(feed.topics(spark, sf_dir)).groupBy("exchange_id").agg(F.count("*").alias("n"))


def parse(exchange: int):  # noqa: ANN201
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = parsed(from_topics(feed.frames(spark, sf_dir))).where(F.col("exchange_id") == exchange)
        rows = extract.each_event(rows.select("offset", "simulation", "parent", "events")).select("*", "e.*")
        return rows.select("offset", F.col("pos").cast("long").alias("pos"), "market", "type", "simulation", "parent", "sequence_id", "sequence_jump", "event_time", written("asks").alias("asks"), written("bids").alias("bids"))

    return query


def _extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extracted(feed.frames(spark, sf_dir), reference.pair_lookup(feed.exchange_markets(spark, sf_dir)))


def extract_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.events(_extracted(spark, sf_dir)).select("exchange_id", "pair_id", "ord", F.col("pos").cast("long").alias("pos"), "id", F.get("source_ids", 0).alias("parent"))


def drop_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.drop_counters(_extracted(spark, sf_dir))


def canonical_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.when(F.col("l_linenumber") % 2 == 0, "-00").otherwise("+0"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("0"))
    zero = F.when(F.col("l_orderkey") % 5 == 0, "-0.00").otherwise(raw)
    item = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return item.select("l_orderkey", F.col("l_linenumber").cast("long").alias("line"), exact.canonical(zero).alias("canonical"))


def _based(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scale.rebased(feed.levels(spark, sf_dir), reference.rebase_lookup(feed.exchange_markets(spark, sf_dir)))


def _level_rows(events: DataFrame) -> DataFrame:
    side = F.explode(F.array(F.struct(F.lit("asks").alias("side"), F.col("asks").alias("levels")), F.struct(F.lit("bids").alias("side"), F.col("bids").alias("levels"))))
    return events.select("ord", side.alias("s")).select("ord", "s.side", F.posexplode("s.levels").alias("pos", "level")).select("ord", "side", F.col("pos").cast("long").alias("pos"), "level.price", "level.quantity")


def rebase_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _level_rows(_based(spark, sf_dir).where("reject IS NULL"))


def rebase_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = validate.dead_letters(_based(spark, sf_dir).where("reject IS NOT NULL"), "reject", "rebase")
    return late.select("ord", "exchange_id", "pair_id", "reject_reason", F.get("source_ids", 0).alias("parent"), F.col("event.id").alias("event_id"))


def precision_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _level_rows(scale.precise(feed.levels(spark, sf_dir), reference.precision_lookup(feed.markets(spark, sf_dir))))


def null_vs_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scale.precise(scale.rebased(feed.levels(spark, sf_dir), reference.rebase_lookup(feed.exchange_markets(spark, sf_dir))).drop("reject"), reference.precision_lookup(feed.markets(spark, sf_dir)))
    return out.select(F.col("asks").isNull().alias("no_asks"), F.col("bids").isNull().alias("no_bids"), (F.size("asks") == 0).alias("empty_asks")).groupBy("no_asks", "no_bids", "empty_asks").agg(F.count("*").alias("n"))


def validate_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select(*MARKET, "ord", "verdict", "request", "reset")


def validate_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.rejected(_judged(spark, sf_dir)).select(*MARKET, "ord", "reject_reason", "id", F.get("source_ids", 0).alias("parent"), F.col("event.sequence_id").alias("sequence_id"))


def validate_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.controls(_judged(spark, sf_dir)).select("action", *MARKET, "simulation", "id", F.get("source_ids", 0).alias("parent"), "key", "ord")


def validate_resets(spark: SparkSession, sf_dir: str) -> DataFrame:
    resets = validate.accepted(_judged(spark, sf_dir)).where("type = 'reset'")
    return resets.select(*MARKET, "ord", "id", F.get("source_ids", 0).alias("parent"), "sequence_jump", "event_time", "simulation", F.col("asks").isNull().alias("no_asks"))


def _flat_books(books: DataFrame) -> DataFrame:
    fields = ("price", "quantity", "source_id")
    return books.select(*MARKET, "ord", "id", "trigger_id", "event_time", "last_sequence_id", written("asks", *fields).alias("asks"), written("bids", *fields).alias("bids"))


def book_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_books(_books(spark, sf_dir))


def book_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_books(_books(spark, sf_dir, final_only=True))


def _traced(judged: DataFrame) -> DataFrame:
    """Every book as the lineage rules read it: ids, and of its levels the sources."""
    books = book.books(validate.accepted(judged))
    sources = {s: F.transform(s, lambda x: F.struct(x["source_id"].alias("source_id"))) for s in ("asks", "bids")}
    return io.landed(books.select(*MARKET, "ord", "id", "trigger_id", *(c.alias(s) for s, c in sources.items())), "books")


def book_lineage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = io.landed(_judged(spark, sf_dir), "judged")
    books = _traced(judged)
    checks = {"bad_ids": quality.bad_ids(books), "bad_triggers": quality.bad_ids(books, "trigger_id"), "foreign_levels": quality.foreign_levels(books), "bad_controls": quality.bad_controls(validate.controls(judged))}
    out = None
    for name, bad in checks.items():
        row = bad.agg(F.count("*").alias("n")).select(F.lit(name).alias("rule"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def split_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.split(_books(spark, sf_dir)).select("pair_id", "side", "exchange_id", "ord", "event_time", written("levels", "exchange_id", "simulation", "price", "quantity").alias("levels"))


def aggregate_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unioned(spark, sf_dir).select("pair_id", "side", "ord", "event_time", written("levels", "exchange_id", "simulation", "price", "quantity").alias("levels"))


def merge_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = aggregate.merges(validate.accepted(_judged(spark, sf_dir)))
    return out.select("pair_id", "side", "ord", "event_time", F.array_join(F.transform("levels", lambda x: F.concat_ws("@", x["simulation"].cast("string"), F.array_join(x["exchange_ids"].cast("array<string>"), "+"), x["price"], x["quantity"])), ",").alias("levels"))


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = serve.latest(book.split(_books(spark, sf_dir, final_only=True), keep_source=True))
    catalog = reference.market_catalog(feed.markets(spark, sf_dir), feed.currencies(spark))
    return serve.named(last, catalog, feed.exchanges(spark, sf_dir))


def book_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir).select("pair_id", "exchange_id", "side", "base", "quote", "exchange", written("levels", "exchange", "price", "quantity").alias("levels"))


def top_of_book_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.top(_books(spark, sf_dir))


def display_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last books as displays write them: asks from the highest, all prices of a book with as many places."""
    shown = serve.display(_books(spark, sf_dir, final_only=True))
    return shown.select(*MARKET, "ord", written("asks").alias("asks"), written("bids").alias("bids"))


def view_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages that clients get when they select: what stands in them, read back from their text."""
    told = serve.messages(serve.latest(book.split(_books(spark, sf_dir, final_only=True))), "select")
    fields = {"type": "$.type", "view_side": "$.side", "best": "$.levels[0].price", "best_quantity": "$.levels[0].quantity", "at": "$.event_time"}
    return told.select("pair_id", "exchange_id", *(F.get_json_object("value", path).alias(name) for name, path in fields.items()))


def latest_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _last_union(_books(spark, sf_dir, final_only=True)).select("pair_id", "exchange_id", "side", "ord", F.size("levels").cast("long").alias("n"))


def selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.selected(serve.latest(book.split(_books(spark, sf_dir, final_only=True))), 2, 3).select("pair_id", "exchange_id", "side", "ord", F.size("levels").cast("long").alias("n"))


def _staged(stage: str, way: str) -> Column:
    """A clock for the whole chain: ten milliseconds from stage to stage, five to seven in each."""
    late = F.col("event_time") + 10 * STAGES.index(stage) + F.col("ord") % 7
    return late + 5 + F.col("ord") % 3 if way == "out" else late


def latency_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the stamps that snapshots bring along from all stages; a reset has none of the first."""
    markets = feed.exchange_markets(spark, sf_dir)
    came = stamped(feed.events(spark, sf_dir), "pair_extract", _staged)
    views = pipeline.from_events(came, reference.rebase_lookup(markets), reference.precision_lookup(feed.markets(spark, sf_dir)), clock=_staged)
    timed = views.snapshots.select(*MARKET, "ord", "event_time", "timings.*")
    return serve.latencies(timed)


def _lineage(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The levels of the last unions, each with the snapshot that it names, and who comes from whom up to there."""
    judged = io.landed(_judged(spark, sf_dir), "judged")
    accepted = validate.accepted(judged)
    edges = quality.parents(judged).unionByName(quality.parents(accepted)).unionByName(book.triggers(accepted))
    last = _last_union(book.books(accepted, final_only=True))
    levels = last.select("pair_id", "side", F.explode("levels").alias("l")).select("pair_id", "side", "l.exchange_id", "l.price", F.col("l.source_id").alias("id"))
    return io.landed(levels, "levels"), edges


def lineage_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From each level of the last unions to the frame that it comes from, over snapshot, accepted and raw event."""
    levels, edges = _lineage(spark, sf_dir)
    found = quality.walk(levels.select("id"), edges)
    return levels.join(found, "id").select("pair_id", "side", "exchange_id", "price", "origin", F.col("hops").cast("long").alias("hops"))


def lineage_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels of the last unions whose way to a frame breaks off, where the raw events of every third place have lost their parents."""
    levels, edges = _lineage(spark, sf_dir)
    lost = F.startswith("parent", F.lit("f-")) & (F.substring("parent", 3, 20).try_cast("long") % 3 == 0)
    found = quality.walk(levels.select("id"), edges.where(~F.coalesce(lost, F.lit(False))))
    return levels.join(found.where(~F.startswith("origin", F.lit("f-"))), "id").select("pair_id", "side", "exchange_id", "price", F.col("hops").cast("long").alias("hops"))


def lineage_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the lineage rules find where ids, triggers, owners of levels and keys of requests have been spoilt."""
    judged = io.landed(_judged(spark, sf_dir), "judged")
    at = F.col("ord")
    gone = F.transform("asks", lambda x, i: F.when((at % 17 == 0) & (i == 0), x.withField("source_id", F.lit("gone"))).otherwise(x))
    books = _traced(judged).withColumns({"id": F.when(at % 11 == 0, F.concat(F.lit("bad-"), at.cast("string"))).otherwise(F.col("id")), "asks": gone})
    twice = books.unionByName(books.where(at % 19 == 0))
    controls = validate.controls(judged).withColumn("key", F.when(at % 3 == 0, F.lit("elsewhere")).otherwise(F.col("key")))
    found = {"bad_ids": quality.bad_ids(books), "bad_triggers": quality.bad_ids(twice, "trigger_id"), "foreign_levels": quality.foreign_levels(books), "bad_controls": quality.bad_controls(controls)}
    out = None
    for name, bad in found.items():
        row = bad.agg(F.count("*").alias("n")).select(F.lit(name).alias("rule"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def superseded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels of the last unions of the events at even places that name no last snapshot, when all snapshots count."""
    events = io.landed(validate.accepted(_judged(spark, sf_dir)), "accepted")
    even = events.where("ord % 2 = 0").groupBy(*MARKET).agg(F.max("ord").alias("_even"))
    before = events.join(F.broadcast(even), MARKET).where("ord <= _even").drop("_even")  # a row for each market
    return quality.superseded_sources(_last_union(book.books(before, final_only=True)), book.heads(events)).select("pair_id", "side", "exchange_id", "price")


def topic_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.topic_plan(reference.provisioned(feed.exchange_markets(spark, sf_dir), feed.markets(spark, sf_dir), feed.exchanges(spark, sf_dir)))


def _manual(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("ex1-raw", 30), ("p1-asks", 99)], "topic string, threshold int")


def _watched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.watch_list(reference.subscribed(feed.exchange_markets(spark, sf_dir), feed.markets(spark, sf_dir)), _manual(spark))


def watch_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _watched(spark, sf_dir)


def watch_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    fewer = reference.subscribed(feed.exchange_markets(spark, sf_dir).where("exchange_id <> 3"), feed.markets(spark, sf_dir))
    return monitor.dropped(_watched(spark, sf_dir), monitor.watch_list(fewer)).select("topic")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = feed.events(spark, sf_dir)
    topic = F.format_string("ex%d-p%d-raw-flink", "exchange_id", "pair_id")
    return e.select(topic.alias("topic"), (F.col("ord") % 2).cast("int").alias("partition"), F.col("ord").alias("offset"), F.col("event_time").alias("timestamp"))


def staleness_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.staleness(_watched(spark, sf_dir), monitor.last_seen(_records(spark, sf_dir)), NOW)


def _polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("topic", F.col("offset").alias("now"), (F.pmod("timestamp", F.lit(3)) == 0).cast("int").alias("stale"))


def staleness_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.episodes(_polls(spark, sf_dir))


def episode_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history table after two runs, the second recorded twice and with the topics of exchange 3 dropped at its end."""
    polls, cut = _polls(spark, sf_dir), F.col("now") < HISTORY_CUT
    gone = polls.where("topic LIKE 'ex3-%'").select("topic", F.lit(HISTORY_END).alias("at")).distinct()
    first = monitor.episodes(polls.where(cut))
    history = io.landed(monitor.recorded(first.limit(0), first), "history")
    turns = monitor.resumed(polls.where(~cut), history, gone)
    return monitor.recorded(monitor.recorded(history, turns), turns)


def staleness_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    polls = _polls(spark, sf_dir)
    timed = polls.withColumns({"threshold": F.lit(60), "last_ts": F.when(F.col("now") % 2 == 0, F.col("now") - 500).otherwise(F.lit(0))})
    return monitor.metrics(timed, monitor.episodes(polls))


def watch_list_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watch list by each of its modes; an unknown one counts as both, and without manual entries db and both are alike."""
    some = reference.subscribed(feed.exchange_markets(spark, sf_dir), feed.markets(spark, sf_dir))
    out = None
    for mode in ("db", "config", "both", "else"):
        one = monitor.watch_list(some, _manual(spark), mode).select(F.lit(mode).alias("mode"), "topic", "threshold")
        out = one if out is None else out.unionByName(one)
    return out


def _clock(stage: str, way: str) -> Column:
    return F.col("event_time") + 10 * STAGES.index(stage) + (5 if way == "out" else 0)


def stage_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps after the sequence rules: of accepted events, resets and dead letters."""
    judged = validate.verdicts(stamped(feed.events(spark, sf_dir), "pair_extract", _clock))

    def flat(rows: DataFrame, kind: str | Column, timings: str, at: Column) -> DataFrame:
        return rows.select(*MARKET, "ord", (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), *(F.col(f"{timings}.{s}_{way}") for s in STAGES[:3] for way in ("in", "out")), at.alias("rejected_at"))

    kept = validate.accepted(judged, _clock)
    late = validate.rejected(judged, _late)
    return flat(kept, F.when(F.col("type") == "reset", "reset").otherwise("event"), "timings", F.lit(None).cast("long")).unionByName(flat(late, "rejected", "event.timings", F.col("rejected_at")))


def _late(stage: str, way: str) -> Column:
    return F.col("ord") * 1000 + (1 if way == "out" else 0)


def rfc3339_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("ord") % 2 == 0, F.col("event_time") + F.col("ord") % 1000).otherwise(-F.col("ord") * 86_399_999)
    return feed.events(spark, sf_dir).select("ord", times.rfc3339(moved).alias("at"))


def stream_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a feed differs from itself with some ids changed and some records of exchange 3 gone."""
    want = feed.events(spark, sf_dir).select(*MARKET, "ord", "id")
    got = want.where("NOT (exchange_id = 3 AND ord % 101 = 0)").withColumn("id", F.when(F.col("ord") % 97 == 0, F.concat(F.col("id"), F.lit("x"))).otherwise(F.col("id")))
    return quality.differences(got, want, MARKET, "ord", ["id"]).select(*MARKET, "n", F.col("got.id").alias("got"), F.col("want.id").alias("want"))


def expected_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expected_union(_books(spark, sf_dir, final_only=True)).select(*MARKET, "side", written("levels", "exchange_id", "simulation", "price", "quantity").alias("levels"))


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    action = F.element_at(F.array(F.lit("subscribe"), F.lit("unsubscribe"), F.lit("disable"), F.lit(" "), F.lit("other")), (F.col("n_nationkey") % 5 + 1).cast("int"))
    return monitor.subscriptions(nation.select(F.concat(F.lit("e"), F.col("n_regionkey").cast("string")).alias("exchange"), F.col("n_name").alias("market"), action.alias("action")), reverse=True)


def market_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.market_catalog(feed.markets(spark, sf_dir), feed.currencies(spark))


def avro_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as framed Avro and back: those at even places by an older writer that knows no simulation, all read by one schema, whose default for it is 7."""
    events = feed.events(spark, sf_dir)
    older, newer = events.drop("simulation"), events
    schemas = {i: avro.schema_of(t.schema, "event") for i, t in ((1, older), (2, newer))}
    reader = json.loads(schemas[2])
    next(f for f in reader["fields"] if f["name"] == "simulation").update(type="int", default=7)
    sent = older.where("ord % 2 = 0").select(avro.framed(F.struct("*"), 1, schemas[1]).alias("value")).unionByName(newer.where("ord % 2 = 1").select(avro.framed(F.struct("*"), 2, schemas[2]).alias("value")))
    sent = io.landed(sent, "framed")  # as a topic would hold it: its ids and its records are read in turn
    back = avro.unframed(sent, avro.Registry(schemas.__getitem__), json.dumps(reader)).select("schema_id", "record.*")
    return back.select("schema_id", *MARKET, "ord", "type", "simulation", "id", "sequence_id", "event_time", written("asks").alias("asks"), written("bids").alias("bids"))


def full_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames to merged views, through every stage: the size of each pair's last view."""
    markets = feed.exchange_markets(spark, sf_dir)
    views = pipeline.from_frames(feed.frames(spark, sf_dir), reference.pair_lookup(markets), reference.rebase_lookup(markets), reference.precision_lookup(feed.markets(spark, sf_dir)), final_only=True)
    return serve.latest(views.merged).select("pair_id", "side", F.size("levels").cast("long").alias("n"), "event_time")


#: A market's events are of one topic; what a union steps through is of one, too.
def _topic(kind: str, *columns: str) -> Column:
    return F.concat_ws("-", F.lit(kind), *columns)


def stream_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """validate_verdicts by Structured Streaming, from a log of topics to files and back."""
    return io.streamed(feed.events(spark, sf_dir), streaming.verdicts, "stream-verdicts", _topic("market", *MARKET)).select(*MARKET, "ord", "verdict", "request", "reset")


def stream_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """book_events by Structured Streaming, from a log of topics to files and back."""
    return _flat_books(io.streamed(validate.accepted(_judged(spark, sf_dir)), streaming.books, "stream-books", _topic("market", *MARKET), like=feed.events(spark, sf_dir)))


def _flat_union(unioned: DataFrame) -> DataFrame:
    return unioned.select("pair_id", "side", "ord", "event_time", written("levels", "exchange_id", "simulation", "price", "quantity").alias("levels"))


def stream_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """aggregate_union by Structured Streaming, from a log of topics to files and back."""
    like = feed.events(spark, sf_dir).select("pair_id", "ord", F.explode(F.array(*map(F.lit, book.SIDES))).alias("side"))
    return _flat_union(io.streamed(book.split(_books(spark, sf_dir)), streaming.unioned, "stream-union", _topic("view", "pair_id", "side"), like=like))


def stream_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """aggregate_union from raw events by one streaming query: sequence rules, books and unions behind one another."""
    return _flat_union(io.streamed(feed.events(spark, sf_dir), streaming.chained, "stream-chain", _topic("pair", "pair_id")))


def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts as a stream, sent to the topics of their markets, dead letters and requests; what these topics then hold."""
    folder = f"{io.shared_dir(spark)}/streamed/fan-out-{uuid.uuid4().hex}"
    events = feed.events(spark, sf_dir).withColumns({"topic": _topic("market", *MARKET), "partition": F.lit(0), "offset": F.col("ord")})
    topic_log.append(events, f"{folder}/in", "all")
    stream = topic_log.stream(spark, f"{folder}/in", events.schema, f"{folder}/state")
    io.until_read(sinks.to_topics(streaming.verdicts(stream.drop("topic", "partition", "offset")), f"{folder}/out", f"{folder}/state"))
    return topic_log.read(spark, f"{folder}/out", sinks.RECORD).select("topic", "key", "ord", "id", "kind", F.get_json_object("value", "$.reject_reason").alias("reason"))


def _log_of(rows: DataFrame, name: str, topic: Column, order: str, batch_rows: int) -> tuple[DataFrame, str]:
    """rows as a stream from a log of topics, and the folder for what is made of it."""
    spark = rows.sparkSession
    folder = f"{io.shared_dir(spark)}/streamed/{name}-{uuid.uuid4().hex}"
    records = rows.withColumns({"topic": topic, "partition": F.lit(0), "offset": F.col(order).cast("long")})
    topic_log.append(records, f"{folder}/in", "all", min(batch_rows, topic_log.SEGMENT_ROWS))
    return topic_log.stream(spark, f"{folder}/in", records.schema, f"{folder}/state", rows=batch_rows), folder


def stream_live_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest books of exchanges and unions, read from the state of the query that keeps them."""
    accepted = io.landed(validate.accepted(_judged(spark, sf_dir)), "accepted")
    both = book.split(book.books(accepted)).select("pair_id", "exchange_id", "side", "ord", "event_time", "levels").unionByName(aggregate.unions(accepted).select("pair_id", F.lit(0).alias("exchange_id"), "side", "ord", "event_time", "levels"))
    stream, folder = _log_of(both, "live", _topic("view", "pair_id", "exchange_id", "side"), "ord", io.PASSING_ROWS)
    messages = serve.messages(live.newest(stream))
    with io.few_states(spark):
        query = messages.writeStream.format("noop").outputMode("update").option("checkpointLocation", f"{folder}/state").start()
    io.until_read(query)
    return live.held(spark, f"{folder}/state").select("pair_id", "exchange_id", "side", "ord", "event_time", F.size("levels").cast("long").alias("n"))


def stream_silences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silent markets by event-time timers, from records that come at a second a place; no polls."""
    records = _records(spark, sf_dir).select("topic", (F.col("offset") * 1000).alias("timestamp"), F.lit(60_000).alias("threshold"))
    stream, folder = _log_of(records.withColumn("market", F.col("topic")), "silences", F.lit("all"), "timestamp", io.PASSING_ROWS)
    out = live.silences(stream.drop("topic").withColumnRenamed("market", "topic"))
    with io.few_states(spark):
        query = out.writeStream.foreachBatch(lambda rows, batch: rows.write.mode("overwrite").parquet(f"{folder}/out/batch={batch}")).outputMode("update").option("checkpointLocation", f"{folder}/state").start()
    io.until_read(query)
    turns = spark.read.schema(out.schema).parquet(f"{folder}/out")
    return monitor.recorded(turns.limit(0), turns)


def stream_rebase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rebase_levels on a stream whose factors are loaded anew for every micro-batch."""
    levels = feed.levels(spark, sf_dir)
    stream, folder = _log_of(levels, "rebase", F.lit("all"), "ord", io.PASSING_ROWS)
    factors = reference.Refreshing(lambda: reference.rebase_lookup(feed.exchange_markets(spark, sf_dir)))
    io.until_read(live.with_fresh(stream.select(*levels.columns), factors, scale.rebased, f"{folder}/out", f"{folder}/state", every=0))
    based = spark.read.schema(scale.rebased(levels, factors.current).schema).parquet(f"{folder}/out")
    return _level_rows(based.where("reject IS NULL"))


def stream_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ended episodes of staleness_episodes by Structured Streaming, from a log of topics to files and back."""
    return io.streamed(_polls(spark, sf_dir), streaming.episodes, "stream-episodes", F.col("topic"), "now")


QUERIES = {
    "scan_topic_ids": scan_topic_ids,
    **{f"parse_ex{e}": parse(e) for e in PARSERS},
    **{
        f.__name__: f
        for f in (
            extract_pairs, drop_counters, canonical_decimals, rebase_levels, rebase_missing, precision_merge, null_vs_empty, validate_verdicts, validate_rejects, validate_controls, validate_resets,
            book_events, book_final, book_lineage_check, lineage_walk, lineage_breaks, lineage_faults, superseded, split_sides, aggregate_union, merge_prices, book_enriched, top_of_book_spread, display_books, view_messages, latest_book, selection, latency_deltas,
            topic_plan, watch_list, watch_removed, staleness_now, staleness_episodes, episode_history, staleness_metrics, watch_list_modes, stage_timings, rfc3339_times, stream_differences, expected_union, subscriptions, market_catalog, avro_events, full_chain,
            stream_validate, stream_books, stream_union, stream_chain, stream_fan_out, stream_live_view, stream_silences, stream_rebase, stream_episodes,
        )
    },
}
