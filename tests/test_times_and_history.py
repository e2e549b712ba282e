"""Stamps through the chain, moments as text, the episode history, metrics, and the readers of files."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quaybook.functions import times
from quaybook.operators import monitor, quality
from quaybook.plans import pipeline
from quaybook.schema import STAGES
from quaybook.sources import feed, reference

SF = "/root/testdata/sf0.001"


def test_every_record_is_stamped(spark):
    """A snapshot has the stamps of all stages that it passed; one after a reset lacks the first; a dead letter has its moment."""
    markets = feed.exchange_markets(spark, SF)
    events = times.stamped(feed.events(spark, SF), "pair_extract")
    views = pipeline.from_events(events, reference.rebase_lookup(markets), reference.precision_lookup(feed.markets(spark, SF)))
    names = [f"{s}_{way}" for s in STAGES for way in ("in", "out")]
    rows = views.snapshots.select("timings.*").collect()
    assert {r[n] is not None for r in rows for n in names[2:]} == {True}
    assert {r.pair_extract_in is not None for r in rows} == {True, False}
    for r in rows[:50]:
        stamps = [r[n] for n in names if r[n] is not None]
        assert stamps == sorted(stamps)
    assert {r.rejected_at is not None for r in views.rejected.collect()} == {True}


def test_fresh_stamps(spark):
    def clock(stage, way):
        return F.lit({"in": 1, "out": 2}[way])

    once = times.stamped(spark.range(2), "rebase", clock)
    again = times.stamped(once, "precision", clock, ("in",), fresh=F.col("id") == 1).orderBy("id").select("timings.*").collect()
    assert [(r.rebase_in, r.rebase_out, r.precision_in, r.precision_out) for r in again] == [(1, 2, 1, None), (None, None, 1, None)]


def test_rfc3339(spark):
    moments = [0, -1, 999, 1_706_691_600_123, -62_135_596_800_000, 253_402_300_799_999, 1_711_846_800_000]
    df = spark.createDataFrame([(m,) for m in [*moments, None]], "m long")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got = {r.m: r.t for r in df.select("m", times.rfc3339(F.col("m")).alias("t")).collect()}
            assert got.pop(None) is None
            assert got == {m: (datetime(1970, 1, 1) + timedelta(seconds=m // 1000)).isoformat() + "Z" for m in moments}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_rfc3339_years_of_other_lengths(spark):
    """Before year 0 and after 9999 as SQL's strftime writes them, to the ends of what it knows."""
    moments = {-62_167_219_200_001: "-1-12-31T23:59:59Z", -65_000_000_000_000: "-90-03-27T04:26:40Z", -62_167_219_200_000: "0000-01-01T00:00:00Z", -518_000_000_000_000: "-14445-03-27T15:06:40Z", 400_000_000_000_000: "14645-06-30T15:06:40Z", -3_000_000_000_000_000: "-93097-10-14T18:40:00Z"}
    df = spark.createDataFrame([(m,) for m in moments], "m long")
    assert {r.m: r.t for r in df.select("m", times.rfc3339(F.col("m")).alias("t")).collect()} == moments


def polls(spark, text):
    return spark.createDataFrame([(t, n, int(s)) for t, states in text.items() for n, s in enumerate(states) if s in "01"], "topic string, now long, stale int")


def flat(df):
    return sorted((r.topic, r.since, r.recovered, r.duration) for r in df.collect())


def test_a_restart_takes_up_open_episodes(spark):
    states = {"a": "0110111", "b": "1111100", "c": "0000000", "d": "1011111"}
    whole = monitor.episodes(polls(spark, states))
    for cut in range(8):
        first = monitor.episodes(polls(spark, states).where(F.col("now") < cut))
        history = monitor.recorded(first.limit(0), first)
        turns = monitor.resumed(polls(spark, states).where(F.col("now") >= cut), history)
        once = monitor.recorded(history, turns)
        assert sorted(map(str, flat(once))) == sorted(map(str, flat(whole)))
        assert sorted(map(str, flat(monitor.recorded(once, turns)))) == sorted(map(str, flat(whole)))
        assert once.where("recovered IS NULL").groupBy("topic").count().where("count > 1").isEmpty()


def test_dropped_topics_close(spark):
    gone = spark.createDataFrame([("a", 9), ("b", 2)], "topic string, at long")
    got = flat(monitor.episodes(polls(spark, {"a": "011", "b": "0001"}), gone))
    assert got == [("a", 1, 9, 8), ("b", 3, None, None)]


def test_metrics(spark):
    seen = polls(spark, {"a": "0110111", "b": "000"}).withColumns({"now": F.col("now") * 20_000, "threshold": F.lit(60), "last_ts": F.lit(0)})
    a, b = sorted(monitor.metrics(seen, monitor.episodes(seen)).collect())
    assert (a.episodes, a.stale_since, a.last_recovery, a.last_stale_seconds, a.stale_seconds, a.seconds_since, a.stale) == (2, 80_000, 60_000, 40.0, 80.0, -1.0, 1)
    assert (b.episodes, b.stale_since, b.last_recovery, b.last_stale_seconds, b.stale_seconds, b.stale) == (0, 0, 0, 0.0, 0.0, 0)


def test_threshold_file(spark, tmp_path):
    path = tmp_path / "config.yaml"
    path.write_text("poll: 20\n# topics: none\ntopics:   # by hand\n  ex1-raw: 30\n\n  # ex9-raw: 1\n  'ex2-raw' : 45  # slow\n  odd: words\nother:\n  ex3-raw: 5\n")
    assert sorted(map(tuple, reference.threshold_file(spark, str(path)).collect())) == [("ex1-raw", 30), ("ex2-raw", 45)]
    path.write_text("topics:\r\n  p1-asks: 7")
    assert list(map(tuple, reference.threshold_file(spark, str(path)).collect())) == [("p1-asks", 7)]
    path.write_text("")
    assert reference.threshold_file(spark, str(path)).isEmpty()


def test_subscription_file(spark, tmp_path):
    path = tmp_path / "markets.csv"
    path.write_text("exchange,market,action\nok,BTC,subscribe\n\nok,ETH\n,X,subscribe\nby,\"A,B\",unsubscribe\nby,C,disable\nby, D ,subscribe\n")
    got = monitor.subscriptions(reference.subscription_file(spark, str(path)), reverse=True)
    assert sorted(map(tuple, got.collect())) == [("by", "A,B", "subscribe"), ("by", "D", "unsubscribe"), ("ok", "BTC", "unsubscribe")]


def test_stream_differences(spark):
    def stream(ids):
        return spark.createDataFrame([(1, i, x) for i, x in enumerate(ids)], "k int, ord long, id string")

    assert quality.differences(stream("abc"), stream("abc"), ["k"], "ord", ["id"]).isEmpty()
    got = quality.differences(stream(["a", None, "c", "d"]), stream(["a", "b", "c"]), ["k"], "ord", ["id"]).orderBy("n").collect()
    assert [(r.n, r.got and r.got.id, r.want and r.want.id) for r in got] == [(2, None, "b"), (4, "d", None)]
