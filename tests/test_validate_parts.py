"""Sequence rules in parts of a market's order: the same verdicts as in one go."""

import random
from dataclasses import astuple

import pyarrow as pa
import pytest

from quaybook.operators import validate
from quaybook.operators.steps import Part, Sequence
from quaybook.sources import feed

SCHEMA = "exchange_id int, pair_id int, ord long, type string, sequence_id long, sequence_jump long, event_time long, note string"


def event(rng, at, calm):
    kind = rng.choices(["update", "snapshot", "reset"], [20, 1, 0.2])[0] if calm else rng.choice(["update", "snapshot"])
    sequence = None if rng.random() < (0.02 if calm else 0.3) else at + rng.choice([0] * 12 + [-3, 1, 4]) if calm else rng.randrange(20)
    return kind, sequence, rng.choice([1, 1, 1, 0, 2]) if not calm else 1, at + (rng.choice([0] * 9 + [-50]) if calm else rng.randrange(20))


def market(kind, n, rng):
    if kind == "outage":  # a gap, then nothing but what has to wait
        return [("snapshot", 1, 1, 1), ("update", 9, 1, 2)] + [("update", 10 + i, 1, 3 + i) for i in range(n)] + [("snapshot", 5000, 1, 9000), ("update", 5001, 1, 9001)]
    if kind == "no baseline":
        return [("update", i, 1, i) for i in range(n)]
    if kind == "only free":
        return [("snapshot", None, 0, rng.randrange(50)) for i in range(n)]
    return [event(rng, i, kind == "calm") for i in range(n)]


def in_one_go(events):
    state = Sequence()
    return [state.step(*e) for e in events]


@pytest.mark.parametrize("part", [7, 40])
def test_verdicts_in_parts(spark, part):
    rng = random.Random(part)
    rows, want = [], {}
    for pair, kind in enumerate(["calm", "wild", "outage", "no baseline", "only free", "wild"]):
        events = market(kind, 150, rng)
        orders = sorted(rng.sample(range(10 * part, 10 * part + 2 * len(events)), len(events)))
        rows += [(1, pair, o, *e, "x") for o, e in zip(orders, events, strict=True)]
        want |= {(pair, o): v for o, v in zip(orders, in_one_go(events), strict=True)}
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = validate.verdicts(df, part=part)
    assert out.columns == [*df.columns, "verdict", "request", "reset"]
    assert {(r.pair_id, r.ord): (r.verdict, r.request, r.reset) for r in out.collect()} == want


def test_no_task_has_more_than_a_part(spark):
    """All events are of one market: each task of the last pass has parts of it, and none has all."""
    rng = random.Random(3)
    df = spark.createDataFrame([(1, 1, i, *event(rng, i, True), "x") for i in range(4000)], SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = validate.verdicts(df, part=100).selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1
    assert max(r["count"] for r in sizes) < 2500
    assert validate.verdicts(df.where("false"), part=100).isEmpty()


def test_few_events_are_one_part_however_far_apart(spark, monkeypatch):
    """Parts are counted in a market's own events: of orders that others take up most of, nothing is walked twice."""
    rng = random.Random(5)
    events = market("calm", 120, rng)
    df = spark.createDataFrame([(1, 1, i << 18, *e, "x") for i, e in enumerate(events)], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(validate, "entries", lambda _: pytest.fail("walked twice"))
        got = {r.ord: (r.verdict, r.request, r.reset) for r in validate.verdicts(df).collect()}
    assert got == {i << 18: v for i, v in enumerate(in_one_go(events))}
    assert got == {r.ord: (r.verdict, r.request, r.reset) for r in validate.verdicts(df, part=50).collect()}


def test_feed_in_parts(spark):
    events = feed.events(spark, "/root/testdata/sf0.001")
    columns = ["exchange_id", "pair_id", "ord", "verdict", "request", "reset"]
    parts, whole = (validate.verdicts(events, part=n).select(columns) for n in (300, 1 << 20))
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))


def test_summaries_say_what_passes():
    """Where a summary says that a part accepts nothing, walking it accepts nothing and leaves just that."""
    rng = random.Random(11)
    told = 0
    for _ in range(4000):
        state = Sequence()
        for _ in range(rng.randrange(6)):
            state.step(*event(rng, rng.randrange(20), False))
        events = [event(rng, rng.randrange(20), False) for _ in range(rng.randrange(1, 4))]
        walk = Part(Sequence())
        for e in events:
            walk.step(*e)
        passed = state.passing(walk.top, walk.top_snapshot, walk.top_free, walk.least_jump)
        own = Sequence(*astuple(state))
        verdicts = [own.step(*e)[0] for e in events]
        if passed is not None:
            told += 1
            assert "accepted" not in verdicts
            assert "sequence_gap" not in verdicts
            assert astuple(own) == astuple(passed)
    assert told > 300


def test_columns_become_lists_of_the_same_values():
    """Nulls stay null and large numbers exact, also in a part of a column."""
    for values, kind in (([2**63 - 1, None, -(2**63), 0], "int64"), ([1, 2, 3], "int32"), ([], "int64"), ([None, None], "int64"), (["update", None, ""], "string"), ([True, None], "bool"), ([1.5, None], "float64")):
        column = pa.array(values, getattr(pa, kind if kind != "bool" else "bool_")())
        assert validate._listed(column) == values and validate._listed(column.slice(1)) == values[1:]
