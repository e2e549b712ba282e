"""Books and unions put together from intervals, against stepping through the events."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quaybook.operators import aggregate, book, serve
from quaybook.operators.steps import Book, Union
from quaybook.plans import queries
from quaybook.schema import RAW_EVENT

SF = "/root/testdata/sf0.001"
SIDES = ("asks", "bids")


def events(spark, n=500, seed=1):
    """Few clears, so that levels last over many chunks; prices twice in an event, in other writings, and quantities of zero."""
    rnd = random.Random(seed)
    rows = []
    for o in range(n):
        kind = rnd.choices(("update", "snapshot", "reset"), (96, 2, 2))[0]
        sides = [None if rnd.random() < 0.3 or kind == "reset" else [(f"{rnd.randrange(12)}{rnd.choice(('', '.0', '.50'))}", f"{rnd.choice((0, 1, 2, '1.50'))}") for _ in range(rnd.randrange(5))] for _ in SIDES]
        rows.append((rnd.choice((1, 2, 3)), rnd.choice((1, 2)), o * 3, kind, o % 2, f"e{o}", ["x"], o, 1, 1000 + rnd.randrange(50), *sides))
    return spark.createDataFrame(rows, RAW_EVENT), rows


def stepped(rows):
    """The books of (exchange, pair, ord) as batch books write them."""
    known, out = {}, {}
    for exchange, pair, at, kind, _, name, _, _, _, _, asks, bids in rows:
        one = known.setdefault((exchange, pair), Book())

        def plain(v):
            return v.rstrip("0").rstrip(".") if "." in v else v

        one.step(kind, name, *(None if side is None else [(plain(p), plain(q)) for p, q in side] for side in (asks, bids)))
        out[exchange, pair, at] = tuple([tuple(x) for x in side] for side in one.sides())
    return out


def test_books_of_long_epochs(spark):
    df, rows = events(spark)
    want = stepped(rows)
    got = {(r.exchange_id, r.pair_id, r.ord): tuple([tuple(x) for x in side] for side in (r.asks, r.bids)) for r in book.books(df).collect()}
    assert got == want
    last = {(e, p): o for e, p, o in sorted(want)}
    ended = {(r.exchange_id, r.pair_id): (r.ord, r.trigger_id, tuple([tuple(x) for x in side] for side in (r.asks, r.bids))) for r in book.books(df, final_only=True).collect()}
    assert ended == {k: (o, f"e{o // 3}", want[(*k, o)]) for k, o in last.items()}


def test_unions_from_events(spark):
    df, _ = events(spark, seed=2)
    want = aggregate.unioned(book.split(book.books(df))).collect()
    got = aggregate.unions(df)
    assert {(r.pair_id, r.side, r.ord): r for r in got.select(*want[0].__fields__).collect()} == {(r.pair_id, r.side, r.ord): r for r in want}
    assert len(want) == 1000


def test_moments_go_through_their_side_alone(spark):
    df, _ = events(spark, n=60)
    for out in (book.books(df), aggregate.unions(df)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "held_asks" in plan and "held_bids" in plan


def test_merges_from_events(spark):
    """As merged unions, also where a book says of no liquidity whether it is simulated."""
    df, _ = events(spark, seed=4)
    df = df.withColumn("simulation", F.when(F.col("ord") % 15 != 0, F.col("simulation")))
    want = aggregate.merged(aggregate.unions(df)).collect()
    got = aggregate.merges(df)
    assert {(r.pair_id, r.side, r.ord): r for r in got.select(*want[0].__fields__).collect()} == {(r.pair_id, r.side, r.ord): r for r in want}
    assert any(len(x.exchange_ids) > 1 for r in want for x in r.levels) and any(x.simulation is None for r in want for x in r.levels)


def test_last_union_needs_the_last_books_alone(spark):
    df, _ = events(spark, seed=3)
    want = {(r.pair_id, r.side): r for r in serve.latest(aggregate.unions(df)).collect()}
    got = {(r.pair_id, r.side): r for r in serve.latest(aggregate.unioned(book.split(book.books(df, final_only=True)))).collect()}
    assert got == want


def test_last_views_make_last_books_alone(spark, monkeypatch):
    """What shows the last unions doesn't make a book for each moment, nor do stamps make unions."""
    real = book.books

    def last_only(df, final_only=False):
        assert final_only
        return real(df, final_only)

    def none(*_):
        raise AssertionError("unions of all moments")

    monkeypatch.setattr(aggregate, "unions", none)
    assert queries.latency_deltas(spark, SF).columns[0] == "ord"
    monkeypatch.setattr(book, "books", last_only)
    for query in (queries.latest_book, queries.lineage_walk, queries.superseded, queries.full_chain):
        assert query(spark, SF).columns


def test_a_view_orders_each_book_once():
    """A book's levels get their place and text when it comes, and a changed book new ones; ties stand by quantity, then exchange."""
    def level(exchange, price, quantity):
        return {"exchange_id": exchange, "simulation": 0, "source_id": "s", "price": price, "quantity": quantity}

    union = Union()
    union.step("2", 5, [level(2, "10", "1"), level(2, "9", "2")])
    union.step("1", 4, [level(1, "9", "2"), level(1, "9", "3"), level(1, "100", "1")])
    time, text = union.view("asks")
    assert (time, [(x["exchange_id"], x["price"], x["quantity"]) for x in json.loads(text)]) == (5, [(1, "9", "3"), (1, "9", "2"), (2, "9", "2"), (2, "10", "1"), (1, "100", "1")])
    assert [x["price"] for x in json.loads(union.view("bids")[1])] == ["100", "10", "9", "9", "9"]
    held = {k: id(v) for k, v in union._placed.items()}
    union.step("2", 9, [])
    time, text = union.view("asks")
    assert (time, [x["exchange_id"] for x in json.loads(text)]) == (9, [1, 1, 1])
    assert id(union._placed["1", 1]) == held["1", 1]


def test_narrow_records_come_in_large_batches(spark, monkeypatch):
    """A micro-batch costs seconds whatever it holds, so narrow records don't come a few thousand at a time."""
    seen = []

    def log(*args):
        seen.append(args[-1])
        raise InterruptedError

    monkeypatch.setattr(queries, "_log_of", log)
    for query in (queries.stream_silences, queries.stream_rebase):
        with pytest.raises(InterruptedError):
            query(spark, SF)
    assert min(seen) >= 100_000
