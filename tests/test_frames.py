"""Frames: sides that are there but no array, markets that are numbers, and frames of many events."""

import json

import pytest
from pyspark.sql import functions as F

from quaybook.operators import extract, validate
from quaybook.plans.pipeline import numbered
from quaybook.sources.frames import from_topics, parsed

SCHEMA = "topic string, partition int, offset bigint, value string, processing_time bigint"


def read(spark, exchange, *bodies):
    rows = [(f"ex{exchange}-raw", 0, i, b if isinstance(b, str) else json.dumps(b), 1) for i, b in enumerate(bodies)]
    return [(r.outcome, r.events) for r in parsed(from_topics(spark.createDataFrame(rows, SCHEMA))).orderBy("offset").collect()]


def frame_8(*data, market="M1"):
    return {"arg": {"instId": market}, "action": "update", "data": list(data), "id": "a"}


def frame_6(data, cts=5):
    return {"type": "delta", "data": {"s": "M1", "u": 7, **data}, "cts": cts, "id": "a"}


LEVELS = [["1.0", "2"]]


@pytest.mark.parametrize("side", [None, 5, "x", {}, True, [["1"]], [[1, 2]], ["12"], [None]])
def test_sides_that_are_no_levels(spark, side):
    """A side that is there but no array of pairs makes the frame unreadable, beside a good one or alone."""
    assert read(spark, 6, frame_6({"a": side, "b": LEVELS}), frame_6({"b": side})) == [("unparseable", None)] * 2
    assert read(spark, 8, frame_8({"asks": side, "bids": LEVELS, "ts": "9"}), frame_8({"asks": side, "ts": "9"})) == [("unparseable", None)] * 2


def test_missing_and_empty_sides(spark):
    ((_, one), (_, both)) = read(spark, 6, frame_6({"b": LEVELS}), frame_6({"a": [], "b": []}))
    assert one[0].asks is None
    assert [tuple(x) for x in one[0].bids] == [("1.0", "2")]
    assert (both[0].asks, both[0].bids) == ([], [])
    assert read(spark, 6, frame_6({})) == [("ok", [])]
    assert read(spark, 8, frame_8({"ts": "9"}), frame_8({"asks": LEVELS, "ts": 9})) == [("ok", [])] * 2


def test_the_first_odd_element_decides(spark):
    fine, unread, unfit = {"asks": LEVELS, "ts": "9"}, {"asks": None, "ts": "9"}, {"ts": "9"}
    got = read(spark, 8, frame_8(fine, unread, unfit), frame_8(fine, unfit, unread), frame_8(fine, fine), frame_8(), frame_8({"asks": LEVELS, "ts": "late"}))
    assert [(outcome, events and len(events)) for outcome, events in got] == [("unparseable", None), ("ok", []), ("ok", 2), ("ok", []), ("unparseable", None)]


def test_markets_that_are_no_text(spark):
    got = read(spark, 8, *(frame_8({"asks": LEVELS, "ts": "9"}, market=m) for m in (77, 1.5, True, [1], None)))
    assert [[e.market for e in events] for _, events in got] == [["77"], ["1.5"], ["true"], [""], []]


def test_frames_of_many_events(spark):
    """A frame of 70 snapshots and one of 5, their sequence numbers in order: none is stale."""
    def many(first, n):
        data = [{"asks": LEVELS, "bids": LEVELS, "ts": "9", "seq": first + i} for i in range(n)]
        return json.dumps({"arg": {"instId": "M1"}, "action": "snapshot", "data": data, "id": "f"})

    rows = [("ex5-raw", 0, 10, many(1, 70), 1), ("ex5-raw", 0, 11, many(71, 5), 1), ("ex5-raw", 0, 1 << 40, many(76, 1), 1)]
    pairs = spark.createDataFrame([(5, "M1", 3)], "exchange_id int, market string, pair_id int")
    events = numbered(extract.events(extract.extracted(spark.createDataFrame(rows, SCHEMA), pairs)))
    judged = validate.verdicts(events)
    got = judged.agg(F.count("*"), F.count_distinct("ord"), F.sum((F.col("verdict") == "accepted").cast("int"))).first()
    assert tuple(got) == (76, 76, 76)
    assert [r.sequence_id for r in judged.orderBy("ord").collect()] == list(range(1, 77))


def test_frames_are_parsed_once(spark):
    """No filter of Spark's own making stands below the parsers and parses again; frames without events leave no row."""
    frames = spark.createDataFrame([("ex3-raw", 0, 0, json.dumps(["M1@sellDepth", [{"price": 1, "quantity": 2}], {"id": "a"}]), 1), ("ex3-raw", 0, 1, "[]", 1), ("ex3-raw", 0, 2, "{", 1)], SCHEMA)
    rows = extract.extracted(frames, spark.createDataFrame([(3, "M1", 1)], "exchange_id int, market string, pair_id int"))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("sellDepth") == 1
    assert sorted((r.ord, r.pos, r.outcome) for r in rows.collect()) == [(0, 0, "ok"), (2, 0, "unparseable")]
