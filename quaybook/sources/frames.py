"""Verbatim exchange frames: which topic they come from and what they say.

A parser is SQL over the frame's JSON as a variant `v`: it gives an array of events, an
empty one where the frame is none of its kinds (acknowledgements, foreign channels), and
null where it is but can't be read. All parsers stand in one CASE over the exchange, so
frames are read once and parsed in generated code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaybook.functions import exact

RAW_TOPIC = "^ex([0-9]+)-raw$"
EVENT = "struct<market:string,type:string,sequence_id:bigint,sequence_jump:bigint,event_time:bigint,asks:array<struct<price:string,quantity:string>>,bids:array<struct<price:string,quantity:string>>>"


def from_topics(frames: DataFrame) -> DataFrame:
    """Frames of raw topics, with their exchange_id; others are none of ours."""
    return frames.where(F.col("topic").rlike(RAW_TOPIC)).withColumn("exchange_id", F.regexp_extract("topic", RAW_TOPIC, 1).try_cast("int"))


def _at(of: str, path: str, kind: str = "string") -> str:
    return f"try_variant_get({of}, '{path}', '{kind}')"


def _kind(of: str, path: str) -> str:
    return f"coalesce(schema_of_variant({_at(of, path, 'variant')}), '')"


def _is(of: str, path: str, kind: str) -> str:
    """kind: STRING, BIGINT (any integral number), ARRAY or OBJECT."""
    return f"{_kind(of, path)} LIKE '{kind}%'"


def _has(of: str, path: str) -> str:
    """Whether the key is there, be its value null."""
    return f"{_kind(of, path)} <> ''"


def _text(of: str, path: str) -> str:
    """The text of a string, number or boolean; empty for arrays and objects, null where there is nothing."""
    kind = _kind(of, path)
    return f"CASE WHEN {kind} IN ('', 'VOID') THEN NULL WHEN {kind} RLIKE '^(ARRAY|OBJECT)' THEN '' ELSE {_at(of, path)} END"


def _readable(of: str, path: str, side: str, level: str) -> str:
    """Whether a side is missing, or an array of levels x that fit; a side that is there but no array can't be read."""
    return f"CASE WHEN {_has(of, path)} THEN coalesce(forall({side}, x -> {level}), false) ELSE true END"


def _string_levels(of: str, path: str) -> tuple[str, str]:
    """(levels, whether they can be read) of [["price", "quantity", ...], ...]; null where the side is missing."""
    side = _at(of, path, "array<variant>")
    return (
        f"transform({side}, x -> named_struct('price', {_at('x', '$[0]')}, 'quantity', {_at('x', '$[1]')}))",
        _readable(of, path, side, f"{_is('x', '$[0]', 'STRING')} AND {_is('x', '$[1]', 'STRING')}"),
    )


def _number_levels(of: str, path: str, price: str = "$[0]", quantity: str = "$[1]") -> tuple[str, str]:
    """The same of JSON numbers, as their text: parsed() makes it canonical. JSON numbers are exact up to 38 digits."""
    side = _at(of, path, "array<variant>")
    return (
        f"transform({side}, x -> named_struct('price', {_at('x', price)}, 'quantity', {_at('x', quantity)}))",
        _readable(of, path, side, f"{_number('x', price)} AND {_number('x', quantity)}"),
    )


def _number(of: str, path: str) -> str:
    return f"{_kind(of, path)} RLIKE '^(BIGINT|DECIMAL|DOUBLE)'"


def _event(market: str, kind: str, sequence: str, jump: int, time: str, asks: tuple[str, str] | None, bids: tuple[str, str] | None) -> str:
    """The event, or null where its time or its levels can't be read."""
    none = (f"CAST(NULL AS {'array<struct<price:string,quantity:string>>'})", "true")
    (a, a_ok), (b, b_ok) = asks or none, bids or none
    body = f"named_struct('market', {market}, 'type', {kind}, 'sequence_id', CAST({sequence} AS bigint), 'sequence_jump', CAST({jump} AS bigint), 'event_time', CAST({time} AS bigint), 'asks', {a}, 'bids', {b})"
    return f"CASE WHEN {a_ok} AND {b_ok} AND {time} IS NOT NULL THEN {body} END"



def _cases(*cases: tuple[str, str]) -> str:
    """The array of the first case that holds; null if its event can't be read."""
    whens = " ".join(f"WHEN {test} THEN transform(array(array({event})), a -> CASE WHEN a[0] IS NOT NULL THEN a END)[0]" for test, event in cases)
    return f"CASE {whens} ELSE CAST(array() AS array<{EVENT}>) END"


def _channel(prefix: str, sides: tuple[str, str]) -> str:
    """A push of a channel with this prefix, with both sides."""
    data = " AND ".join(_is("v", f"$.push.pub.data.{s}", "ARRAY") for s in sides)
    return f"{_is('v', '$.push.channel', 'STRING')} AND startswith({_at('v', '$.push.channel')}, '{prefix}') AND {_is('v', '$.push.pub.data', 'OBJECT')} AND {_is('v', '$.push.pub.offset', 'BIGINT')} AND {data}"


def _after(prefix: str) -> str:
    return f"substring({_at('v', '$.push.channel')}, {len(prefix) + 1})"


def _rest(time: str) -> str:
    return f"{_at('v', '$.action')} = 'snapshot' AND {_is('v', '$.pair', 'STRING')} AND {_is('v', '$.asks', 'ARRAY')} AND {_is('v', '$.bids', 'ARRAY')} AND {_is('v', time, 'BIGINT')}"


_OFFSET = _at("v", "$.push.pub.offset", "bigint")
_SIDES = (_string_levels("v", "$.asks"), _string_levels("v", "$.bids"))
_PUSHED = (_string_levels("v", "$.push.pub.data.asks"), _string_levels("v", "$.push.pub.data.bids"))


def exchange_1() -> str:
    prefix = "public:orderbook-"
    snapshot = _event(_at("v", "$.pair"), "'snapshot'", "NULL", 0, _at("v", "$.lastUpdate", "bigint"), *_SIDES)
    update = _event(_after(prefix), "'update'", _OFFSET, 1, _at("v", "$.push.pub.data.lastUpdate", "bigint"), *_PUSHED)
    return _cases((_rest("$.lastUpdate"), snapshot), (f"{_channel(prefix, ('asks', 'bids'))} AND {_is('v', '$.push.pub.data.lastUpdate', 'BIGINT')}", update))


def exchange_2() -> str:
    prefix = "orderbook:"
    time = f"unix_millis(try_cast({_at('v', '$.push.pub.data.event_time')} AS timestamp))"
    snapshot = _event(_at("v", "$.pair"), "'snapshot'", "NULL", 0, _at("v", "$.event_time", "bigint"), *_SIDES)
    update = _event(_after(prefix), "'update'", _OFFSET, 1, time, *_PUSHED)
    return _cases((_rest("$.event_time"), snapshot), (f"{_channel(prefix, ('asks', 'bids'))} AND {_is('v', '$.push.pub.data.event_time', 'STRING')}", update))


def exchange_3() -> str:
    """One side a frame: [market@side, levels, tags]; the other side stays null."""
    name = _at("v", "$[0]")
    levels = _number_levels("v", "$[1]", "$.price", "$.quantity")
    market, side = f"substring_index({name}, '@', 1)", f"substring({name}, locate('@', {name}) + 1)"
    whole = f"size({_at('v', '$', 'array<variant>')}) IN (2, 3) AND {_is('v', '$[0]', 'STRING')} AND locate('@', {name}) > 1 AND {_is('v', '$[1]', 'ARRAY')}"
    return _cases(
        (f"{whole} AND {side} = 'sellDepth'", _event(market, "'snapshot'", "NULL", 0, "processing_time", levels, None)),
        (f"{whole} AND {side} = 'buyDepth'", _event(market, "'snapshot'", "NULL", 0, "processing_time", None, levels)),
    )


def exchange_4() -> str:
    prefix, data = "orderbook:", "$.push.pub.data"
    return _cases((_channel(prefix, ("sells", "buys")), _event(_after(prefix), "'snapshot'", _OFFSET, 0, "processing_time", _number_levels("v", f"{data}.sells"), _number_levels("v", f"{data}.buys"))))


def _many(test: str, fits: str, event: str) -> str:
    """An event for each element d of data. The first that doesn't fit drops the frame without a word, the first that can't be read with one; the earlier of the two decides."""
    data = _at("v", "$.data", "array<variant>")
    none = f"CAST(array() AS array<{EVENT}>)"
    told = f"transform({data}, d -> named_struct('fits', {fits}, 'e', {event}))"
    first = "get(filter(a, x -> NOT x.fits OR x.e IS NULL), 0)"
    return f"CASE WHEN {test} THEN transform(array({told}), a -> CASE WHEN {first} IS NULL THEN transform(a, x -> x.e) WHEN {first}.fits THEN NULL ELSE {none} END)[0] ELSE {none} END"


def exchange_5() -> str:
    event = _event(_text("v", "$.arg.instId"), "'snapshot'", _at("d", "$.seq", "bigint"), 0, f"try_cast({_at('d', '$.ts')} AS bigint)", _string_levels("d", "$.asks"), _string_levels("d", "$.bids"))
    test = f"{_at('v', '$.action')} = 'snapshot' AND {_text('v', '$.arg.instId')} IS NOT NULL AND {_is('v', '$.data', 'ARRAY')}"
    return _many(test, f"{_is('d', '$.asks', 'ARRAY')} AND {_is('d', '$.bids', 'ARRAY')} AND {_is('d', '$.ts', 'STRING')} AND {_is('d', '$.seq', 'BIGINT')}", event)


def exchange_6() -> str:
    test = f"{_at('v', '$.type')} IN ('snapshot', 'delta') AND {_text('v', '$.data.s')} IS NOT NULL AND {_is('v', '$.data.u', 'BIGINT')} AND {_is('v', '$.cts', 'BIGINT')} AND ({_has('v', '$.data.a')} OR {_has('v', '$.data.b')})"
    kind = f"CASE WHEN {_at('v', '$.type')} = 'snapshot' THEN 'snapshot' ELSE 'update' END"
    return _cases((test, _event(_text("v", "$.data.s"), kind, _at("v", "$.data.u", "bigint"), 1, _at("v", "$.cts", "bigint"), _string_levels("v", "$.data.a"), _string_levels("v", "$.data.b"))))


def exchange_8() -> str:
    time = f"try_cast({_at('d', '$.ts')} AS bigint)"
    event = _event(_text("v", "$.arg.instId"), _at("v", "$.action"), time, 300, time, _string_levels("d", "$.asks"), _string_levels("d", "$.bids"))
    test = f"{_at('v', '$.action')} IN ('snapshot', 'update') AND {_text('v', '$.arg.instId')} IS NOT NULL AND {_is('v', '$.data', 'ARRAY')}"
    return _many(test, f"({_has('d', '$.asks')} OR {_has('d', '$.bids')}) AND {_is('d', '$.ts', 'STRING')}", event)


#: Exchanges whose levels are JSON numbers: their text is made canonical; that of others stays as written.
JSON_NUMBERS = (3, 4)


def _canonical_levels(events: Column) -> Column:
    def side(levels: Column) -> Column:
        return F.transform(levels, lambda x: F.struct(exact.canonical(x["price"]).alias("price"), exact.canonical(x["quantity"]).alias("quantity")))

    return F.transform(events, lambda e: e.withField("asks", side(e["asks"])).withField("bids", side(e["bids"])))


#: exchange id -> its parser; add to it to read another exchange.
PARSERS: dict[int, Callable[[], str]] = {1: exchange_1, 2: exchange_2, 3: exchange_3, 4: exchange_4, 5: exchange_5, 6: exchange_6, 8: exchange_8}


def parsed(frames: DataFrame, parsers: dict[int, Callable[[], str]] | None = None) -> DataFrame:
    """from_topics' frames with events, simulation, parent (the frame's own id) and outcome.

    outcome is ok, unparseable or no_parser. The tags are on the root object, on exchange
    3 in the third element; without one simulation is 0, a blank or missing id is null.
    """
    parsers = PARSERS if parsers is None else parsers
    cases = " ".join(f"WHEN {e} THEN {sql()}" for e, sql in parsers.items())
    carrier = "CASE WHEN exchange_id = 3 THEN try_variant_get(v, '$[2]', 'variant') ELSE v END"
    numbers = F.col("exchange_id").isin(*JSON_NUMBERS)
    events = exact.let(F.expr(f"CASE exchange_id {cases} END"), lambda e: F.when(numbers, _canonical_levels(e)).otherwise(e))
    out = frames.withColumn("v", F.try_parse_json("value")).withColumns({"events": events, "tags": F.expr(carrier)})
    known = F.col("exchange_id").isin(*parsers)
    return out.withColumns({
        "simulation": F.expr("coalesce(try_variant_get(tags, '$.simulation', 'int'), 0)"),
        "parent": F.expr("CASE WHEN trim(try_variant_get(tags, '$.id', 'string')) <> '' THEN try_variant_get(tags, '$.id', 'string') END"),
        "outcome": F.when(~known, "no_parser").when(F.col("v").isNull() | F.col("events").isNull(), "unparseable").otherwise("ok"),
    }).drop("v", "tags")


