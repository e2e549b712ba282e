"""A deterministic order-book feed from the `events` and `lineitem` tables, and its reference tables.

It stands in for live exchanges: sequence gaps, repeats, late events, one-sided and empty
books, deletions and prices that differ in trailing zeros all occur in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaybook.functions.ids import minted
from quaybook.operators.intervals import running
from quaybook.sources.io import landed, shared_dir

DAY = 86_400_000
#: Events of the feed's longest frames.
MANY = 70


def _level(price: Column, quantity: Column) -> Column:
    return F.struct(price.cast("string").alias("price"), quantity.cast("string").alias("quantity"))


def _laned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's rows with the market that each stands for."""
    lane = 1 + F.col("user_id") % 7
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value", "props")
    return e.withColumns({"exchange_id": F.when(lane == 7, 8).otherwise(lane).cast("int"), "pair_id": (1 + F.floor(F.col("user_id") / 7) % 5).cast("int")})


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events in the shape of job 1's output, with ord as their order in a market."""
    e = _laned(spark, sf_dir).withColumns({
        "gap": ((F.col("event_type") == "error") & (F.col("event_id") % 4 == 0)).cast("long"),
        "p": F.col("value").cast("decimal(18,2)").cast("decimal(18,1)"),
        "k": F.get_json_object("props", "$.k").cast("int"),
    })
    e = running(e, ["exchange_id", "pair_id"], "event_id", {"number": F.lit(1), "gaps": F.col("gap")})
    sequence = 1000 + F.col("number") + F.col("gaps") - F.when(F.col("event_id") % 23 == 0, 5).otherwise(0)
    signup = F.col("event_type") == "signup"
    again = F.when(F.col("event_id") % 11 == 0, F.concat(F.col("p").cast("string"), F.lit("00"))).otherwise((F.col("p") + F.lit(1.5).cast("decimal(3,1)")).cast("string"))
    asks = F.array(_level(F.concat(F.col("p").cast("string"), F.lit("0")), F.col("k")), _level(again, F.concat(F.col("k").cast("string"), F.lit(".25"))))
    bids = F.array(_level(F.col("p") - 1, F.col("k") % 7), _level(F.col("p") - F.lit(2.5).cast("decimal(3,1)"), F.col("k") + 1))
    return e.select(
        "exchange_id", "pair_id", F.col("event_id").alias("ord"), F.when(signup, "snapshot").otherwise("update").alias("type"), (F.col("event_id") % 2).cast("int").alias("simulation"),
        minted("feed", F.col("event_id")).alias("id"), F.array(F.concat(F.lit("f-"), F.col("event_id").cast("string"))).alias("source_ids"),
        F.when(~(signup & (F.col("event_id") % 2 == 0)), sequence).cast("long").alias("sequence_id"), F.lit(1).cast("long").alias("sequence_jump"),
        (F.unix_millis(F.col("ts").cast("timestamp")) - F.when(F.col("event_id") % 29 == 0, DAY).otherwise(0)).alias("event_time"),
        F.when(F.col("event_id") % 3 != 0, asks).alias("asks"), F.when(F.col("event_id") % 3 != 1, bids).alias("bids"),
    )


def _json(side: Column, quoted: bool) -> Column:
    mark = '"' if quoted else ""
    levels = F.transform(F.coalesce(side, F.array().cast("array<struct<price:string,quantity:string>>")), lambda x: F.concat(F.lit(f"[{mark}"), x["price"], F.lit(f"{mark},{mark}"), x["quantity"], F.lit(f"{mark}]")))
    return F.concat(F.lit("["), F.concat_ws(",", levels), F.lit("]"))


def _topic() -> Column:
    n = F.col("ord")
    return F.when(n % 53 == 0, F.lit("elsewhere-raw")).when(n % 59 == 0, F.lit("ex7-raw")).otherwise(F.format_string("ex%d-raw", F.col("exchange_id")))


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frames' topics alone."""
    return _laned(spark, sf_dir).select(F.col("event_id").alias("ord"), "exchange_id").select(_topic().alias("topic"))


#: Where frames lie, by session, its shared folder and the table that they are of.
_FRAMES: dict[tuple[str, str, str], DataFrame] = {}


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as the frames that its exchanges would send, among acknowledgements and damage; they lie in files, as a topic's would, from their first use in a session on."""
    key = (spark.sparkContext.applicationId, shared_dir(spark), sf_dir)
    if key not in _FRAMES:
        _FRAMES[key] = landed(_made_up(spark, sf_dir), "frames")
    return _FRAMES[key]


def _made_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    n = F.col("ord")
    text = {
        "MARKET": F.when(n % 41 == 0, F.lit("UNKNOWN")).otherwise(F.concat(F.lit("M"), F.col("pair_id").cast("string"))),
        "TAGS": F.concat(F.lit('"simulation":'), F.col("simulation").cast("string"), F.when(n % 37 == 0, F.lit("")).otherwise(F.concat(F.lit(',"id":"'), F.element_at("source_ids", 1), F.lit('"')))),
        "TIME": F.col("event_time").cast("string"), "ISO": F.date_format(F.timestamp_millis("event_time"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        "SEQ": F.coalesce("sequence_id", n).cast("string"),
        "ASKS": F.when(n % 43 == 0, F.lit('[["1"]]')).otherwise(_json(F.col("asks"), True)), "BIDS": _json(F.col("bids"), True),
        "NASKS": F.when(n % 43 == 0, F.lit("[[1]]")).otherwise(_json(F.col("asks"), False)), "NBIDS": _json(F.col("bids"), False),
        "ONE": F.concat(F.lit("["), F.concat_ws(",", F.transform(F.coalesce(F.when(n % 2 == 0, F.col("asks")).otherwise(F.col("bids")), F.array().cast("array<struct<price:string,quantity:string>>")), lambda x: F.concat(F.lit('{"price":'), x["price"], F.lit(',"quantity":'), x["quantity"], F.lit("}")))), F.lit("]")),
        "SIDE": F.when(n % 2 == 0, F.lit("sellDepth")).otherwise(F.lit("buyDepth")),
        "ID": F.when(n % 71 == 0, F.lit("12345")).otherwise(F.concat(F.lit('"'), F.when(n % 41 == 0, F.lit("UNKNOWN")).otherwise(F.concat(F.lit("M"), F.col("pair_id").cast("string"))), F.lit('"'))),
        "A6": F.when(n % 61 == 0, F.lit('"a":null,')).when(F.col("asks").isNotNull(), F.concat(F.lit('"a":'), _json(F.col("asks"), True), F.lit(","))).otherwise(F.lit("")),
        "B6": F.when(n % 67 == 0, F.lit('"b":{},')).when(F.col("bids").isNotNull(), F.concat(F.lit('"b":'), _json(F.col("bids"), True), F.lit(","))).otherwise(F.lit("")),
        "A8": F.when(n % 61 == 0, F.lit('"asks":null,')).when(F.col("asks").isNotNull(), F.concat(F.lit('"asks":'), _json(F.col("asks"), True), F.lit(","))).otherwise(F.lit("")),
        "B8": F.when(n % 67 == 0, F.lit('"bids":"none",')).when(F.col("bids").isNotNull(), F.concat(F.lit('"bids":'), _json(F.col("bids"), True), F.lit(","))).otherwise(F.lit("")),
        "TYPE6": F.when(F.col("type") == "snapshot", F.lit("snapshot")).otherwise(F.lit("delta")), "TYPE": F.col("type"),
        "TWICE": F.when(n % 5 == 0, F.lit("+")).otherwise(F.lit("")),
    }

    def made(template: str) -> Column:
        parts = [text[x] if x in text else F.lit(x) for x in template.split("~") if x]
        return F.concat(*parts)

    data5 = '{"asks":~ASKS~,"bids":~BIDS~,"ts":"~TIME~","seq":~SEQ~}'
    many = F.concat_ws(",", F.transform(F.sequence(F.lit(0), F.lit(MANY - 1)), lambda i: F.concat(made('{"asks":~ASKS~,"bids":~BIDS~,"ts":"~TIME~","seq":'), (F.coalesce("sequence_id", n) + i).cast("string"), F.lit("}"))))
    bodies = {
        1: F.when(F.col("type") == "snapshot", made('{"action":"snapshot","pair":"~MARKET~","lastUpdate":~TIME~,"asks":~ASKS~,"bids":~BIDS~,~TAGS~}')).otherwise(made('{"push":{"channel":"public:orderbook-~MARKET~","pub":{"offset":~SEQ~,"data":{"asks":~ASKS~,"bids":~BIDS~,"lastUpdate":~TIME~}}},~TAGS~}')),
        2: F.when(F.col("type") == "snapshot", made('{"action":"snapshot","pair":"~MARKET~","event_time":~TIME~,"asks":~ASKS~,"bids":~BIDS~,~TAGS~}')).otherwise(made('{"push":{"channel":"orderbook:~MARKET~","pub":{"offset":~SEQ~,"data":{"asks":~ASKS~,"bids":~BIDS~,"event_time":"~ISO~"}}},~TAGS~}')),
        3: made('["~MARKET~@~SIDE~",~ONE~,{~TAGS~}]'),
        4: made('{"push":{"channel":"orderbook:~MARKET~","pub":{"offset":~SEQ~,"data":{"sells":~NASKS~,"buys":~NBIDS~}}},~TAGS~}'),
        5: F.when(n % 601 == 0, F.concat(made('{"action":"snapshot","arg":{"instId":~ID~},"data":['), many, made("],~TAGS~}"))).when(n % 5 == 0, made('{"action":"snapshot","arg":{"instId":~ID~},"data":[' + data5 + "," + data5 + "],~TAGS~}")).otherwise(made('{"action":"snapshot","arg":{"instId":~ID~},"data":[' + data5 + "],~TAGS~}")),
        6: made('{"topic":"book","type":"~TYPE6~","data":{"s":"~MARKET~",~A6~~B6~"u":~SEQ~},"cts":~TIME~,~TAGS~}'),
        8: made('{"arg":{"instId":~ID~},"action":"~TYPE~","data":[{~A8~~B8~"ts":"~TIME~"}],~TAGS~}'),
    }
    body = F.lit(None).cast("string")
    for exchange, value in bodies.items():
        body = F.when(F.col("exchange_id") == exchange, value).otherwise(body)
    value = F.when(n % 47 == 0, F.lit("{broken")).when(n % 31 == 0, F.lit('{"id":1,"result":{}}')).otherwise(body)
    return e.select(_topic().alias("topic"), F.lit(0).alias("partition"), n.alias("offset"), value.alias("value"), F.col("event_time").alias("processing_time"))


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of several levels a side, one for each order: prices and quantities of its lines."""
    item = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    line = F.struct(F.col("l_linenumber").alias("n"), (F.col("l_linenumber") % 2).alias("side"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("price"), F.col("l_quantity").cast("decimal(18,2)").cast("string").alias("quantity"), F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p"))
    orders = item.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))

    def side(which: int) -> Column:
        return F.transform(F.filter("lines", lambda x: x["side"] == which), lambda x: F.struct(x["price"].alias("price"), x["quantity"].alias("quantity")))

    some = F.exists("lines", lambda x: x["side"] == 0)
    return orders.select(
        (1 + F.get("lines", 0)["s"] % 8).cast("int").alias("exchange_id"), (1 + F.get("lines", 0)["p"] % 6).cast("int").alias("pair_id"), F.col("l_orderkey").alias("ord"), F.lit("snapshot").alias("type"), F.lit(0).alias("simulation"),
        minted("order", F.col("l_orderkey")).alias("id"), F.array(F.concat(F.lit("o-"), F.col("l_orderkey").cast("string"))).alias("source_ids"), F.col("l_orderkey").alias("sequence_id"), F.lit(0).cast("long").alias("sequence_jump"), F.col("l_orderkey").alias("event_time"),
        side(1).alias("asks"), F.when(some, side(0)).alias("bids"),
    )


def _seen(spark: SparkSession, sf_dir: str, exchanges: tuple[int, ...] = (), pairs: tuple[int, ...] = ()) -> DataFrame:
    """One row: the exchanges and the pairs of the events, and some more."""
    return _laned(spark, sf_dir).agg(*(F.array_union(F.collect_set(c), F.array(*map(F.lit, more)).cast("array<int>")).alias(c) for c, more in (("exchange_id", exchanges), ("pair_id", pairs))))


def exchange_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every exchange's markets, with exponents; exchange 9 sends no events, and pair 6 has no rebase row."""
    listed = _seen(spark, sf_dir, (9,), (6,)).select(F.explode("exchange_id").alias("exchange_id"), "pair_id").select("exchange_id", F.explode("pair_id").alias("p"))
    of = (F.col("exchange_id") + F.col("p")) % 5 + 1
    price, volume = (F.when(F.col("p") < 6, F.element_at(F.array(*map(F.lit, powers)), of)) for powers in ((0, -1, -2, -6, 3), (0, 0, 2, 6, -3)))
    return listed.select(
        (10 * F.col("exchange_id") + F.col("p")).alias("id"), "exchange_id", F.concat(F.lit("M"), F.col("p").cast("string")).alias("market"), F.col("p").alias("market_id"), F.when((F.col("exchange_id") + F.col("p")) % 3 == 0, "unsubscribe").otherwise("subscribe").alias("status"),
        price.alias("price_amount_rebase"), volume.alias("volume_amount_rebase"), F.when(F.col("p") % 2 == 0, 30 + F.col("p")).alias("staleness_threshold_seconds"),
    )


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' pairs with precisions, and pair 6: 4 has none for prices, 5 no row at all."""
    rows = [(1, 1, 2, 1, 2), (2, 1, 3, 0, 0), (3, 2, 3, 2, 1), (4, 3, 1, None, 1), (6, 4, 2, 1, None)]
    known = spark.createDataFrame(rows, "id int, base_id int, quote_id int, price_precision int, quantity_precision int")
    return known.join(_seen(spark, sf_dir, (), (6,)).select(F.explode("pair_id").alias("id")), "id", "left_semi")


def currencies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(1, "BTC"), (2, "USDT"), (3, "IRT"), (4, "ETH")], "id int, name string")


def exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' exchanges but for 8, with names; and 7 and 9, which send no events."""
    ids = _seen(spark, sf_dir, (7, 9)).select(F.explode("exchange_id").alias("id")).where("id <> 8")
    return ids.select("id", F.format_string("exchange-%d", "id").alias("name"), F.format_string("Exchange %d", "id").alias("label"))
