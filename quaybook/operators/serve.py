"""What displays show: the latest books, with names, best levels, spread and latencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaybook.functions import exact
from quaybook.schema import STAGES


def latest(books: DataFrame) -> DataFrame:
    """The last book of each (pair_id, exchange_id, side); exchange 0 is the aggregate of all."""
    keyed = books if "exchange_id" in books.columns else books.withColumn("exchange_id", F.lit(0))
    rest = [c for c in keyed.columns if c not in ("pair_id", "exchange_id", "side")]
    return keyed.groupBy("pair_id", "exchange_id", "side").agg(F.max_by(F.struct(*rest), "ord").alias("b")).select("pair_id", "exchange_id", "side", "b.*")


def selected(books: DataFrame, pair_id: int, exchange_id: int = 0) -> DataFrame:
    return books.where((F.col("pair_id") == pair_id) & (F.col("exchange_id") == exchange_id))


def named(books: DataFrame, catalog: DataFrame, exchanges: DataFrame) -> DataFrame:
    """books with base and quote, and the exchange's name on the book and on each level.

    A pair that the catalog lacks is p<id> / ?, an exchange "unknown". The exchanges' names, a row
    for each venue, come as one map from a subquery.
    """
    names = exchanges.agg(F.map_from_entries(F.collect_list(F.struct("id", "name")))).scalar()

    def name(of: Column) -> Column:
        return F.coalesce(F.try_element_at(F.col("_names"), of), F.lit("unknown"))

    out = books.join(catalog, "pair_id", "left").withColumn("_names", names)
    level = F.transform("levels", lambda x: F.struct(x["exchange_id"].alias("exchange_id"), name(x["exchange_id"]).alias("exchange"), x["source_id"].alias("source_id"), x["price"].alias("price"), x["quantity"].alias("quantity")))
    exchange = F.when(F.col("exchange_id") == 0, "aggregated").otherwise(name(F.col("exchange_id")))
    return out.withColumns({"base": F.coalesce("base", F.concat(F.lit("p"), F.col("pair_id").cast("string"))), "quote": F.coalesce("quote", F.lit("?")), "exchange": exchange, "levels": level}).drop("_names")


def top(snapshots: DataFrame) -> DataFrame:
    """Best prices, exact spread (null if a side is empty), levels of each side."""
    ask, bid = F.get("asks", 0)["price"], F.get("bids", 0)["price"]
    spread = F.when(ask.isNotNull() & bid.isNotNull(), exact.total(F.array(ask, exact.negated(bid))))
    return snapshots.select("exchange_id", "pair_id", "ord", ask.alias("best_ask"), bid.alias("best_bid"), spread.alias("spread"), F.size("asks").cast("long").alias("n_asks"), F.size("bids").cast("long").alias("n_bids"))


def display(snapshots: DataFrame) -> DataFrame:
    """Asks from the highest, prices padded to the places of the longest."""
    most = F.array_max(F.transform(F.concat(F.transform("asks", lambda x: x["price"]), F.transform("bids", lambda x: x["price"])), exact.places))
    def padded(side: str) -> Column:
        return F.transform(side, lambda x: F.struct(exact.padded(x["price"], F.col("_places")).alias("price"), x["quantity"].alias("quantity")))
    out = snapshots.withColumn("_places", F.coalesce(most, F.lit(0)))
    return out.withColumns({"asks": F.reverse(padded("asks")), "bids": padded("bids")}).drop("_places")


def messages(latest_books: DataFrame, kind: str = "update") -> DataFrame:
    """Books as the JSON that clients get."""
    return latest_books.select("pair_id", "exchange_id", F.to_json(F.struct(F.lit(kind).alias("type"), *latest_books.columns)).alias("value"))


def latencies(timed: DataFrame) -> DataFrame:
    """From stamps {stage}_in and {stage}_out: lag to the first stage, time in each, transit between them, and end to end."""
    out = [F.col(f"{s}_out") - F.col(f"{s}_in") for s in STAGES]
    between = [F.col(f"{b}_in") - F.col(f"{a}_out") for a, b in zip(STAGES, STAGES[1:], strict=False)]
    columns = [(F.col(f"{STAGES[0]}_in") - F.col("event_time")).alias("lag")]
    columns += [c.alias(f"in_{s}") for s, c in zip(STAGES, out, strict=True)]
    columns += [c.alias(f"to_{s}") for s, c in zip(STAGES[1:], between, strict=True)]
    return timed.select("ord", *columns, (F.col(f"{STAGES[-1]}_out") - F.col("event_time")).alias("total"))
