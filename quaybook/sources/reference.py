"""Reference tables: lookups that are joined to events, one row for each key.

A lookup of duplicate keys would multiply events, so the row with the highest id wins.
They have a row for each market of an exchange, thousands at most; Spark broadcasts them
while they are below its own threshold and sorts and merges them otherwise.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Loader = Callable[[], DataFrame]


def last_by(df: DataFrame, keys: list[str], order: str = "id") -> DataFrame:
    """The row with the greatest `order` for each key."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("row")).select(*keys, "row.*")


def pair_lookup(exchange_markets: DataFrame) -> DataFrame:
    """(exchange_id, market) -> pair_id."""
    return last_by(exchange_markets.select("id", "exchange_id", "market", "market_id"), ["exchange_id", "market"]).select("exchange_id", "market", F.col("market_id").alias("pair_id"))


def rebase_lookup(exchange_markets: DataFrame) -> DataFrame:
    """(exchange_id, pair_id) -> exponents; rows without a market or exponents are none."""
    rows = exchange_markets.where("market_id IS NOT NULL AND price_amount_rebase IS NOT NULL AND volume_amount_rebase IS NOT NULL").withColumn("pair_id", F.col("market_id"))
    return last_by(rows.select("id", "exchange_id", "pair_id", "price_amount_rebase", "volume_amount_rebase"), ["exchange_id", "pair_id"]).drop("id")


def precision_lookup(markets: DataFrame) -> DataFrame:
    """pair_id -> precisions, nulls kept."""
    return markets.select(F.col("id").alias("pair_id"), "price_precision", "quantity_precision")


def market_catalog(markets: DataFrame, currencies: DataFrame) -> DataFrame:
    """(pair_id, base, quote)."""
    base = currencies.select(F.col("id").alias("base_id"), F.col("name").alias("base"))
    quote = currencies.select(F.col("id").alias("quote_id"), F.col("name").alias("quote"))
    return markets.join(base, "base_id").join(quote, "quote_id").select(F.col("id").alias("pair_id"), "base", "quote")


def subscribed(exchange_markets: DataFrame, markets: DataFrame) -> DataFrame:
    """(exchange_id, pair_id, threshold) of the pairs that are subscribed to."""
    pairs = markets.select(F.col("id").alias("market_id"))
    return exchange_markets.where("status = 'subscribe'").join(pairs, "market_id").select("exchange_id", F.col("market_id").alias("pair_id"), F.col("staleness_threshold_seconds").alias("threshold"))


def provisioned(exchange_markets: DataFrame, markets: DataFrame, exchanges: DataFrame) -> DataFrame:
    """(exchange_id, pair_id, exchange): all pairs, whatever their status."""
    names = exchanges.select(F.col("id").alias("exchange_id"), F.col("name").alias("exchange"))
    return exchange_markets.join(markets.select(F.col("id").alias("market_id")), "market_id").join(names, "exchange_id").select("exchange_id", F.col("market_id").alias("pair_id"), "exchange")


def threshold_file(spark: SparkSession, path: str) -> DataFrame:
    """(topic, threshold) from the `topics:` block of a YAML file: one `name: seconds` a line, comments and other lines left out."""
    body = spark.read.text(path, wholetext=True)
    block = F.regexp_extract("value", r"(?m)^topics:[ \t]*(?:#.*)?\r?\n((?:(?:[ \t]+.*|[ \t]*#.*|[ \t]*)(?:\r?\n|\z))*)", 1)
    entry = r"^[ \t]+[\"']?([^\s:#\"']+)[\"']?[ \t]*:[ \t]*([0-9]+)[ \t]*(?:#.*)?\r?$"
    lines = body.select(F.explode(F.split(block, "\n")).alias("line")).where(F.col("line").rlike(entry))
    return lines.select(F.regexp_extract("line", entry, 1).alias("topic"), F.regexp_extract("line", entry, 2).cast("int").alias("threshold"))


def subscription_file(spark: SparkSession, path: str) -> DataFrame:
    """(exchange, market, action) from a CSV file with a header; what is missing is empty, for monitor.subscriptions() to leave out."""
    rows = spark.read.csv(path, schema="exchange string, market string, action string", header=True, mode="PERMISSIVE")
    return rows.fillna("")


def jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of the reference database; filters and columns are pushed down."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


class Refreshing:
    """A lookup that is loaded at once, failing fast, and again before a micro-batch; a failed reload keeps the last good one."""

    def __init__(self, load: Loader, keep_if_empty: bool = False) -> None:
        self.load, self.keep_if_empty = load, keep_if_empty
        self.current = self._cached(load())

    @staticmethod
    def _cached(df: DataFrame) -> DataFrame:
        df = df.persist()
        df.count()
        return df

    def refresh(self) -> DataFrame:
        try:
            new = self._cached(self.load())
        except Exception:  # noqa: BLE001
            logging.getLogger(__name__).exception("reload failed; the last good rows stay")
            return self.current
        if self.keep_if_empty and new.isEmpty():
            new.unpersist()
            return self.current
        old, self.current = self.current, new
        old.unpersist()
        return self.current
