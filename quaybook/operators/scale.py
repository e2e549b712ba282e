"""Rebasing and truncating levels: exact, inside the record, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaybook.functions import exact
from quaybook.functions.ids import restamped
from quaybook.operators.aggregate import grouped

SIDES = ("asks", "bids")


def _valid(side: str) -> Column:
    return F.coalesce(F.forall(side, lambda x: F.coalesce(exact.is_decimal(x["price"]) & exact.is_decimal(x["quantity"]), F.lit(False))), F.lit(True))


def rebased(events: DataFrame, factors: DataFrame) -> DataFrame:
    """events with prices * 10**price exponent and quantities * 10**volume exponent, and `reject`.

    reject is no_rebase_row, or invalid_decimal where a level is no number; such events are
    left as they came and keep their id. A null side stays null.
    """
    joined = events.join(factors, ["exchange_id", "pair_id"], "left")
    reject = F.when(F.col("price_amount_rebase").isNull(), "no_rebase_row").when(~(_valid("asks") & _valid("bids")), "invalid_decimal")
    joined = joined.withColumn("reject", reject)

    def scaled(side: str) -> Column:
        levels = F.transform(side, lambda x: F.struct(exact.shift(x["price"], F.col("price_amount_rebase")).alias("price"), exact.shift(x["quantity"], F.col("volume_amount_rebase")).alias("quantity")))
        return F.when(F.col("reject").isNull(), levels).otherwise(F.col(side))

    out = joined.withColumns({s: scaled(s) for s in SIDES}).select(*events.columns, "reject")
    kept = F.col("reject").isNull()
    new = restamped(out.select("*", F.col("id").alias("_id"), F.col("source_ids").alias("_parents")), "rebase", F.col("id"))
    return new.withColumns({"id": F.when(kept, F.col("id")).otherwise(F.col("_id")), "source_ids": F.when(kept, F.col("source_ids")).otherwise(F.col("_parents"))}).drop("_id", "_parents")


def merged_levels(side: str) -> Column:
    """A side's levels with truncated prices, those of one price as one: quantities are summed first and truncated once.

    They stand where the first of them stood. A side is sorted and summed within the record.
    """

    def level(x: Column) -> Column:
        return F.struct(exact.cut(x["price"], F.col("price_precision")).alias("price"), exact.cut(x["quantity"], F.col("quantity_precision")).alias("quantity"))

    def plain(x: Column, i: Column) -> Column:
        return F.struct(exact.cut(x["price"], F.col("price_precision")).alias("p"), i.alias("i"), x["quantity"].alias("q"))

    def one(group: Column) -> Column:
        quantities = F.transform(group, lambda x: exact.canonical(x["q"]))
        quantity = F.when(F.size(group) == 1, group[0]["q"]).otherwise(exact.total(quantities))
        return F.struct(group[0]["i"].alias("i"), group[0]["p"].alias("price"), exact.let(quantity, lambda q: exact.cut(q, F.col("quantity_precision"))).alias("quantity"))

    levels = grouped(F.sort_array(F.transform(side, plain)), lambda x, y: x["p"].eqNullSafe(y["p"]), one)
    found = F.transform(F.sort_array(levels), lambda x: F.struct(x["price"].alias("price"), x["quantity"].alias("quantity")))
    # most sides have no two levels of one price
    return exact.let(F.transform(side, level), lambda each: F.when(F.size(F.array_distinct(each["price"])) == F.size(each), each).otherwise(found))


def precise(events: DataFrame, precisions: DataFrame) -> DataFrame:
    """events with levels truncated to their pair's precisions; a pair without a row only merges equal prices."""
    joined = events.join(precisions, "pair_id", "left")
    out = joined.withColumns({s: merged_levels(s) for s in SIDES})
    return restamped(out.select(*events.columns), "precision", F.col("id"))
