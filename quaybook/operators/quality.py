"""Checks: of lineage, each returns the rows that break a rule; of streams, and of what they must hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaybook.functions.ids import UUID
from quaybook.operators.intervals import running
from quaybook.sources.io import landed


def differences(got: DataFrame, want: DataFrame, keys: list[str], order: str, fields: list[str]) -> DataFrame:
    """(keys, n, got, want): places where two ordered streams differ in `fields`; null where one has no record. None: they are equal."""

    def placed(df: DataFrame, name: str) -> DataFrame:
        return running(df.select(*keys, order, *fields), keys, order, {"n": F.lit(1)}).select(*keys, "n", F.struct(*fields).alias(name))

    return placed(got, "got").join(placed(want, "want"), [*keys, "n"], "full").where(~F.col("got").eqNullSafe(F.col("want")))


def expected_union(snapshots: DataFrame) -> DataFrame:
    """What the union of one exchange must show: its last book, each level with its exchange and simulation, in the same order."""
    rest = [c for c in snapshots.columns if c not in ("exchange_id", "pair_id")]
    last = snapshots.groupBy("exchange_id", "pair_id").agg(F.max_by(F.struct(*rest), "ord").alias("b")).select("exchange_id", "pair_id", "b.*")

    def side(name: str) -> Column:
        levels = F.transform(name, lambda x: F.struct(F.col("exchange_id").alias("exchange_id"), F.col("simulation").alias("simulation"), x["price"].alias("price"), x["quantity"].alias("quantity")))
        return F.struct(F.lit(name).alias("side"), levels.alias("levels"))

    return last.select("exchange_id", "pair_id", F.explode(F.array(side("asks"), side("bids"))).alias("s")).select("exchange_id", "pair_id", "s.*")


def bad_ids(records: DataFrame, column: str = "id") -> DataFrame:
    """Ids that are no UUID or occur twice."""
    counted = records.groupBy(column).agg(F.count("*").alias("n"))
    return counted.where((F.col("n") > 1) | F.col(column).isNull() | ~F.col(column).rlike(UUID))


def foreign_levels(snapshots: DataFrame) -> DataFrame:
    """Levels whose source triggered neither this book nor an earlier one of the market."""
    market = ["exchange_id", "pair_id"]
    both = F.explode(F.concat(F.col("asks"), F.col("bids")))
    levels = snapshots.select(*market, "ord", both.alias("l")).select(*market, "ord", F.col("l.source_id").alias("source"))
    triggers = snapshots.select(*(F.col(c).alias(f"t_{c}") for c in (*market, "ord", "trigger_id")))
    on = [F.col(c) == F.col(f"t_{c}") for c in market] + [F.col("source") == F.col("t_trigger_id"), F.col("t_ord") <= F.col("ord")]
    return levels.join(triggers, on, "left_anti")


def unknown_sources(aggregated: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Levels of a cross-exchange view that name no snapshot."""
    levels = aggregated.select("pair_id", "side", "ord", F.explode("levels").alias("l")).select("pair_id", "side", "ord", F.col("l.source_id").alias("source"))
    return levels.join(snapshots.select(F.col("id").alias("source")), "source", "left_anti")


def superseded_sources(latest: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Levels of the latest cross-exchange views that name another snapshot than the last one of their exchange."""
    last = snapshots.groupBy("pair_id", "exchange_id").agg(F.max_by("id", "ord").alias("last"))
    levels = latest.select("pair_id", "side", F.explode("levels").alias("l")).select("pair_id", "side", "l.exchange_id", "l.price", F.col("l.source_id").alias("source"))
    return levels.join(last, ["pair_id", "exchange_id"], "left").where(~F.col("source").eqNullSafe(F.col("last")))


def parents(records: DataFrame) -> DataFrame:
    """(child, parent): whom records (id, source_ids) come from."""
    return records.select(F.col("id").alias("child"), F.explode("source_ids").alias("parent"))


def walk(starts: DataFrame, edges: DataFrame, most: int = 64) -> DataFrame:
    """(id, origin, hops) of starts (id): each origin that is reached, a record without parents, and over how many at least.

    edges: (child, parent) of all stages. Each round takes all paths one hop further and is written, so the plan doesn't grow
    with the way. Two paths that meet go on as one. A way of more than `most` hops is an error: lineage has no circles.
    """
    known = landed(edges.select("child", "parent").where("parent IS NOT NULL"), "edges")
    front = starts.select("id", F.col("id").alias("at")).distinct()
    ended = None
    for hops in range(most + 1):
        # an inner join, so that a small front goes to the edges and these aren't shuffled
        step = landed(known.join(front, F.col("child") == F.col("at")).select("id", "at", "parent"), "walk")
        over = front.join(step, ["id", "at"], "left_anti").select("id", F.col("at").alias("origin"), F.lit(hops).alias("hops"))
        ended = over if ended is None else ended.unionByName(over)
        front = landed(step.select("id", F.col("parent").alias("at")).distinct(), "front")
        if front.isEmpty():
            return ended.groupBy("id", "origin").agg(F.min("hops").alias("hops"))
    raise ValueError(f"lineage goes on for more than {most} hops")


def bad_controls(controls: DataFrame) -> DataFrame:
    """Commands without their market's key, or without exactly one parent that isn't themselves."""
    key = F.concat_ws("|", F.col("exchange_id").cast("string"), F.col("pair_id").cast("string"))
    good = (F.col("key") == key) & (F.size("source_ids") == 1) & (F.get("source_ids", 0) != F.col("id"))
    return controls.where(~F.coalesce(good, F.lit(False)))
