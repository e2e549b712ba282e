"""What holds when: running sums over long orders, and joins of moments with intervals.

A window over a whole market puts its whole history in one task. Here an order is cut
into parts: sums of the parts are small and get the window, and inside a part the
window is short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of a part, in units of the order column.
PART = 1 << 16
#: Moments of one key that are joined with intervals together.
CHUNK = 64
#: The same where each moment goes through all that its chunk gathered: a level is shuffled once for so many moments that it lasts.
GATHER_CHUNK = 16


def running(df: DataFrame, keys: list[str], order: str, sums: dict[str, Column], part: int = PART, then: tuple[str, ...] = ()) -> DataFrame:
    """df with inclusive running sums by `order` for each key; rows of equal order stand by the columns `then`."""
    flagged = df.withColumn("_part", F.floor(F.col(order) / part)).withColumns({f"_{n}": c.cast("long") for n, c in sums.items()})
    parts = flagged.groupBy(*keys, "_part").agg(*(F.sum(f"_{n}").alias(f"_s_{n}") for n in sums))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(*keys, "_part", *(F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums))
    within = Window.partitionBy(*keys, "_part").orderBy(order, *then).rowsBetween(Window.unboundedPreceding, 0)
    out = flagged.withColumns({f"_r_{n}": F.sum(f"_{n}").over(within) for n in sums}).join(offsets, [*keys, "_part"])
    return out.select(*df.columns, *((F.col(f"_r_{n}") + F.col(f"_o_{n}")).alias(n) for n in sums))


def alive(moments: DataFrame, intervals: DataFrame, keys: list[str], at: str, chunk: int = CHUNK) -> DataFrame:
    """Each moment with the intervals (begin, until) of its keys that hold then; left join.

    begin <= at < until. `at` counts a key's moments without gaps, so an interval stands
    once for each chunk of moments that it reaches: a moment meets what is alive in its
    chunk, not all that its key ever had.
    """
    cut = moments.withColumn("_chunk", F.floor(F.col(at) / chunk))
    reach = F.sequence(F.floor(F.col("begin") / chunk), F.floor((F.col("until") - 1) / chunk))
    spread = intervals.where("until > begin").withColumn("_chunk", F.explode(reach))
    spread = spread.select(*(F.col(k).alias(f"_k_{k}") for k in [*keys, "_chunk"]), *(c for c in intervals.columns if c not in keys))
    on = [F.col(k) == F.col(f"_k_{k}") for k in [*keys, "_chunk"]]
    return cut.join(spread, [*on, F.col("begin") <= F.col(at), F.col("until") > F.col(at)], "left").drop("_chunk", *(f"_k_{k}" for k in [*keys, "_chunk"]))


def chunked(moments: DataFrame, at: str, chunk: int = GATHER_CHUNK) -> DataFrame:
    """moments with _chunk, by places `at` that are counted without gaps."""
    return moments.withColumn("_chunk", F.floor(F.col(at) / chunk))


def gathered(intervals: DataFrame, keys: list[str], entry: Column, chunk: int = GATHER_CHUNK, by: tuple[str, ...] = ()) -> DataFrame:
    """(keys, _chunk, held): for each chunk of moments the intervals (begin, until) that reach it, each as an `entry`, sorted; a row for each `by`, if there is any.

    A moment then filters its chunk's, which keep their order: what holds is shuffled once a chunk, not once a moment. What comes
    later for (keys, _chunk) needs no shuffle either.
    """
    reach = F.sequence(F.floor(F.col("begin") / chunk), F.floor((F.col("until") - 1) / chunk))
    spread = intervals.where("until > begin").select(*keys, *by, entry.alias("_e"), F.explode(reach).alias("_chunk")).repartition(*keys, "_chunk")
    return spread.groupBy(*keys, "_chunk", *by).agg(F.sort_array(F.collect_list("_e")).alias("held"))
