"""Line dedup by site-relative frequency.

Pages are grouped by host. A line is boilerplate on a host when the pages that
contain it are more than `ratio` of the host's pages, and `least` at least; it goes from all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaybook.llm.common import sparing, table

#: Up to so many boilerplate lines (about 40 bytes each) are sent to all executors.
BROADCAST_LINES = 50_000
#: Pages that a boilerplate line is on, at least: what two pages share may be a copy.
LEAST = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """96 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.1, least: int = LEAST) -> DataFrame:
    """(host, lines): the keys of each host's boilerplate lines.

    A host with p pages of l lines each has fewer than l / ratio of them.
    Lines of spaces only never count. Both counts are summed before the shuffle,
    so a host with most of the pages is no hot spot.
    """
    pages = docs.groupBy(F.col(host).alias("of")).agg(F.count("*").alias("pages"))
    kept = F.filter(F.array_distinct(_lines(F.col(text))), lambda x: F.trim(x) != "")
    lines = docs.select(F.col(host).alias("host"), F.explode(F.transform(kept, _key)).alias("line"))
    counted = lines.groupBy("host", "line").agg(F.count("*").alias("n"))
    frequent = counted.where(F.col("n") >= least).join(pages, F.col("host").eqNullSafe(F.col("of")))
    return frequent.where(F.col("n") > ratio * F.col("pages")).groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines"))


@sparing
def dedup_lines(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.1, least: int = LEAST) -> DataFrame:
    """docs with `text` rid of its host's boilerplate, and columns n_lines, n_dropped.

    Each row is a page, repeated rows too. Rows with a null host are a host of
    their own. A null text stays null with 0 lines; a text whose lines all go is
    empty; empty lines stay. A line has to be on `least` pages of its host, however
    few these are. Other
    columns pass through; columns named n_lines or n_dropped are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    found = table(boilerplate(docs, host, text, ratio, least).select(F.col("host").alias("_of"), F.col("lines").alias("_lines")), "boilerplate")
    n = found.agg(F.sum(F.size("_lines"))).first()[0] or 0
    same = F.col(host).eqNullSafe(F.col("_of"))
    if n <= BROADCAST_LINES:
        joined = docs.join(F.broadcast(found), same, "left")
    else:  # too many to send everywhere: deal each host's pages over 64 copies of its list
        salted = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
        dealt = docs.withColumn("_deal", F.pmod(F.xxhash64(text), F.lit(64)).cast("int"))
        joined = dealt.join(salted, same & (F.col("_deal") == F.col("_salt")), "left").drop("_deal", "_salt")
    all_lines = _lines(F.col(text))
    kept = F.when(F.col("_lines").isNull(), all_lines).otherwise(F.filter(all_lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("_lines"), _key(x))))
    out = joined.withColumn("_kept", kept).withColumns({"n_lines": F.coalesce(F.size(all_lines), F.lit(0)).cast("long"), "n_dropped": (F.coalesce(F.size(all_lines), F.lit(0)) - F.coalesce(F.size("_kept"), F.lit(0))).cast("long")})
    changed = F.when(F.col("n_dropped") == 0, F.col(text)).otherwise(F.array_join("_kept", "\n"))
    return out.withColumn(text, F.when(F.col(text).isNotNull(), changed)).drop("_of", "_lines", "_kept")
