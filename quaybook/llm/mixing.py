"""Mixing sources to target weights by Pfair scheduling, with SQL functions only.

Documents of a source come in blocks. With weights k/P (P is the period), block i
of a source may start at slot floor(i * P / k) and is due by ceil((i + 1) * P / k).
Taking the released block that is due first, slot after slot, meets every deadline
when the weights add up to 1, so what each source has had never differs by a whole
block from its weight times the slots so far. The schedule repeats every P slots:
one period is folded over an array, and each document finds its slot by arithmetic.
"""

from __future__ import annotations

import json
from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaybook.llm.common import sparing

#: About how many slots a period has where no weights are given: a source's share is its square root, rounded to these.
PERIOD = 512
#: Given weights are exact if their period has at most so many slots, and slots times sources are at most CELLS.
MAX_PERIOD, CELLS = 8192, 1 << 22
#: Documents in a block.
BLOCK = 8
#: A source's documents are ranked in 16**3 parts, by the start of the id's md5.
PART_DIGITS = 3
#: More sources than this are refused: a schedule has a row for each slot of a period.
MAX_SOURCES = 4096


def _edf(k: Column, period: Column) -> Column:
    """Array over the period's slots: the source that each goes to, and what all had before."""

    def place(state: Column, t: Column) -> Column:
        had = state["had"]

        def job(weight: Column, i: Column) -> Column:
            n = F.get(had, i)
            due = F.ceil((n + 1) * period / weight)
            return F.when(n * period < (t + 1) * weight, F.struct(due.cast("long").alias("due"), i.alias("i")))

        chosen = F.array_min(F.transform(k, job))["i"]
        picks = F.concat(state["picks"], F.array(F.struct(chosen.alias("i"), had.alias("before"))))
        picked = F.struct(had.alias("had"), picks.alias("picks"))
        return F.transform(F.array(picked), lambda p: F.struct(F.transform(p["had"], lambda n, i: n + (i == F.element_at(p["picks"], -1)["i"]).cast("bigint")).alias("had"), p["picks"].alias("picks")))[0]

    start = F.struct(F.transform(k, lambda _: F.lit(0).cast("bigint")).alias("had"), F.array().cast("array<struct<i:int,before:array<bigint>>>").alias("picks"))
    return F.aggregate(F.sequence(F.lit(0).cast("bigint"), period - 1), start, place, lambda state: state["picks"])


def whole_weights(weights: dict[str | None, float]) -> tuple[dict[str | None, int], int]:
    """The weights as whole numbers in the same proportions, and what 1 has become: 0.25 and 0.5 are 1 and 2, and 1 is 4."""
    exact = {name: Fraction(str(w)) for name, w in weights.items()}
    unit = lcm(*(w.denominator for w in exact.values()))
    numbers = {name: int(w * unit) for name, w in exact.items()}
    common = gcd(unit, *numbers.values())
    return {name: n // common for name, n in numbers.items()}, unit // common


def schedule(counts: DataFrame, weights: dict[str | None, float] | None = None, period: int = PERIOD) -> DataFrame:
    """A row for each source of (source, n), with its slots in a period.

    Columns: source, k (its blocks a period), period, totals and shares (n and k of
    all sources), turns (for each of its k blocks the slot, and before: the blocks
    that each source has in earlier slots).

    Given weights are decimals; a source that `weights` leaves out gets 1. The period is
    their sum as whole numbers in lowest terms, and the shares are exact. Where that has
    too many slots (MAX_PERIOD, CELLS), they are rounded to as many slots as there may
    be, two a source at least. Without weights a source's target is the square root of
    its size, rounded to `period` slots, or 16 a source if that is more and there may be
    as many. Every source gets a slot, also one of weight 0, as no row may go.
    """
    if weights is None:
        raw = F.sqrt(F.col("n"))
    else:
        numbers, other = whole_weights(weights)
        named = {"" if name is None else f"={name}": w for name, w in numbers.items()}
        found = F.from_json(F.lit(json.dumps(named)), "map<string,double>")  # one literal, however many
        raw = F.coalesce(F.try_element_at(found, F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))), F.lit(float(other)))
    one = counts.agg(F.sort_array(F.collect_list(F.struct(F.col("source"), F.col("n"), raw.alias("w")))).alias("all"))
    n = F.size("all")
    one = one.where(n > 0).where(F.assert_true(n <= MAX_SOURCES, F.lit("too many sources to mix")).isNull())
    total = F.aggregate(F.col("all"), F.lit(0.0), lambda a, x: a + x["w"])
    most = F.greatest(2 * n, F.least(F.lit(MAX_PERIOD), F.floor(F.lit(CELLS) / n)))
    # scaled by 1, given weights stay whole numbers
    slots = F.least(F.greatest(F.lit(period), 16 * n), most) if weights is None else F.when(F.col("total") <= most, F.col("total")).otherwise(most)
    one = one.withColumn("total", total).withColumn("slots", slots.cast("double"))
    one = one.withColumn("shares", F.transform("all", lambda x: F.greatest(F.lit(1).cast("bigint"), F.round(F.col("slots") * x["w"] / F.nullif("total", F.lit(0.0))).cast("bigint"))))
    one = one.withColumn("period", F.aggregate("shares", F.lit(0).cast("bigint"), lambda a, x: a + x))
    rows = one.select("all", "shares", "period", F.posexplode(_edf(F.col("shares"), F.col("period"))).alias("slot", "pick"))
    rows = rows.select(F.get("all", F.col("pick.i"))["source"].alias("source"), F.get("shares", F.col("pick.i")).alias("k"), "period", F.transform("all", lambda x: x["n"]).alias("totals"), "shares", F.struct(F.col("slot").cast("bigint").alias("slot"), F.col("pick.before").alias("before")).alias("turn"))
    return rows.groupBy("source", "k", "period", "totals", "shares").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


@sparing
def mix_sources(docs: DataFrame, source: str = "source", key: str = "doc_id", weights: dict[str | None, float] | None = None, block: int = BLOCK, period: int = PERIOD) -> DataFrame:
    """docs with columns block, slot and position (its place in the mix, from 0).

    No row is dropped: when a source has run out, its slots close up. Within a
    source the order is that of the md5 of the key, then the key: a fixed shuffle.
    A null source is a source of its own; rows with equal or null keys stand next to
    each other in any order. A column named block, slot or position is replaced.
    Ranks come from counts of parts of a source, so no task gets a whole source.
    """
    docs = docs.drop("block", "slot", "position")
    md5 = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    named = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))  # never null: a plain join key
    dealt = docs.withColumns({"_source": named, "_md5": md5}).withColumn("_part", F.substring("_md5", 1, PART_DIGITS))
    parts = dealt.groupBy("_source", "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(F.col("_source").alias("_s"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    counts = parts.groupBy(F.col("_source").alias("source")).agg(F.sum("_n").alias("n"))
    slots = schedule(counts, weights and {"" if name is None else f"={name}": w for name, w in weights.items()}, period)
    within = Window.partitionBy("_source", "_part").orderBy("_md5", key)
    ranked = dealt.withColumn("_rank", F.row_number().over(within) - 1)
    ranked = ranked.join(offsets, (F.col("_source") == F.col("_s")) & (F.col("_part") == F.col("_p")))
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_offset"))
    # at most MAX_PERIOD slots (about 2 * MAX_SOURCES), and MAX_SOURCES sources: refused above when there are more
    slots = slots.select(*[F.col(c).alias(f"_slot_{c}") for c in slots.columns])
    out = ranked.join(F.broadcast(slots), F.col("_source") == F.col("_slot_source"))
    out = out.withColumn("block", F.floor(F.col("_rank") / block).cast("bigint"))
    out = out.withColumn("_turn", F.get("_slot_turns", (F.col("block") % F.col("_slot_k")).cast("int")))
    rounds = F.floor(F.col("block") / F.col("_slot_k")).cast("bigint")
    out = out.withColumn("slot", rounds * F.col("_slot_period") + F.col("_turn.slot"))
    done = F.zip_with(F.col("_slot_shares"), F.col("_turn.before"), lambda k, b: rounds * k + b)
    ahead = F.aggregate(F.zip_with(F.col("_slot_totals"), done, lambda n, b: F.least(n, b * block)), F.lit(0).cast("bigint"), lambda a, x: a + x)
    out = out.withColumn("position", ahead + F.col("_rank") % block)
    return out.select(*docs.columns, "block", "slot", "position")
