"""Times: stamps of the stages, and how displays write a moment."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaybook.schema import TIMINGS

#: What a record is stamped with at (stage, "in" or "out").
Clock = Callable[[str, str], Column]


def now(stage: str, way: str) -> Column:
    """The time of the query, or of the micro-batch."""
    return F.unix_millis(F.current_timestamp())


def stamped(df: DataFrame, stage: str, clock: Clock = now, ways: tuple[str, ...] = ("in", "out"), fresh: Column | None = None) -> DataFrame:
    """df with the stage's stamps in `timings`; the other stages' stay, but where `fresh` holds they are null."""
    none = F.lit(None).cast(TIMINGS)
    # a null struct has no fields to change, so it becomes one of null fields
    blank = F.from_json(F.lit("{}"), TIMINGS)
    old = F.coalesce("timings", blank) if "timings" in df.columns else F.coalesce(none, blank)
    if fresh is not None:
        old = F.when(fresh, blank).otherwise(old)
    for way in ways:
        old = old.withField(f"{stage}_{way}", clock(stage, way).cast("long"))
    return df.withColumn("timings", old)


def rfc3339(millis: Column) -> Column:
    """UTC to the second, whatever the session's zone: 2024-01-31T09:00:00Z. Earlier moments than 1970 round down.

    Years have four digits at least; those before year 0, which RFC 3339 doesn't know, are written -1, -90, -14445.
    """
    seconds = F.floor(F.pmod(millis, F.lit(86_400_000)) / 1000)
    days = ((millis - F.pmod(millis, F.lit(86_400_000))) / 86_400_000).cast("int")
    moment = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=days, secs=seconds.cast("decimal(18,6)"))
    year = F.year(moment).cast("string")
    rest = F.replace(F.right(moment.cast("string"), F.lit(15)), F.lit(" "), F.lit("T"))
    return F.concat(F.when(F.year(moment) >= 0, F.lpad(year, F.greatest(F.length(year), F.lit(4)), F.lit("0"))).otherwise(year), rest, F.lit("Z"))
