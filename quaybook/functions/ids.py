"""Names and ids: topics, keys and lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def minted(*parts: Column | str) -> Column:
    """An id that a recomputed task mints again alike: the md5 of its parts, written as a UUID."""
    text = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.regexp_replace(F.md5(text), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def restamped(df: DataFrame, *parts: Column | str) -> DataFrame:
    """source_ids becomes the old id alone, and id a new one; both read the old row."""
    return df.withColumns({"source_ids": F.array("id"), "id": minted(*parts)})


def stage_topic(exchange: Column, pair: Column, stage: str) -> Column:
    return F.format_string(f"ex%d-p%d-{stage}", exchange, pair)


def side_topic(pair: Column, side: Column, merged: bool = False) -> Column:
    return F.concat(F.lit("p"), pair.cast("string"), F.lit("-"), side, F.lit("-merged" if merged else ""))


def pair_key(exchange: Column, pair: Column) -> Column:
    return F.concat_ws("|", exchange.cast("string"), pair.cast("string"))
