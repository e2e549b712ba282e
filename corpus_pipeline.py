"""A training-data pipeline over documents: five operators, one after another.

Each stage is written to the shared folder and read again, so a lost executor costs no
more than the stage that runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaybook.llm import bpe, langid
from quaybook.llm.common import documents, small_batches, table
from quaybook.llm.line_dedup import dedup_lines
from quaybook.llm.mixing import mix_sources
from quaybook.llm.near_dedup import keep_one

#: Texts are rejected whose words tell less about their language than this, from 0 to 1; prose scores 0.6 to 1.
MIN_SCORE = 0.3


def _beside(docs: DataFrame, made: tuple[str, ...], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """operator(docs) for one that makes columns of the names `made`: columns of docs with these names come back as they were."""
    aside = {c: f"{c}_{uuid.uuid4().hex}" for c in docs.columns if c in made}
    return operator(docs.withColumnsRenamed(aside)).drop(*made).withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; a missing label is filled in.

    Null, empty and letterless texts go, as no language is found in them; repeated rows are
    judged alike. Without any labelled row every document goes; an empty table stays empty.
    """
    small_batches(spark)

    def judged(named: DataFrame) -> DataFrame:
        found = langid.identify(named, langid.fit(named)).where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_SCORE))
        return found.withColumn("lang", F.coalesce("lang", "lang_pred"))

    return _beside(docs, ("lang_pred", "score"), judged)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; n_chars counts what is left.

    A null text stays null, an emptied one is empty; no row goes, repeated ones count as pages each.
    """
    changed = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return _beside(docs, ("n_lines", "n_dropped"), lambda named: dedup_lines(named).withColumn("n_chars", changed))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: null and empty texts are one class, and so are repeated rows."""
    small_batches(spark)
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: files and rows stand by position. Null sources are one source; no row goes."""
    return _beside(docs, ("block", "slot", "position"), lambda named: mix_sources(named).repartitionByRange("position").sortWithinPartitions("position"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, with digests of them and of the text that they decode to; a null text is an empty one."""
    small_batches(spark)
    path = tokenizer_path("byte_bpe_50k.json")
    return bpe.digests(bpe.encode_texts(docs, path), path, with_ids=True)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing", mixing),
    ("BPE", bpe_encoding),
]

#: A language model, sketches and merge rounds are beyond SQL: tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
