"""Every stage of the pipeline on an empty table, null keys and texts, repeated and very long rows."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quaybook.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards quietly box with five large jugs near the old harbour wall"
ROWS = [
    (1, PROSE, "en", "web", 10), (None, PROSE + " again and again", "en", None, None), (None, None, None, None, None), (4, "", "en", "web", 0),
    (5, "der schnelle braune Fuchs springt über den faulen Hund und bellt dann sehr laut vor dem alten Haus am See", "de", "books", 9),
    (6, " ".join(f"{w}{i % 977}" for i, w in enumerate(PROSE.split() * 1500)), None, "web", 1), (1, PROSE, "en", "web", 10),
    (8, "\n".join(["Another page tells of rain and wind over the northern hills while sheep sleep", "menu line", PROSE[::-1]]), "en", "web", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_empty_table(spark, docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs.where("false"), "")
    assert out.isEmpty()
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns


def test_nulls_repeats_and_long_texts(spark, docs):
    rows, kept = docs, None
    for name, stage in corpus_pipeline.STAGES:
        before = rows.count()
        rows = table(stage(spark, rows, ""), re.sub(r"\W", "-", name))
        kept = rows.count()
        assert kept <= before
        if name == "language ID":  # texts without a letter go, null keys stay
            assert rows.where("text IS NULL OR text = ''").isEmpty()
            assert rows.where("doc_id IS NULL").count() == 1
        if name == "MinHash near-dedup":  # repeated rows are one, and the one with the least key stays
            assert rows.where(F.col("text") == PROSE).count() == 1
        if name == "mixing":
            assert kept == before
    assert kept == 4  # three more words make no other class
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert rows.where(F.size("ids") != F.col("n_tokens")).isEmpty()
    assert rows.agg(F.max("n_tokens")).first()[0] > 30_000
