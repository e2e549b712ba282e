"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

import hashlib

import pytest
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F

from quaybook.llm import bpe, langid, media, near_dedup, warc
from quaybook.llm.line_dedup import dedup_lines
from quaybook.llm.mixing import mix_sources
from quaybook.llm.pii import find_pii
from quaybook.llm.repetition import repetition
from quaybook.llm.suffix_dedup import dedup_substrings

BPE = tokenizer_path("byte_bpe_50k.json")
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards quietly box with five large jugs near the old harbour wall"
LONG = " ".join(f"word{i} follows number {i * 7919 % 10007}" for i in range(12_000))
ROWS = [
    (1, PROSE, "en", "web", 10),
    (2, None, "en", "web", None),
    (3, "", None, None, 0),
    (None, "der schnelle braune Fuchs springt über den faulen Hund", "de", None, None),
    (5, PROSE * 6, "en", "books", 99),
    (5, PROSE * 6, "en", "books", 99),
    (6, LONG, None, "web", len(LONG)),
    (7, "123 456 !!! \n\n\t", None, "web", 5),
    (8, "İstanbul \U0001f600 中文 naïve", None, "web", 5),
    (9, "a", "en", "web", 1),
]
CLASHING = "score lang_pred block slot position n_lines n_dropped class_id k1 k2 spans n_words kept id label _key _k1 _n _of _lines _kept _source _rank _md5 _text".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for c in CLASHING})


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def passed(out, but=()):
    """The clashing columns of out hold what they held."""
    for c in set(CLASHING) - set(but):
        assert c in out.columns
        assert out.where(~F.startswith(F.col(c), F.lit(c)) | F.col(c).isNull()).isEmpty(), c


def test_language_id(docs, none):
    model = langid.fit(docs)
    out = langid.identify(docs, model)
    rows = out.collect()
    assert len(rows) == len(ROWS)
    passed(out, {"score", "lang_pred"})
    for r in rows:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))), r
    assert langid.identify(none, langid.fit(none)).isEmpty()
    assert {r.lang_pred for r in langid.identify(docs, langid.fit(none)).collect()} == {"und"}


def test_media(docs, none):
    rows = media.read_media(media.with_png(docs)).collect()
    assert len(rows) == len(ROWS)
    want = sorted(hashlib.sha256(media.pad((r[1] or "").encode())).hexdigest() for r in ROWS)
    assert sorted(r.payload_sha256 for r in rows) == want
    assert all(r.error is None and r.payload_bytes % 64 == 0 and r.payload_bytes >= 64 for r in rows)
    assert media.read_media(media.with_png(none)).isEmpty()


def test_damaged_media(docs):
    stored = media.with_png(docs.where("doc_id = 1"))
    whole = stored.first().media
    damaged = whole[:60] + bytes([whole[60] ^ 1]) + whole[61:]
    spark = docs.sparkSession
    rows = media.read_media(spark.createDataFrame([(1, 5, damaged), (2, 5, whole[:30]), (3, 5, None), (4, 5, b"")], stored.schema)).collect()
    assert all(r.error and r.payload_sha256 is None for r in rows)


def test_substrings(docs, none):
    rows = dedup_substrings(docs).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        if r.doc_id == 5:  # two equal rows, and each repeats itself
            assert (r.n_removed, r.n_spans) == (r.n_bytes, 1)
        else:
            assert (r.n_removed, r.n_spans) == (0, 0)
    assert dedup_substrings(none).isEmpty()


def test_warc(spark):
    pages = [(1, "u", "x" * 10), (2, None, "x" * 10), (3, "a b", None), (4, "v", ""), (None, "w", "x" * 10), (None, "w", "alone"), (1, "u", "x" * 10), (9, "long", "y" * 600_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("bundle", F.lit(1)).withColumn("data", F.lit("d"))
    rows = warc.read_bundles(warc.write_bundles(warc.with_responses(df), bundle_bytes=1000)).collect()
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in rows)
    assert got == sorted([(1, 10, "response", 0), (2, 10, "revisit", 1), (3, 0, "response", 0), (4, 0, "revisit", 3), (0, 10, "revisit", 1), (0, 5, "response", 0), (1, 10, "response", 0), (9, 600_000, "response", 0)])
    assert all(r.payload_digest == warc.digest({0: b"", 5: b"alone", 10: b"x" * 10, 600_000: b"y" * 600_000}[r.payload_bytes]) for r in rows)
    assert warc.read_bundles(warc.write_bundles(warc.with_responses(df.where("false")))).isEmpty()


def test_repetition(docs, none):
    rows = repetition(docs).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[2].n_words, by_id[2].kept, by_id[3].base_failed) == (0, False, True)
    assert by_id[5].base_failed and not by_id[5].kept
    assert by_id[6].n_words == len(LONG.split())
    assert repetition(none).isEmpty()


def test_near_duplicates(docs, none):
    rows = near_dedup.classes(docs).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    assert {by_id[i].class_id for i in (2, 3)} == {2}  # null and empty texts are equal
    assert by_id[5].class_rows >= 2
    out = near_dedup.keep_one(docs)
    assert len(out.collect()) == len({(r.class_id, r.r1) for r in rows})
    passed(out)
    assert near_dedup.keep_one(none).isEmpty()
    assert near_dedup.classes(none).isEmpty()


def test_mixing(docs, none):
    out = mix_sources(docs, block=2)
    rows = out.collect()
    assert sorted(r.position for r in rows) == list(range(len(ROWS)))
    passed(out, {"block", "slot", "position"})
    assert mix_sources(none).isEmpty()


def test_bpe(docs, none):
    encoded = bpe.encode_texts(docs, BPE)
    rows = bpe.decode_ids(encoded, BPE).collect()
    assert sorted(r.text for r in rows) == sorted(r[1] or "" for r in ROWS)
    assert bpe.digests(bpe.encode_texts(none, BPE), BPE).isEmpty()
    empty = bpe.digests(encoded.where("doc_id = 2"), BPE).first()
    assert (empty.n_tokens, empty.ids_sha256, empty.decoded_sha256) == (0, hashlib.sha256().hexdigest(), hashlib.sha256().hexdigest())


def test_pii(docs, none):
    rows = find_pii(docs).collect()
    assert len(rows) == len(ROWS)
    assert all(r.base_sha256 == hashlib.sha256().hexdigest() for r in rows if r.doc_id in (2, 3))
    assert find_pii(none).isEmpty()


def test_lines(docs, none):
    out = dedup_lines(docs, least=2, ratio=0.5)
    rows = out.collect()
    assert len(rows) == len(ROWS)
    passed(out, {"n_lines", "n_dropped"})
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[2].text, by_id[2].n_lines) == (None, 0)
    assert by_id[5].text == ""  # on both pages of its host
    assert by_id[6].text == LONG
    assert dedup_lines(none).isEmpty()
