"""Packing: whole documents, gapless sequences, limits, little padding, ids as the library has them."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quaybook.llm import packing, queries

SF = "/root/testdata/sf0.001"
PATH = tokenizer_path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def held(rows, want, limits, key="doc_id"):
    """Pieces tile the examples (key, ids, ids of the prompt) and fill sequences without gaps, within limits."""
    by_key, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_key[r[key]].append(r)
        by_sequence[r.sequence_id].append(r)
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids, _ in want)
    once = {k: (ids, p) for k, ids, p in want if sum(k == x for x, *_ in want) == 1}
    for k, (ids, prompt) in once.items():
        at = 0
        for r in sorted(by_key[k], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : at], "<u4").tobytes())
            assert r.n_loss == sum(i >= prompt for i in range(r.start, at))
        assert at == len(ids)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1]]
        assert min(r.length for r in pieces) >= 1
        assert sum(r.length for r in pieces) <= limits[0]
        assert len(pieces) <= limits[1]
        assert sum(r.n_loss for r in pieces) <= limits[2]
    return by_sequence


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sequences = held(queries.op11_vector_packing(spark, SF).collect(), [(d.doc_id, ids_of(d.text), 0) for d in docs], packing.LIMITS)
    totals = [sum(r.length for r in pieces) for pieces in sequences.values()]
    assert all(n == 4096 or n & (n - 1) == 0 for n in totals)
    assert sum(n < 4096 for n in totals) <= 12 * 8


TEXTS = ["plain words, and more", "", None, "It's 'S fine; don't", "a<|endoftext|>b <|startoftext|>", "naïve café é ́x", "tab\tnbsp thin line sep\x1c\x85x", "ΑΣ İI ﬁ 中文字 ١٢٣", "\U0001f600\U0001f468‍\U0001f469", " \n\r\x0b\x0c ", "!!!...???", "x" * 9000, "\x00 \x01", "한한"]


def test_ids_are_the_librarys(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    held(packing.pack_examples(df, PATH).collect(), [(i, ids_of(t), 0) for i, t in enumerate(TEXTS)], packing.LIMITS)


@pytest.mark.parametrize("limits", [(64, 4, 64), (100, 3, 40), (50, 100, 7), (4096, 1, 4096), (1, 1, 1)])
@pytest.mark.parametrize("cut", [True, False])
def test_limits(spark, limits, cut):
    rng = np.random.default_rng(limits[0])
    words = ["alpha", "beta", "gamma", "delta"]
    said = [(i, " ".join(rng.choice(words, rng.integers(0, 60))), " ".join(rng.choice(words, rng.integers(0, 30)))) for i in range(150)]
    df = spark.createDataFrame(said, "doc_id long, prompt string, text string").repartition(3)
    out = packing.pack_examples(df, PATH, prompt="prompt", limits=limits, cut=cut)
    want = [(i, [*ids_of(p)[:-1], *ids_of(t)], len(ids_of(p)) - 1) for i, p, t in said]
    rows = out.collect()
    sequences = held(rows, want, limits)
    if cut:  # full, or of a length that needs no padding
        assert all((n := sum(r.length for r in s)) == limits[0] or n & (n - 1) == 0 for s in sequences.values())
    else:  # cut only where an example by itself is beyond a limit
        over = {k for k, ids, p in want if len(ids) > limits[0] or len(ids) - p > limits[2]}
        assert {r.doc_id for r in rows if r.length < r.doc_tokens} <= over
    whole = {r.sequence_id: r for r in packing.sequences(out).collect()}
    for k, pieces in sequences.items():
        assert whole[k].ids == [i for r in pieces for i in r.ids]
        assert [whole[k].segments.count(i + 1) for i in range(len(pieces))] == [r.length for r in pieces]
        assert sum(whole[k].loss) == sum(r.n_loss for r in pieces)


def test_long_examples_first_when_segments_are_scarce():
    """With two segments a sequence, a long example goes with another, not with a short one."""
    pool = packing.Pool((100, 2, 100), cut=False)
    pool.add([packing.Example(i, np.zeros(n, np.int32), 0) for i, n in enumerate([5, 60, 5, 40, 5, 50, 50, 95])])
    while pool.waiting:
        pool.fill()
    assert sorted(sorted(n for _, _, n in s) for s in pool.taken()) == [[5, 5], [5, 95], [40, 60], [50, 50]]


def test_edges(spark):
    rows = [(1, "one two", "x"), (1, "one two", "x"), (None, None, None), (None, "", "y"), (2, "w " * 30_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string").withColumns({c: F.lit("kept") for c in ("length", "offset", "ids", "sequence_id")})
    out = packing.pack_examples(df, PATH)
    held(out.collect(), [(k, ids_of(t), 0) for k, t, _ in rows], packing.LIMITS)
    assert packing.pack_examples(df.where("false"), PATH).isEmpty()
    assert packing.sequences(packing.pack_examples(df.where("false"), PATH)).isEmpty()
    with pytest.raises(ValueError, match="limit"):
        packing.pack_examples(df, PATH, limits=(0, 1, 1))
