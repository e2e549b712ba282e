import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quaybook.llm import suffix_dedup as sd


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int(gone[0]) + int(np.sum(gone[1:] & ~gone[:-1])) if len(d) else 0
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(d, np.uint8)[~gone])).hexdigest()))
    return out


def sample(rng, n, length):
    words = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(length // 3))
    texts = [None, "", "short", "a" * (3 * length), passage[: length - 1]]
    for _ in range(n):
        body = " ".join(rng.choice(words) for _ in range(rng.randint(1, length)))
        kind = rng.random()
        if kind < 0.3:
            cut = rng.randint(0, len(body))
            a = rng.randint(0, len(passage) // 2)
            body = body[:cut] + passage[a : a + rng.randint(length // 2, 2 * length)] + body[cut:]
        elif kind < 0.5 and texts[-1]:
            body = texts[rng.randrange(3, len(texts))] + rng.choice(["", "x", " more"])
        elif kind < 0.6:
            body = body[: rng.randint(1, 30)] * rng.randint(2, 30)
        texts.append(body)
    return texts


def test_suffixes_match_brute_force():
    rng = random.Random(2)
    for depth in (1, 3, 9, 40):
        for _ in range(60):
            parts = ["".join(rng.choice("ab" if rng.random() < 0.5 else "abcd") for _ in range(rng.randint(0, 50))) for _ in range(rng.randint(1, 4))]
            sizes = np.array([len(p) for p in parts])
            text = "".join(parts)
            ends = np.repeat(np.cumsum(sizes), sizes)
            s = sd.Suffixes(np.frombuffer(text.encode(), np.uint8), ends, depth)
            suffix = [text[i : min(ends[i], i + depth)] for i in range(len(text))]
            assert s.order.tolist() == sorted(range(len(text)), key=lambda i: (suffix[i], i))

            def lcp(i, j, suffix=suffix):
                n = 0
                while n < min(len(suffix[i]), len(suffix[j])) and suffix[i][n] == suffix[j][n]:
                    n += 1
                return n

            for later in (False, True):
                want = [max([0, *(lcp(i, j) for j in (range(i + 1, len(text)) if later else range(i)))]) for i in range(len(text))]
                assert s.longest_factors()[later].tolist() == want
                only = sd.Suffixes(np.frombuffer(text.encode(), np.uint8), ends, depth, whole=True)  # matches of full length, and no others
                assert (only.longest_factors()[later] >= depth).tolist() == [w >= depth for w in want]


def test_nearest_smaller():
    rng = random.Random(3)
    for values in ([], [1, 2, 3, 0], [*range(500), -1], list(range(500, 0, -1)), rng.sample(range(300), 300)):
        table = sd._minima_table(np.array(values, np.int64))
        n = len(values)
        assert sd._smaller(table).tolist() == [max([-1, *(j for j in range(i) if values[j] < v)]) for i, v in enumerate(values)]
        assert sd._smaller(table, after=True).tolist() == [min([n, *(j for j in range(i + 1, n) if values[j] < v)]) for i, v in enumerate(values)]
        ends = [sorted(rng.sample(range(n + 1), 2)) for _ in range(50)] if n else []
        if ends:
            assert sd._least(table, *np.array(ends).T).tolist() == [min(values[a:b]) for a, b in ends]


@pytest.mark.parametrize(("length", "word", "group"), [(40, 20, 2000), (40, 11, 3), (64, 32, 0)])
def test_matches_brute_force(spark, length, word, group):
    texts = sample(random.Random(length + group), 60, length)
    rows = [(None if i % 17 == 3 else i, t, "x", 1) for i, t in enumerate(texts)]
    got = sd.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string, k1 string, span int"), length=length, word=word, group=group).collect()
    want = sorted((-1 if r[0] is None else r[0], *w) for r, w in zip(rows, brute(texts, length), strict=True))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


@pytest.mark.parametrize("group", [2000, 0])
def test_keep_first(spark, group):
    """Of each repeated string at most one place stays, only repeated strings go, and a passage stays in one text."""
    length = 40
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdef") for _ in range(70))
    texts = [*sample(rng, 50, length), *("".join(rng.choice("ghijkl") for _ in range(90)) + f"{i}{passage}{i}" + "".join(rng.choice("mnopqr") for _ in range(90)) for i in range(3))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept_first = {r.doc_id: r for r in sd.dedup_substrings(df, length=length, word=20, group=group, keep_first=True).collect()}
    everything = {r.doc_id: r for r in sd.dedup_substrings(df, length=length, word=20, group=group).collect()}
    left = Counter()
    for i, t in enumerate(texts):
        d = (t or "").encode()
        gone = np.zeros((2, len(d)), bool)
        for flags, row in zip(gone, (kept_first[i], everything[i]), strict=True):
            for x in row.spans:
                flags[x.begin : x.end] = True
        assert not (gone[0] & ~gone[1]).any()
        for at in range(len(d) - length + 1):
            left[d[at : at + length]] += not gone[0, at : at + length].all()
    assert max(left.values()) == 1
    assert sorted(kept_first[i].n_removed for i in range(len(texts) - 3, len(texts))) == [0, len(passage), len(passage)]


def test_query_against_brute_force(spark):
    """The registered query over a whole table, by plain windows."""
    from quaybook.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: w for r, w in zip(rows, brute([r.text for r in rows], 400), strict=True)}
    got = queries.op3_suffix_dedup(spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    assert all(r.n_removed or r.text == (s.text or "") for r in got for s in rows if s.doc_id == r.doc_id)


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 100)
    rng = random.Random(4)
    text = "".join(rng.choice("abc") for _ in range(900))
    texts = [text, text[200:500], "z" + text[650:700]]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    starts = np.cumsum([0, *map(len, texts)])
    found = set()
    for part, at, shift, row in sd._pieces(raw, starts, 40):
        for doc, _, _, first, last in zip(*sd.cut(part, at, 40, 20), strict=True):
            found |= {(int(doc) + row, int(w) - int(at[doc]) + shift) for w in range(first, last)}
    assert found == {(i, w) for i, t in enumerate(texts) for w in range(len(t) - 39)}


def test_empty_table(spark):
    assert sd.dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).count() == 0
