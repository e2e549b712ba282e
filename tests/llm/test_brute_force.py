"""Operators that SQL cannot say, against plainer code on small inputs."""

import random
import re
from collections import Counter
from fractions import Fraction
from math import ceil

import numpy as np
import pytest
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quaybook.llm import bpe, media, mixing, near_dedup, queries, warc
from quaybook.llm.line_dedup import dedup_lines
from quaybook.llm.mixing import mix_sources

SF = "/root/testdata/sf0.001"
BPE = tokenizer_path("byte_bpe_50k.json")


def test_language_accuracy(spark):
    """Held-out documents of known language; the labels of a few copied or damaged ones are noise."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    found = queries.op1_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 100
    assert right > 0.95


def plain_unfilter(rows):
    """Sample by sample, as the PNG specification has it."""
    out = []
    for kind, *line in rows.tolist():
        above = out[-1] if out else [0] * len(line)
        done = []
        for i, x in enumerate(line):
            a, b, c = done[i - 1] if i else 0, above[i], above[i - 1] if i else 0
            p = a + b - c
            paeth = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - c) else b if abs(p - b) <= abs(p - c) else c
            done.append((x + (0, a, b, (a + b) // 2, paeth)[kind]) & 255)
        out.append(done)
    return np.array(out, np.uint8)


def test_unfilter():
    r = np.random.default_rng(1)
    for kinds in ([0, 1, 2, 3, 4] * 3, [2] * 9, [1] * 5, [4, 4, 3, 3, 2, 2, 1, 1, 0]):
        rows = r.integers(0, 256, (len(kinds), 1 + 64), dtype=np.uint8)
        rows[:, 0] = kinds
        assert (media.unfilter(rows) == plain_unfilter(rows)).all()


def test_near_duplicate_classes(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    bodies = []
    for _ in range(40):
        base = r.choices(words, k=r.randint(60, 500))
        bodies.append(" ".join(base))
        for edits in r.sample([0, 1, 2, 3, 12, 40], 3):
            copy = list(base)
            for _ in range(edits):
                copy[r.randrange(len(copy))] = r.choice(words)
            bodies.append(" ".join(copy))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (b.split() for b in bodies)]
    parent = list(range(len(bodies)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(bodies)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = near_dedup.classes(spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: root(i) for i in range(len(bodies))}


def test_one_large_group_of_copies(spark):
    r = random.Random(6)
    base = [f"w{r.randrange(5000)}" for _ in range(200)]
    rows = [(i, " ".join([*base[:i], "changed", *base[i + 1 :]])) for i in range(200)] + [(200 + i, " ".join(base)) for i in range(100)]
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.class_id, r.class_rows) for r in got} == {(0, 300)}


def test_large_group_without_a_hub(spark):
    """Versions of a template that isn't there: pairs lie around 0.8, one or two in a hundred above, and no text is like most others."""
    r = random.Random(11)
    size, n = 2000, 200
    bodies, kept = [], np.ones((size, n - 4), np.float32)
    for i in range(size):
        places = r.sample(range(n), 3)
        bodies.append(" ".join(f"new{i}x{j}" if j in places else f"w{j}" for j in range(n)))
        for j in places:
            kept[i, max(0, j - 4) : j + 1] = 0
    both = kept @ kept.T
    linked = both >= 0.8 * (2 * (n - 4) - both)
    want = list(range(size))
    for i in range(size):  # flood from each text that isn't in a class yet
        todo = [i] if want[i] == i else []
        while todo:
            for k in np.flatnonzero(linked[todo.pop()]).tolist():
                if want[k] == k and k != i:
                    want[k] = i
                    todo.append(k)
    got = near_dedup.classes(spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == dict(enumerate(want))


def test_order_decides(spark):
    """A copy that repeats a line stays one, for shingles count once; texts of the same sections in another order align too little."""
    r = random.Random(12)
    bodies = []
    for _ in range(40):
        a, b, c = ([f"w{r.randrange(10**6)}" for _ in range(100)] for _ in range(3))
        bodies += [a + b + c, c + b + a]
        line = [f"w{r.randrange(10**6)}" for _ in range(5)]
        bodies += [a[:99] + line, a[:99] + line * 60]
    rows = [(i, " ".join(b)) for i, b in enumerate(bodies)]
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: i - i % 2 * (i % 4 > 1) for i in range(len(bodies))}


def edit_similarity(left, right):
    """By plain dynamic programming: different shingles matched in order, over those of both."""
    left, right = (list(dict.fromkeys(x)) for x in (left, right))
    row = [0] * (len(right) + 1)
    for x in left:
        before = row[:]
        for j, y in enumerate(right):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1] / max(1, len(left) + len(right) - row[-1])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_recall_on_documents(spark, sf):
    """Every pair of documents that dynamic programming finds similar is in one class, and every class is made of such pairs."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    body = {r.doc_id: r.text or "" for r in docs.collect()}
    words = {k: re.findall(r"(?:[^\W_]|[^\x00-\x7f])+", t.lower()) for k, t in body.items()}
    rows = {k: [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else [] for k, w in words.items()}
    where = {}
    for k, found in rows.items():
        for x in set(found):
            where.setdefault(x, set()).add(k)
    parent = {k: k for k in body}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    pairs = 0
    for k, found in rows.items():
        shared = Counter(o for x in set(found) for o in where[x] if o < k)
        for o, n in shared.items():
            if n >= 0.8 * (len(set(found)) + len(set(rows[o])) - n) and (found == rows[o] or edit_similarity(found, rows[o]) >= 0.8):
                pairs += 1
                a, b = sorted((root(k), root(o)))
                parent[b] = a
    wordless = {}
    for k in body:
        if not rows[k]:
            parent[root(k)] = root(wordless.setdefault(body[k], k))
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    assert pairs > 10
    assert got == {k: min(o for o in body if root(o) == root(k)) for k in body}


def test_bpe_against_the_library(spark):
    odd = ["", " ", "a" * 5000, "<|endoftext|> x<|endoftext|>", "don't  stop\n\n  now", "é中\U0001f600‍́", "x\ty 12345,678", "'s 'S ’s", "    indented\r\n"]
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").unionByName(spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text"))
    tok = Tokenizer.from_file(BPE)
    tok.no_truncation()
    tok.no_padding()
    want = {r.doc_id: tok.encode(r.text or "", add_special_tokens=False).ids for r in df.collect()}
    got = {r.doc_id: r.ids for r in bpe.encode_texts(df, BPE).collect()}
    assert got == want
    decoded = {r.doc_id: r.text for r in bpe.decode_ids(bpe.encode_texts(df, BPE), BPE).collect()}
    assert decoded == {k: tok.decode(v, skip_special_tokens=False) for k, v in want.items()}


def test_pfair_lag(spark):
    """No source is ever a whole block from its weight times the slots so far, while all have documents left."""
    weights = {"a": 5.0, "b": 3.0, "c": 1.0}
    rows = [(i, "aaaaabbbc"[i % 9]) for i in range(1800)]
    got = mix_sources(spark.createDataFrame(rows, "doc_id long, source string"), weights=weights, block=4, period=9).select("source", "slot").distinct().collect()
    slots = {r.slot: r.source for r in got}
    assert sorted(slots) == list(range(len(slots)))
    had = dict.fromkeys(weights, 0)
    for t in range(len(slots)):
        ready = [s for s in sorted(weights) if had[s] * 9 < (t + 1) * weights[s]]
        due = min(ready, key=lambda s: (ceil(Fraction(9 * (had[s] + 1)) / Fraction(weights[s])), s))
        assert slots[t] == due, t
        had[due] += 1
        assert all(abs(had[s] - weights[s] * (t + 1) / 9) < 1 for s in weights)


@pytest.mark.parametrize(("weights", "period"), [({"s0": 430, **{f"s{i}": 1 for i in range(1, 1001)}}, 1430), ({"s0": 0.999, "s1": 0.001}, 1000), ({"s0": 0.2, "s1": 0.7, None: 0.1}, 10), ({"s0": 2.5}, 7)])
def test_pfair_lag_of_exact_weights(spark, weights, period):
    """Against the weights as given, also for many small sources and small shares: two periods of blocks of one document."""
    shares = {**weights, "s9": 1} if weights == {"s0": 2.5} else weights
    total = sum(Fraction(str(w)) for w in shares.values())
    rows = [s for s, w in shares.items() for _ in range(int(2 * period * Fraction(str(w)) / total))]
    got = mix_sources(spark.createDataFrame(list(enumerate(rows)), "doc_id long, source string"), weights=weights, block=1).select("source", "slot", "position").collect()
    assert sorted(r.slot for r in got) == list(range(2 * period))
    assert all(r.slot == r.position for r in got)
    order = {s: i for i, s in enumerate(shares)}
    want = np.array([float(Fraction(str(w)) / total) for w in shares.values()])
    had = np.zeros(len(want))
    for row in sorted(got, key=lambda r: r.slot):
        had[order[row.source]] += 1
        assert np.abs(had - want * (row.slot + 1)).max() < 1


def test_pfair_of_finer_weights(spark):
    """Weights without a short period are rounded to MAX_PERIOD slots."""
    rows = [(i, "ab"[i % 2]) for i in range(40)]
    out = mixing.schedule(spark.createDataFrame(rows, "n long, source string").groupBy("source").agg(F.count("*").alias("n")), {"a": 0.1234567891, "b": 3.3})
    shares = {r.source: r.k for r in out.collect()}
    assert abs(shares["a"] / sum(shares.values()) - 0.1234567891 / 3.4234567891) <= 1 / mixing.MAX_PERIOD
    assert sum(shares.values()) in range(mixing.MAX_PERIOD - 1, mixing.MAX_PERIOD + 2)


def test_lines(spark):
    r = random.Random(7)
    rows = [(i, f"h{i % 3}", "\n".join([f"menu {i % 3}", *(f"line {r.randrange(40)}" for _ in range(5)), f"own {i}", "", "Menu"])) for i in range(90)]
    counts, pages = {}, {}
    for _, host, text in rows:
        pages[host] = pages.get(host, 0) + 1
        for line in set(text.split("\n")):
            counts[host, line] = counts.get((host, line), 0) + 1
    want = {i: "\n".join(x for x in text.split("\n") if not x.strip() or counts[host, x] <= 0.1 * pages[host]) for i, host, text in rows}
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert {r.doc_id: r.text for r in got} == want


def test_seek_one_record(spark):
    """A record is found by its index entry alone: one frame is read."""
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * 50) for i in range(200)], "page_id long, url string, html string")
    bundles = warc.write_bundles(warc.with_responses(pages.coalesce(1)), frame_bytes=5000, bundle_bytes=50_000).cache()
    entry = warc.index(bundles).where("page_id = 137").first()
    data = bundles.where(F.col("bundle") == entry.bundle).first().data
    assert entry.frame_at == warc.seek_table(data)[entry.frame][0]
    (fields, _, payload), *more = warc.read_records(warc.read_frame(data, entry.frame)[entry.at : entry.at + entry.length])
    assert (payload.decode(), fields["WARC-Page-ID"], more) == ("page 137 " * 50, "137", [])


def test_pipeline_stages(spark):
    import corpus_pipeline

    clashing = ("score", "lang_pred", "n_lines", "block", "position", "class_id", "k1")
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in clashing})
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = near_dedup.table(stage(spark, docs, SF), re.sub(r"\W", "-", name))
        assert out.columns == docs.columns
        assert out.where(" OR ".join(f"{c} <> concat('{c}', doc_id)" for c in clashing)).isEmpty()
        n = out.count()
        assert n <= before
        if name in ("line dedup", "mixing"):
            assert n == before
        docs, before = out, n
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == before
    classes = near_dedup.classes(docs)
    assert classes.where("class_rows > 1").isEmpty()
