"""The trie of conversations against one of nested dicts."""

import hashlib
import random
import zlib

import pytest

from quaybook.llm.prefix_trie import prefix_trie, rebuilt, turn_lists

SCHEMA = "conv_id long, turn long, role string, text string, node string, path string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain(rows, mix=True):
    """Rows of the nodes, by walking every beginning."""
    own = {}
    for conv, turn, role, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "")):
        own.setdefault(conv, []).append((role or "", text or ""))
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seqs[c] = (*own.get(c - c % 5, [])[:h], *turns[h:]) if mix else tuple(turns)
    nodes = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        under = [p for p in nodes if p[: len(path)] == path]
        leaves = [p for p in under if all(len(seqs[c]) == len(p) for c in nodes[p])]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in under if p)
        ends = sorted(c for c in members if seqs[c] == path)
        kids = sum(len(p) == len(path) + 1 for p in under)
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), kids, len(leaves), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(map(str, out))


def found(df, mix=True):
    lists = turn_lists(df)
    return prefix_trie(rebuilt(lists) if mix else lists)


def some(seed, n, turns):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(1000), n):
        for t in range(rng.choice(turns)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "ccc"]), "x", "y"))
    return rows


@pytest.mark.parametrize("mix", [True, False])
@pytest.mark.parametrize("rows", [some(1, 150, range(5)), some(2, 80, [0, 1, 12]), [(c, 0, "user", "same", "", "") for c in range(300)], [(-7, 0, "u", "x", "", ""), (12, 3, None, None, "", ""), (12, None, "u", "first", "", "")], [(1, t, "u", "longer", "", "") for t in range(1500)] + [(2, t, "u", "longer", "", "") for t in range(900)]])
def test_nodes(spark, rows, mix):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if len(rows) > 1000:  # many turns: the walk over all beginnings would take long
        got = found(df, mix=False).collect()
        assert len(got) == 1501
        assert {r.n_convs for r in got if r.depth <= 900} == {2}
        assert next(r.saved_tokens for r in got if r.depth == 0) == 900 * 6
        return
    nodes = found(df, mix)
    got = nodes.collect()
    assert sorted(str(tuple(r[c] for c in COLUMNS)) for r in got) == plain(rows, mix)
    assert sorted(r.rank for r in got) == list(range(1, len(got) + 1))
    by_key = {r.node: r for r in got}
    for r in got:  # intervals nest as the nodes do
        assert sum(r.rank <= x.rank <= r.end for x in got) == sum(1 for x in got if r.node in lineage(by_key, x))


def lineage(by_key, r):
    out = [r.node]
    while r.parent is not None:
        r = by_key[r.parent]
        out.append(r.node)
    return out


def test_edges(spark):
    df = spark.createDataFrame([(None, 0, "u", "x", "", ""), (3, 1, "u", "z" * 300_000, "", ""), (3, 1, "u", "z" * 300_000, "", ""), (4, 0, "u", "y", "", "")], SCHEMA)
    got = {(r.conv_id, r.depth): r for r in found(df, mix=False).collect()}
    assert set(got) == {(3, 0), (3, 1), (3, 2), (4, 1)}  # no conversation without id; repeated turns count
    assert got[3, 0].n_leaves == 2
    assert found(df.where("false")).isEmpty()
    none = found(df.where("conv_id IS NULL"), mix=False)
    assert none.isEmpty()
