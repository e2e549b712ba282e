"""Near-duplicate documents by Order MinHash and banded alignment.

A text is its sequence of five-word shingles, each labelled with how often it has
occurred before. A sketch value is made of the few shingles with the least hashes, in
the order in which the text has them, so that texts agree on it when they share content
in the same order. Texts that agree on a value stand in a bucket. Pairs are verified by
aligning their shingles inside a band; links make classes by label propagation.

* First every member of a bucket is aligned with the bucket's leader, an arbitrary one.
* Then a bucket may still hold texts of different classes that have not been compared.
  They meet in tiles of bounded size: a tile counts common shingles by matrix products
  and aligns what shares enough, so no row is ever made for a pair that isn't a link.
  Members of a bucket's largest class do not meet each other, and two texts meet only
  in the first bucket that they share. So no link between texts of one bucket is lost.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaybook.llm.common import blocks, drop, mix, rolling, runs, sparing, table, tidily

WORDS = 5
SIMILARITY = 0.8
#: Sketch values of a text, and shingles in each. Texts of similarity 0.8 agree on about half the values, so they miss
#: each other with a chance of about one in a million. Every second value is of first occurrences only, as similarity is.
SKETCHES, PICKED = 20, 3
#: Rows and shingles on either side of a tile.
TILE_ROWS, TILE_SHINGLES = 500, 1_000_000
#: Shingles that a matrix product takes at once.
PRODUCT = 2048

BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_WORD_BYTE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_SEEDS = mix(np.arange(1, 1 + 4096))
_TOP = np.uint64(np.iinfo(np.uint64).max)


def shingles(bodies: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, occurrence) of each shingle in order.

    Words are runs of letters, digits and non-ASCII characters in lower case. A text of
    fewer than WORDS words is one shingle; one without words has none.
    """
    data = [b.lower().encode() for b in bodies]
    starts = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    raw = np.frombuffer(b"".join(data), np.uint8)
    inside = _WORD_BYTE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[starts] = True
    begin = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])[: len(raw)]))
    end = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False)[: len(raw)])) + 1
    sums, inverse = rolling(raw.astype(np.uint64) + np.uint64(1), BYTE_BASE)
    word = mix((sums[end] - sums[begin]) * inverse[begin])
    doc = np.searchsorted(starts, begin, side="right") - 1
    last = np.searchsorted(begin, starts[1:])
    first = np.searchsorted(begin, starts[:-1])
    window = np.flatnonzero((np.arange(len(word)) + WORDS <= last[doc]) | (np.arange(len(word)) == first[doc]))
    stop = np.minimum(window + WORDS, last[doc[window]])
    sums, inverse = rolling(word, WORD_BASE)
    hashed, doc = mix((sums[stop] - sums[window]) * inverse[window]), doc[window]
    key = mix(hashed + _SEEDS[7] * doc.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    new = np.append(True, key[order][1:] != key[order][:-1])[: len(key)]
    occurrence = np.empty(len(key), np.int64)
    occurrence[order] = runs(np.diff(np.append(np.flatnonzero(new), len(key))))
    return doc, hashed, occurrence


def _picks(label: np.ndarray, n: np.ndarray, numbers: range, picked: int) -> np.ndarray:
    """Values with these numbers, a row for each text: of its `picked` labels with the least hashes, in order."""
    out = np.zeros((len(n), len(numbers)), np.uint64)
    some = np.flatnonzero(n)
    if not len(some):
        return out
    at = (np.cumsum(n) - n)[some]
    bits = np.uint64(max(20, len(label).bit_length()))
    place = np.arange(len(label), dtype=np.uint64)
    for column, j in enumerate(numbers):
        v = (label ^ _SEEDS[100 + j]) * _SEEDS[1000 + j] | np.uint64(1)
        v ^= v >> np.uint64(29)
        v *= np.uint64(0xBF58476D1CE4E5B9)
        v = (v >> bits << bits) | place
        chosen = np.empty((picked, len(some)), np.int64)
        for k in range(picked):
            least = np.minimum.reduceat(v, at)
            spot = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            chosen[k] = np.where(least == _TOP, -1, spot)
            v[spot[least != _TOP]] = _TOP
        chosen.sort(axis=0)
        value = np.full(len(some), _SEEDS[j], np.uint64)
        for row in chosen:
            value = np.where(row < 0, value, mix(value * _SEEDS[13] + label[row]))
        out[some, column] = value
    return out


def sketch(bodies: list[str], sketches: int = SKETCHES, picked: int = PICKED) -> tuple[np.ndarray, np.ndarray]:
    """(sketch values of each text, its different shingles): zeros where there is no shingle."""
    doc, hashed, occurrence = shingles(bodies)
    first = occurrence == 0
    n = np.bincount(doc[first], minlength=len(bodies))
    out = np.zeros((len(bodies), sketches), np.uint64)
    out[:, ::2] = _picks(mix(hashed + occurrence.astype(np.uint64)), np.bincount(doc, minlength=len(bodies)), range(0, sketches, 2), picked)
    out[:, 1::2] = _picks(mix(hashed[first]), n, range(1, sketches, 2), picked)
    return out, n


def _rising(values: list[int]) -> int:
    """The length of the longest rising subsequence."""
    tails: list[int] = []
    for v in values:
        i = bisect_left(tails, v)
        tails[i : i + 1] = [v]
    return len(tails)


def align(left: list[str], right: list[str], similarity: float = SIMILARITY) -> np.ndarray:
    """The similarity of each pair of texts: the most different shingles that match in order, over those of both together.

    Shingles stand at their first place. No match leaves a band as wide as `similarity`
    allows insertions. Where even matches out of order would not do, it is that of these.
    """
    pairs = len(left)
    doc, hashed, occurrence = shingles(left + right)
    doc, hashed = doc[occurrence == 0], hashed[occurrence == 0]
    n = np.bincount(doc, minlength=2 * pairs).astype(np.int64)
    place = runs(n)
    total = n[:pairs] + n[pairs:]
    key = mix(hashed + _SEEDS[17] * (doc % max(1, pairs)).astype(np.uint64))
    a, b = np.flatnonzero(doc < pairs), np.flatnonzero(doc >= pairs)
    if len(a) and len(b):
        b = b[np.argsort(key[b])]
        spot = np.minimum(np.searchsorted(key[b], key[a]), len(b) - 1)
        hit = key[b][spot] == key[a]
        a, b = a[hit], b[spot[hit]]
    else:
        a = b = a[:0]
    pair, i, j = doc[a], place[a], place[b]
    near = np.abs(i - j) <= (1 - similarity) * total[pair] + 1
    pair, j = pair[near], j[near]
    matched = np.bincount(pair, minlength=pairs)
    ends = np.cumsum(matched)
    crossed = np.unique(pair[1:][(pair[1:] == pair[:-1]) & (j[1:] < j[:-1])])
    for p in crossed[matched[crossed] >= similarity * (total[crossed] - matched[crossed])]:
        matched[p] = _rising(j[ends[p] - matched[p] : ends[p]].tolist())
    return matched / np.maximum(total - matched, 1)


def marks(bodies: list[str]) -> list[np.ndarray]:
    """32 bits of each of a text's different shingles, in order."""
    doc, hashed, occurrence = shingles(bodies)
    first = occurrence == 0
    ends = np.cumsum(np.bincount(doc[first], minlength=len(bodies)))
    return np.split((hashed[first] >> np.uint64(32)).astype(np.uint32).view(np.int32), ends[:-1])


def _shared_counts(rows: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the rows have in common; a row's values differ."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    _, column, times = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    twice = times[column] > 1
    owner, column = owner[twice], (np.cumsum(times > 1) - 1)[column[twice]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(rows), len(rows)), np.float32)
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, PRODUCT):
        a, b = np.searchsorted(column, (begin, begin + PRODUCT))
        part = np.zeros((len(rows), PRODUCT), np.float32)
        part[owner[a:b], column[a:b] - begin] = 1
        out += part @ part.T
    return out


def tile_links(side: np.ndarray, tags: list[str], values: np.ndarray, number: int, rows: list[np.ndarray], similarity: float = SIMILARITY) -> list[tuple[str, str]]:
    """Pairs of tags that links between a tile's rows connect, no more than are needed to connect them.

    Rows of side 0 meet those of side 1, or each other where there is no side 1. A pair
    of rows meets here only if value `number` is the first on which it agrees.
    """
    kinds, tag = np.unique(np.array(tags), return_inverse=True)
    rows = [r[np.sort(np.unique(r, return_index=True)[1])] for r in rows]
    size = np.array([len(r) for r in rows], np.float32)
    shared = _shared_counts(rows)
    enough = shared >= np.float32(0.9999 * similarity) * (size[:, None] + size[None, :] - shared)
    enough &= (side[:, None] < side[None, :]) if side.any() else np.triu(np.ones(enough.shape, bool), 1)
    enough &= tag[:, None] != tag[None, :]
    a, b = np.nonzero(enough)
    here = (values[a, number] == values[b, number]) & ~(values[a, :number] == values[b, :number]).any(axis=1)
    parent, found = list(range(len(kinds))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for x, y in zip(a[here].tolist(), b[here].tolist(), strict=True):
        p, q = root(tag[x]), root(tag[y])
        if p == q:
            continue
        place = {m: i for i, m in enumerate(rows[y].tolist())}
        band = (1 - similarity) * (len(rows[x]) + len(rows[y])) + 1
        matched = _rising([place[m] for i, m in enumerate(rows[x].tolist()) if m in place and abs(place[m] - i) <= band])
        if matched >= similarity * (len(rows[x]) + len(rows[y]) - matched):
            parent[p] = q
            found.append((str(kinds[tag[x]]), str(kinds[tag[y]])))
    return found


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """docs with (k1, k2), 128 bits that stand for the text."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({"k1": F.xxhash64(body), "k2": F.xxhash64(F.lit(1), body)})


def sketches(keyed: DataFrame) -> DataFrame:
    """(k1, k2, least, rows, n, values): each different text of keyed (key, text, k1, k2), with its least key and its rows."""
    schema = f"key {keyed.schema['key'].dataType.simpleString()}, k1 long, k2 long, n long, values array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            values, n = sketch(batch.column("text").fill_null("").to_pylist())
            ends = pa.array(np.arange(len(n) + 1) * SKETCHES, pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(values.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("k1"), batch.column("k2"), pa.array(n), lists], ["key", "k1", "k2", "n", "values"])

    each = keyed.select("key", "k1", "k2", "text").mapInArrow(tidily(run), schema)
    return each.groupBy("k1", "k2").agg(F.min("key").alias("least"), F.count("*").alias("rows"), F.first("n").alias("n"), F.first("values").alias("values"))


def _buckets(sketched: DataFrame) -> DataFrame:
    """(bucket, j, k1, k2, n, size, l1, l2, ln): the texts of each bucket of at least two, and its leader."""
    each = sketched.where("n > 0").select("k1", "k2", "n", F.posexplode("values").alias("j", "h")).select("k1", "k2", "n", "j", F.xxhash64("j", "h").alias("bucket"))
    heads = each.groupBy("bucket").agg(F.count("*").alias("size"), F.min(F.struct("k1", "k2", "n")).alias("lead")).where("size > 1")
    heads = heads.select("bucket", "size", F.col("lead.k1").alias("l1"), F.col("lead.k2").alias("l2"), F.col("lead.n").alias("ln"))
    return each.join(heads.hint("merge"), "bucket")


#: Whether a text isn't its bucket's leader.
_LED = "(k1 <> l1 OR k2 <> l2)"


def _texts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(k1, k2, text) of the texts `wanted` (k1, k2, least). The least key is a part of the join's key, so copies don't meet."""
    asked = wanted.select("k1", "k2", F.col("least").alias("key"))
    same = (keyed["k1"] == asked["k1"]) & (keyed["k2"] == asked["k2"]) & keyed["key"].eqNullSafe(asked["key"])
    found = keyed.join(asked.hint("merge"), same, "left_semi").select("k1", "k2", F.coalesce("text", F.lit("")).alias("text"))
    return found.groupBy("k1", "k2").agg(F.first("text").alias("text"))


def links(pairs: DataFrame, bodies: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): the pairs (k1, k2, l1, l2) that are similar, as 32 hex digits each. bodies: (k1, k2, text)."""
    lead = bodies.select(F.col("k1").alias("l1"), F.col("k2").alias("l2"), F.col("text").alias("lead"))
    both = pairs.join(bodies.hint("merge"), ["k1", "k2"]).join(lead.hint("merge"), ["l1", "l2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            aligned = align(batch.column("text").to_pylist(), batch.column("lead").to_pylist(), similarity)
            yield batch.select(["a", "b"]).take(pa.array(np.flatnonzero(aligned >= similarity)))

    return both.select(_name("k1", "k2").alias("a"), _name("l1", "l2").alias("b"), "text", "lead").mapInArrow(tidily(run), "a string, b string")


def _name(k1: str, k2: str) -> Column:
    return F.concat(F.lpad(F.hex(k1), 16, "0"), F.lpad(F.hex(k2), 16, "0"))


def components(edges: DataFrame) -> DataFrame:
    """(id, label): each node of (a, b) with the least node that it is connected to.

    Labels pass along edges and then to their own labels' labels, until none changes;
    every round is written to the shared folder, and the one before it deleted.
    """
    both = table(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = table(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label"), F.lit(True).alias("moved")), "labels")
    while not labels.where("moved").isEmpty():
        seen = labels.select(F.col("id").alias("b"), F.col("label").alias("seen"))
        least = both.join(seen, "b").groupBy(F.col("a").alias("id")).agg(F.min("seen").alias("seen"))
        passed = labels.join(least, "id").select("id", "label", F.least("label", "seen").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("label").alias("further"))
        least = F.least("next", "further")
        after = table(passed.join(jump, "next").select("id", least.alias("label"), (least != F.col("label")).alias("moved")), "labels")
        drop(labels)
        labels = after
    drop(both)
    return labels.select("id", "label")


def _tiles(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, j, x, whole, y, side, k1, k2, tag): members of different classes that have not been compared, in tiles.

    A bucket's largest class and the others are each cut into parts of bounded size.
    Part x of the others meets part y of them, or (whole) of the largest class.
    """
    led = buckets.where(f"size > 2 AND {_LED}").withColumn("id", _name("k1", "k2")).join(labels, "id", "left")
    tagged = table(led.select("bucket", "j", "k1", "k2", "n", F.coalesce("label", "id").alias("tag")), "tagged")
    kinds = tagged.groupBy("bucket", "tag").agg(F.count("*").alias("many"), F.sum("n").alias("n"))
    mixed = kinds.groupBy("bucket").agg(F.max(F.struct("many", "n", "tag")).alias("major"), F.sum("many").alias("many"), F.sum("n").alias("n"), F.count("*").alias("kinds")).where("kinds > 1")

    def parts(many: Column, n: Column) -> Column:
        return F.ceil(F.greatest(many / TILE_ROWS, n / TILE_SHINGLES)).cast("int")

    mixed = mixed.select("bucket", F.col("major.tag").alias("major"), parts(F.col("major.many"), F.col("major.n")).alias("major_parts"), parts(F.col("many") - F.col("major.many"), F.col("n") - F.col("major.n")).alias("minor_parts"))
    row = tagged.join(mixed.hint("merge"), "bucket").withColumn("whole", F.col("tag") == F.col("major"))
    row = row.withColumn("part", F.pmod(F.xxhash64("k1", "k2"), F.when(F.col("whole"), F.col("major_parts")).otherwise(F.col("minor_parts"))).cast("int"))

    def spots(n: str, x: Column | None, y: Column | None, whole: bool) -> Column:
        def spot(i: Column) -> Column:
            p, q = (i if x is None else x), (i if y is None else y)
            p, q = (p, q) if whole else (F.least(p, q), F.greatest(p, q))
            side = F.col("whole") if whole else F.col("part") != p
            return F.struct(p.alias("x"), F.lit(whole).alias("whole"), q.alias("y"), side.cast("int").alias("side"))

        return F.transform(F.sequence(F.lit(0), F.col(n) - 1), spot)

    part = F.col("part")
    minor = F.concat(spots("minor_parts", part, None, False), spots("major_parts", part, None, True))
    meets = F.when(F.col("whole"), spots("minor_parts", None, part, True)).otherwise(minor)
    return row.select("bucket", "j", "k1", "k2", "tag", F.explode(meets).alias("spot")).select("bucket", "j", "spot.*", "k1", "k2", "tag")


def _marked(bodies: DataFrame) -> DataFrame:
    """(k1, k2, marks) of bodies (k1, k2, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            found = pa.array(marks(batch.column("text").to_pylist()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), found], ["k1", "k2", "marks"])

    return bodies.mapInArrow(tidily(run), "k1 long, k2 long, marks array<int>")


def _between(tiles: DataFrame, sketched: DataFrame, marked: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): classes that a link inside a tile connects, by their tags."""
    spot = ["bucket", "j", "x", "whole", "y"]
    known = marked.join(sketched.select("k1", "k2", "values"), ["k1", "k2"])
    rows = tiles.join(known.hint("merge"), ["k1", "k2"]).select(*spot, "side", "tag", "values", "marks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now: tuple | None = None

        def done() -> Iterator[pa.RecordBatch]:
            side = np.array([r[0] for r in held])
            found = tile_links(side, [r[1] for r in held], np.stack([r[2] for r in held]), now[1], [r[3] for r in held], similarity)
            held.clear()
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found, strict=True)], ["a", "b"])

        for batch in batches:
            at = zip(*(batch.column(c).to_pylist() for c in spot), strict=True)
            lists = ([x.values.to_numpy() for x in batch.column(c)] for c in ("values", "marks"))
            for here, *row in zip(at, batch.column("side").to_pylist(), batch.column("tag").to_pylist(), *lists, strict=True):
                if here != now:
                    if held:
                        yield from done()
                    now = here
                held.append(tuple(row))
        if held:
            yield from done()

    return rows.repartition(*spot).sortWithinPartitions(*spot).mapInArrow(tidily(run), "a string, b string")


def _labels(keyed: DataFrame, sketched: DataFrame) -> DataFrame:
    """(id, label) of all texts that a link connects with another, by their names."""
    buckets = table(_buckets(sketched), "buckets")
    alike = F.least("n", "ln") >= 0.999 * SIMILARITY * F.greatest("n", "ln")  # so many shingles can be similar enough; the thousandth is for rounding
    pairs = table(buckets.where(_LED).where(alike).select("k1", "k2", "l1", "l2").distinct(), "pairs")
    least = sketched.select("k1", "k2", "least")
    paired = pairs.select("k1", "k2").unionByName(pairs.select(F.col("l1").alias("k1"), F.col("l2").alias("k2"))).distinct()
    bodies = table(_texts(keyed, least.join(paired.hint("merge"), ["k1", "k2"])), "bodies")
    edges = table(links(pairs, bodies), "links")
    drop(pairs, bodies)
    labels = components(edges)
    drop(edges)
    tiles = table(_tiles(buckets, labels), "tiles")
    drop(buckets)
    open_ = tiles.select("k1", "k2").distinct()
    marked = table(_marked(_texts(keyed, least.join(open_.hint("merge"), ["k1", "k2"]))), "marks")
    between = table(_between(tiles, sketched, marked), "between")
    drop(tiles, marked)
    moved = components(between).select(F.col("id").alias("label"), F.col("label").alias("to"))
    # a class may be a text alone, which has no label yet
    after = labels.join(moved, "label", "left").select("id", F.coalesce("to", "label").alias("label"))
    fresh = moved.join(labels.select(F.col("id").alias("label")), "label", "left_anti").select(F.col("label").alias("id"), F.col("to").alias("label"))
    return after.unionByName(fresh)


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs' rows as (key, class_id, class_rows, k1, k2, r1, r2).

    class_id is the least key in the class, which holds all texts that links connect;
    equal texts are always in one class. k1 and k2 stand for the text and r1, r2 for the
    text that has the class_id. Null keys come last; a class of null keys alone has a null
    class_id. A null text counts as empty; texts without a word are alike only if equal.
    Repeated rows are rows of one class. An empty table has no class. Other columns are
    not read.
    """
    keyed = _keyed(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text")
    sketched = table(sketches(keyed), "sketches")
    labels = table(_labels(keyed, sketched), "labels")
    named = sketched.select("k1", "k2", "least", "rows", _name("k1", "k2").alias("id")).join(labels.hint("merge"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    first = F.min(F.struct(F.col("least").isNull().alias("none"), F.col("least").alias("least"), F.col("k1").alias("r1"), F.col("k2").alias("r2")))
    heads = named.groupBy("label").agg(first.alias("head"), F.sum("rows").alias("class_rows"))
    of_text = table(named.join(heads.hint("merge"), "label").select("k1", "k2", F.col("head.least").alias("class_id"), "class_rows", F.col("head.r1").alias("r1"), F.col("head.r2").alias("r2")), "classes")
    drop(sketched, labels)
    return keyed.select("key", "k1", "k2").join(of_text.hint("merge"), ["k1", "k2"]).select(F.col("key").alias(key), "class_id", "class_rows", "k1", "k2", "r1", "r2")


@sparing
def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with one row of each class: one with the class_id as its key, and its text."""
    found = classes(docs, text, key)
    heads = found.where((F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2")) & F.col(key).eqNullSafe(F.col("class_id"))).groupBy("k1", "k2", F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    heads = table(heads.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "_key", "_n"), "heads")
    body = F.coalesce(F.col(text), F.lit(""))
    kept = docs.join(heads, F.col(key).eqNullSafe(F.col("_key")) & (F.xxhash64(body) == F.col("_k1")) & (F.xxhash64(F.lit(1), body) == F.col("_k2")))
    if not heads.where("_n > 1").isEmpty():  # rows that repeat both key and text
        kept = kept.where("_n = 1").unionByName(kept.where("_n > 1").dropDuplicates(["_k1", "_k2"]))
    return kept.select(*docs.columns)
