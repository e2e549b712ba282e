"""Exact substring dedup with suffix arrays and longest-previous-factor arrays.

A suffix array over all texts doesn't fit one machine, and two equal strings of
`length` bytes need to be compared only if they can be equal. So texts are cut where
their own content says: of the k-byte words in each window of `length` bytes, the one
with the least hash is its anchor, and equal windows have equal anchors at the same
place. A segment is the bytes under the windows that share an anchor.

* An anchor met once has no repeated window: most segments end here, as 40-byte rows.
* The different segments of an anchor meet in a block: one place of each, and a second
  one where it has several. The block gets a suffix array; from it the previous and
  next smaller positions in suffix order give longest-previous-factor arrays (and, with
  larger positions, longest later factors), which tell the windows that stand elsewhere.
* An anchor with very many different segments (a common passage in many settings) is
  split by content: its windows become segments of their own, each is one kind however
  many settings it has, and they meet in blocks in the same way.

Texts that are equal as a whole are found by their 128-bit hash and cut up once.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaybook.llm.common import blocks, drop, mix, rolling, runs, table, texts, tidily

LENGTH = 400
#: Bytes of the words that compete to be an anchor: a longer one makes chance matches rarer, a shorter one segments fewer.
WORD = 128
#: Different segments of one anchor that a block compares, some 1.4 MB with a second place of each; an anchor with more is split into windows.
GROUP = 1000
#: Bytes of segments in one suffix array.
SUFFIX_BYTES = 300_000
#: Windows of a long text that are cut at once.
PIECE = 4_000_000
BASE = 0x9E3779B97F4A7C15


def _minima_table(values: np.ndarray) -> list[np.ndarray]:
    """At level k the least of the 2**k values from each position on."""
    table_ = [values.astype(np.int32)]
    while (width := 1 << len(table_)) <= len(values):
        last = table_[-1]
        table_.append(np.minimum(last[: len(values) - width + 1], last[width // 2 : width // 2 + len(values) - width + 1]))
    return table_


def _smaller(table_: list[np.ndarray], after: bool = False) -> np.ndarray:
    """For each position the nearest before (after) it with a smaller value; -1 (n) if there is none.

    Steps of doubling width as long as all is larger, then of halving width: most positions need one or two.
    """
    values = table_[0]
    n = len(values)
    at = np.arange(1, n + 1) if after else np.arange(n)

    def step(k: int, which: np.ndarray) -> np.ndarray:
        """Move those of `which` that may by 2**k; returns them."""
        least, width = table_[k], 1 << k
        begin = at[which] if after else at[which] - width
        inside = (begin >= 0) & (begin < len(least))
        which, begin = which[inside], begin[inside]
        which = which[least[begin] > values[which]]
        at[which] += width if after else -width
        return which

    moved = [np.arange(n)]
    while len(moved[-1]) and len(moved) <= len(table_):
        moved.append(step(len(moved) - 1, moved[-1]))
    for k in range(len(moved) - 2, -1, -1):
        step(k, moved[k])
    return at if after else at - 1


def _least(table_: list[np.ndarray], begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The least value of each range [begin, end), none of them empty."""
    flat, offset = np.concatenate(table_), np.cumsum([0, *map(len, table_)])
    level = np.frexp((end - begin).astype(np.float64))[1] - 1
    return np.minimum(flat[offset[level] + begin], flat[offset[level] + end - (1 << level)])


class Suffixes:
    """The suffixes of a byte array in order, told apart by their first `depth` bytes, then by position."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, depth: int, whole: bool = False) -> None:
        """ends: where the string that each position belongs to ends; suffixes end there, too.

        With `whole` only suffixes of at least `depth` bytes stand in order: who asks for matches of that length needs no others.
        """
        n = len(data)
        self.depth, self.n = depth, n
        self.left = left = ends - np.arange(n)

        def shifted(values: np.ndarray, by: int) -> np.ndarray:
            out = np.zeros(n, np.int64)
            out[: max(0, n - by)] = values[by:]
            out[left <= by] = 0
            return out

        byte = data.astype(np.int64) + 1
        self.levels, size, rank = [(1, byte)], 1, byte
        for size in (x for x in (2, 4, 7) if x <= depth):  # nine bits a byte: these fit a number
            rank, at = self.levels[-1][1], self.levels[-1][0]
            for more in range(at, size):
                rank = rank << 9 | shifted(byte, more)
            self.levels.append((size, rank))
        size = self.levels[-1][0]
        if size < depth:
            rank = self._dense(rank)[1]
            self.levels[-1] = (size, rank)
        while size < depth:
            step = min(size, depth - size)
            rank = self._dense(rank * (n + 1) + shifted(rank, step))[1]
            size += step
            self.levels.append((size, rank))
        self.rank = rank
        if whole:
            long = np.flatnonzero(left >= depth)
            self.order = long[np.argsort(rank[long], kind="stable")]
        else:
            self.order = np.argsort(rank, kind="stable")

    @staticmethod
    def _dense(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(np.append(True, ordered[1:] != ordered[:-1])[: len(key)])
        return order, rank

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes the suffixes at a and at b share, up to depth; by ever smaller steps."""
        out = np.zeros(len(a), np.int64)
        for size, rank in reversed(self.levels):
            fits = (out + size <= self.depth) & (np.maximum(a, b) + out < self.n)
            i, j = np.where(fits, a + out, 0), np.where(fits, b + out, 0)
            out[fits & (rank[i] == rank[j])] += size
        return np.minimum(out, np.minimum(self.left[a], self.left[b]))

    def longest_factors(self) -> tuple[np.ndarray, np.ndarray]:
        """For each position the longest match that begins at an earlier one, and at a later one, up to depth.

        Where only whole suffixes stand in order, matches with shorter ones don't count. It is with the previous or the next smaller (larger) position in suffix order,
        and as long as what all suffixes from there have in common.
        """
        at, m = self.order, len(self.order)
        if not m:
            return np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        shared = np.zeros(m + 1, np.int64)
        shared[1:m] = self.common(at[:-1], at[1:])
        shared_table = _minima_table(shared)
        found = []
        for value in (at, -at):
            best, table_ = np.zeros(self.n, np.int64), _minima_table(value)
            for after in (False, True):
                other = _smaller(table_, after)
                has = np.flatnonzero((other >= 0) & (other < m))
                a, b = np.minimum(has, other[has]), np.maximum(has, other[has])
                best[at[has]] = np.maximum(best[at[has]], _least(shared_table, a + 1, b + 1))
            found.append(np.minimum(best, self.left))
        return found[0], found[1]


def _minima(key: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    n = len(key)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = key
    grid = padded.reshape(-1, width)
    from_left = np.minimum.accumulate(grid, axis=1).ravel()
    from_right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(from_right[: n - width + 1], from_left[width - 1 : n])


def cut(raw: np.ndarray, starts: np.ndarray, length: int, word: int) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, place of the anchor, first and past-last window) of each segment of raw[starts[i]:starts[i + 1]]."""
    sums, inverse = rolling(raw.astype(np.uint64) + np.uint64(1), BASE)
    n = len(raw) - length + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 5
    at = np.arange(len(raw) - word + 1)
    hashed = mix((sums[word:] - sums[: len(at)]) * inverse[: len(at)])
    bits = max(1, len(raw).bit_length())
    least = _minima((hashed >> np.uint64(bits) << np.uint64(bits)) | at.astype(np.uint64), length - word + 1)
    place = (least & np.uint64((1 << bits) - 1)).astype(np.int64)
    doc = np.searchsorted(starts, np.arange(n), side="right") - 1
    whole = np.arange(n) + length <= starts[doc + 1]
    new = np.ones(n, bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]) | ~whole[:-1]
    first = np.flatnonzero(new & whole)
    last = np.append(np.flatnonzero(new), n)
    last = np.minimum(last[np.searchsorted(last, first, side="right")], np.maximum(starts[doc[first] + 1] - length + 1, 0))
    return doc[first], hashed[place[first]], place[first], first, last


def merge_spans(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of [begin, end) as maximal runs."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.append(True, begin[1:] > end[:-1])[: len(begin)]
    return begin[new], end[np.append(np.flatnonzero(new)[1:], len(end)) - 1] if len(begin) else end


#: A segment's first window, the anchor's place behind it and the number of windows, in one number.
_PACK = 1 << 12


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """docs with (k1, k2), 128 bits that stand for the text: equal texts share rows whatever their ids."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({"_k1": F.xxhash64(body), "_k2": F.xxhash64(F.lit(1), body)})


def _pieces(raw: np.ndarray, starts: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, starts, windows cut off before, first row): a very long text comes in overlapping parts."""
    if len(raw) <= 2 * PIECE:
        yield raw, starts, 0, 0
        return
    for row, (a, b) in enumerate(zip(starts.tolist(), starts[1:].tolist(), strict=False)):
        for at in range(0, max(1, b - a - length + 1), PIECE):
            part = raw[a + at : min(b, a + at + PIECE + length - 1)]
            yield part, np.array([0, len(part)]), at, row


def segments(docs: DataFrame, length: int, word: int) -> DataFrame:
    """(k1, k2, anchor, body, span) of docs (k1, k2, text): a row for each segment.

    body is a hash of the segment's bytes seeded with the anchor's place in it, so anchor
    and body together are 128 bits; span packs its windows and the anchor's place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            raw, starts = texts(batch.column("text"))
            for part, at, shift, row in _pieces(raw, starts, length):
                doc, anchor, place, first, last = cut(part, at, length, word)
                if not len(doc):
                    continue
                data = part.tobytes()
                places = (place - first).tolist()
                body = np.array([xxhash.xxh3_64_intdigest(data[a : b + length - 1], o) for a, b, o in zip(first.tolist(), last.tolist(), places, strict=True)], np.uint64)
                span = ((first - at[doc] + shift) * _PACK + (place - first)) * _PACK + (last - first)
                rows = pa.array(doc + row)
                yield pa.RecordBatch.from_arrays([batch.column("k1").take(rows), batch.column("k2").take(rows), pa.array(anchor.view(np.int64)), pa.array(body.view(np.int64)), pa.array(span)], ["k1", "k2", "anchor", "body", "span"])

    return docs.mapInArrow(tidily(run), "k1 long, k2 long, anchor long, body long, span long")


def _bodies(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(anchor, body, first, place, data, k1, k2): the bytes of the segments `wanted` (k1, k2, least, anchor, body, span).

    docs: (k1, k2, key, text). The least key is a part of the join's key, so the copies of a text don't meet.
    """
    lists = table(wanted.groupBy("k1", "k2", "least").agg(F.collect_set(F.struct("anchor", "body", "span")).alias("rows")), "wanted")
    one = docs.groupBy("k1", "k2", "key").agg(F.first("text").alias("text"))
    same = (one["k1"] == lists["k1"]) & (one["k2"] == lists["k2"]) & one["key"].eqNullSafe(lists["least"])
    joined = one.join(lists.hint("merge"), same).select(one["k1"], one["k2"], "text", "rows")
    names = ["anchor", "body", "first", "place", "data", "k1", "k2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, text, rows in zip(*(batch.column(c) for c in ("k1", "k2", "text", "rows")), strict=True):
                data, flat = text.as_py().encode(), rows.values
                span = flat.field("span").to_numpy()
                for at in range(0, len(span), 2000):
                    first, n = np.divmod(span[at : at + 2000], _PACK)
                    first, place = np.divmod(first, _PACK)
                    cut_out = [data[a : a + m + length - 1] for a, m in zip(first.tolist(), n.tolist(), strict=True)]
                    of = (pa.array(np.full(len(first), k.as_py(), np.int64)) for k in (k1, k2))
                    yield pa.RecordBatch.from_arrays([flat.field("anchor").slice(at, 2000), flat.field("body").slice(at, 2000), pa.array(first), pa.array(place), pa.array(cut_out, pa.binary()), *of], names)

    return joined.mapInArrow(tidily(run), "anchor long, body long, first long, place long, data binary, k1 long, k2 long")


def may_match(group: list[tuple[int, bytes]], length: int, word: int) -> list[bool]:
    """Which of an anchor's segments, as (the anchor's place, bytes), may share a window with another.

    A window reaches past the anchor by half of what it has besides on the left or on the
    right; so two equal ones agree on that half next to the anchor, too.
    """
    half = (length - word) // 2
    left = [data[at - half : at + word] if at >= half else None for at, data in group]
    right = [data[at : at + word + half] if len(data) >= at + word + half else None for at, data in group]
    seen = [Counter(x for x in side if x is not None) for side in (left, right)]
    return [seen[0][a] > 1 or seen[1][b] > 1 for a, b in zip(left, right, strict=True)]


def repeated_windows(bodies: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(body, window, whether it has an earlier match) of all windows of `bodies` that occur at another place in them."""
    sizes = np.array([len(s) for s in bodies], np.int64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    suffixes = Suffixes(np.frombuffer(b"".join(bodies), np.uint8), ends, length, whole=True)
    before, after = suffixes.longest_factors()
    earlier = before >= length
    at = np.flatnonzero(earlier | (after >= length))
    return np.repeat(np.arange(len(bodies)), sizes)[at], runs(sizes)[at], earlier[at]


def _compare(bodies: DataFrame, length: int, word: int) -> DataFrame:
    """(anchor, body, begin, end, earlier): runs of windows of `bodies` that occur at another place of the anchor.

    They are counted from the body's first window. Rows with `earlier` are of windows met
    before, in the order of the places; the others are of all. Windows with different
    anchors differ, so a block may hold whole groups of many anchors.
    """
    names = ["anchor", "body", "begin", "end", "earlier"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []  # an anchor's places follow each other, in order
        group: list[tuple[int, int, bytes, int]] = []
        now = None

        def close() -> int:
            if len(group) > 1:
                again = Counter(r[1] for r in group)
                may = may_match([(r[3], r[2]) for r in group], length, word)
                held.extend(r[:3] for r, m in zip(group, may, strict=True) if m or again[r[1]] > 1)
            group.clear()
            return sum(len(r[2]) for r in held)

        def done() -> pa.RecordBatch:
            which, window, before = repeated_windows([r[2] for r in held], length)
            met: dict[tuple[int, int], int] = {}
            first = np.array([met.setdefault(r[:2], i) == i for i, r in enumerate(held)])
            parts = []
            for earlier in (False, True):
                use = first[which] & (before | (not earlier))
                w, at = which[use], window[use]
                new = np.ones(len(w), bool)
                new[1:] = (w[1:] != w[:-1]) | (at[1:] != at[:-1] + 1)
                last = np.append(np.flatnonzero(new)[1:], len(w)) - 1 if len(w) else np.empty(0, np.int64)
                owner = w[new].tolist()
                parts.append(([held[i][0] for i in owner], [held[i][1] for i in owner], at[new].tolist(), (at[last] + 1).tolist(), [earlier] * len(owner)))
            held.clear()
            kinds = (*[pa.int64()] * 4, pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(x + y, kind) for x, y, kind in zip(*parts, kinds, strict=True)], names)

        for batch in batches:
            for anchor, *row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "body", "data", "place")), strict=True):
                if anchor != now:
                    now = anchor
                    if group and close() > SUFFIX_BYTES:
                        yield done()
                group.append((anchor, *row))
        if close():
            yield done()

    dealt = bodies.repartition("anchor").sortWithinPartitions("anchor", "k1", "k2", "first")
    return dealt.mapInArrow(tidily(run), "anchor long, body long, begin long, end long, earlier boolean")


def _windows(bodies: DataFrame, length: int) -> DataFrame:
    """(k1, k2, anchor, body, span, old_anchor, old_body, at): each window of `bodies` as a segment of its own, by 128 bits of its hash."""
    names = ["k1", "k2", "anchor", "body", "span", "old_anchor", "old_body", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, anchor, body, first, data in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "anchor", "body", "first", "data")), strict=True):
                n = len(data) - length + 1
                hashed = np.frombuffer(b"".join(xxhash.xxh3_128_digest(data[i : i + length]) for i in range(n)), np.int64)
                at = np.arange(n)
                of = [pa.array(np.full(n, x, np.int64)) for x in (k1, k2, anchor, body)]
                yield pa.RecordBatch.from_arrays([*of[:2], pa.array(hashed[::2]), pa.array(hashed[1::2]), pa.array((at + first) * _PACK * _PACK + 1), *of[2:], pa.array(at)], names)

    return bodies.mapInArrow(tidily(run), ", ".join(f"{x} long" for x in names))


def _kinds(cut_up: DataFrame) -> DataFrame:
    """(anchor, body, n, lo, hi, kinds) of segments (k1, k2, anchor, body, span) whose anchor is met again; lo and hi are the body's first and last place."""
    place = F.struct("k1", "k2", "span")
    same = cut_up.groupBy("anchor", "body").agg(F.count("*").alias("n"), F.min(place).alias("lo"), F.max(place).alias("hi"))
    anchors = same.groupBy("anchor").agg(F.count("*").alias("kinds"), F.max("n").alias("most")).where("kinds > 1 OR most > 1").select("anchor", "kinds")
    return same.join(anchors.hint("merge"), "anchor")


def _places(kinds: DataFrame, texts_: DataFrame) -> DataFrame:
    """(k1, k2, least, anchor, body, span): up to two places of each body."""
    both = kinds.select("anchor", "body", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("at"))
    return both.select("anchor", "body", "at.*").join(texts_.select("k1", "k2", "least").hint("merge"), ["k1", "k2"])


def repeated_spans(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, word: int = WORD, group: int = GROUP, keep_first: bool = False) -> DataFrame:
    """(k1, k2, least, copies, spans) of texts that stand in several rows or have repeated strings.

    spans: the bytes [begin, end) under strings that begin elsewhere, not merged; with
    keep_first only under strings that have an earlier match. least: the text's least key.
    """
    named = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    bodies = _keyed(named, "text").select("key", F.col("_k1").alias("k1"), F.col("_k2").alias("k2"), F.coalesce("text", F.lit("")).alias("text")).where(F.octet_length("text") >= length)
    known = table(bodies.groupBy("k1", "k2").agg(F.min("key").alias("least"), F.count("*").alias("copies")), "texts")
    cut_up = table(segments(bodies.select("k1", "k2", "text"), length, word).distinct(), "segments")
    all_kinds = table(_kinds(cut_up), "kinds")
    wide = F.col("kinds") > group
    live = all_kinds.where(~wide).select("anchor", "body", "lo")
    # where the segments of a text are that may be repeated, and the first place of each
    rows = table(cut_up.join(all_kinds.select("anchor", "body", "lo", "n", "kinds").hint("merge"), ["anchor", "body"]).where("n > 1 OR kinds > 1").select("k1", "k2", "anchor", "body", "span", (F.struct("k1", "k2", "span") == F.col("lo")).alias("is_lo")), "repeats")
    drop(cut_up)
    split = table(_windows(_bodies(bodies, _places(all_kinds.where(wide), known), length), length), "windows")
    again = table(_kinds(split.select("k1", "k2", "anchor", "body", "span").distinct()).where("n > 1"), "kinds")
    met = table(_compare(_bodies(bodies, _places(all_kinds.where(~wide), known).unionByName(_places(again, known)), length), length, word), "matches")
    # a window that repeats tells of its body; it is met earlier unless the body's first place is the window's first place
    found = split.join(again.select("anchor", "body", "lo").hint("merge"), ["anchor", "body"]).join(met.where("NOT earlier").select("anchor", "body").hint("merge"), ["anchor", "body"])
    found = found.groupBy("old_anchor", "old_body", "at").agg(F.min(F.struct("k1", "k2", "span", (F.struct("k1", "k2", "span") == F.col("lo")).alias("is_lo"))).alias("least"))
    met_before = F.explode(F.when(F.col("least.is_lo"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True))))
    found = found.select(F.col("old_anchor").alias("anchor"), F.col("old_body").alias("body"), F.col("at").alias("begin"), (F.col("at") + 1).alias("end"), met_before.alias("earlier"))
    ranges = met.join(live.hint("merge"), ["anchor", "body"], "left_semi").unionByName(found)
    use = (F.col("earlier") == F.col("is_lo")) if keep_first else ~F.col("earlier")
    first = F.shiftright("span", 24)  # twice _PACK
    spans = rows.join(ranges.hint("merge"), ["anchor", "body"]).where(use).select("k1", "k2", (first + F.col("begin")).alias("begin"), (first + F.col("end") + (length - 1)).alias("end"))
    spans = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    # written, so that the shuffles behind it are gone before the texts are shuffled again
    out = table(known.join(spans.hint("merge"), ["k1", "k2"], "left").where("copies > 1 OR spans IS NOT NULL"), "spans")
    drop(known, all_kinds, rows, split, again, met)
    return out


def dedup_substrings(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, word: int = WORD, group: int = GROUP, keep_first: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, kept, spans): texts without the bytes under repeated strings.

    Every byte of a `length`-byte string that begins anywhere else, in any text, goes; the
    input decides, not what is left. kept is the rest as bytes, spans the maximal runs
    removed. Texts under `length` bytes, null and empty ones lose nothing. Every row counts:
    of equal texts of enough bytes nothing is left. With keep_first the first of equal
    strings stays, in an order of texts by hash and of places; of equal texts the row with
    the least key does (each of several such rows). Rows with null keys are treated alike;
    other columns are not read.
    """
    found = repeated_spans(docs, text, key, length, word, group, keep_first).withColumnsRenamed({"least": "_least", "copies": "_copies"})
    keyed = _keyed(docs.select(key, text), text)
    whole = F.col("_copies") > 1
    if keep_first:
        whole &= ~F.col(key).eqNullSafe(F.col("_least"))
    whole_span = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.octet_length(F.col(text)).cast("long").alias("end")))
    spans = F.when(whole, whole_span).otherwise(F.col("spans")).alias("spans")
    joined = keyed.join(found.hint("merge"), (F.col("_k1") == F.col("k1")) & (F.col("_k2") == F.col("k2")), "left").select(key, F.col(text).alias("_text"), spans)
    names = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<begin:bigint,end:bigint>>"
    span_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "_text"):
            rows = []
            for body, spans in zip(batch.column("_text").to_pylist(), batch.column("spans"), strict=True):
                data, out = (body or "").encode(), []
                if spans.is_valid:
                    flat = spans.values
                    begin, end = merge_spans(flat.field("begin").to_numpy(), flat.field("end").to_numpy())
                    out = list(zip(begin.tolist(), end.tolist(), strict=True))
                edges = [0, *(x for s in out for x in s), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((len(data), len(data) - len(kept), len(out), hashlib.sha256(kept).hexdigest(), kept, [{"begin": a, "end": b} for a, b in out]))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), span_type)
            yield pa.RecordBatch.from_arrays([batch.column(key), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names)

    return joined.mapInArrow(tidily(run), schema)
