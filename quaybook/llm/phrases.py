"""Phrase collocations: Apriori passes over word ids, level by level.

Words that occur often enough get ids, and the texts become arrays of ids in which 0
stands for whatever ends or breaks a phrase. A pass for k words emits a k-gram only where
both (k-1)-grams in it are frequent. What is frequent goes to all tasks as a set of bits of
fixed size, at a hash of each gram: a bit that stands for other grams too lets a
gram pass to be counted, and the counts are exact. The level tables then score every cut of every
phrase and tell which are contained in longer ones.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaybook.llm.common import blocks, drop, mix, small_batches, table, texts, tidily

#: Occurrences that a phrase needs, words it may have, and phrases returned for a language.
LEAST, LONGEST, TOP = 30, 4, 2000
#: A longer phrase of at least so many hundredths of the occurrences takes a phrase's place.
COVERED = 80
#: The scale of scores.
SCALE = 2_000_000
#: Up to so many words, and bytes of them, are sent to all tasks; more are joined.
BROADCAST_WORDS, BROADCAST_BYTES = 1_000_000, 32_000_000
#: The set of frequent grams has 2**BITS bits (16 MB), however many there are.
BITS = 27
#: Different words, and grams, that a task counts before it passes them on.
WORDS_COUNTED, GRAMS_COUNTED = 300_000, 1_000_000
#: About how many ids a row of encoded text has.
ROW_IDS = 1 << 14
#: The language of texts without one.
UNKNOWN = "und"
#: Parts, fewer each time, in which a language's best phrases are found.
SALTS = (4096, 64)

_FROM = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t"
_PIECES = bytes.maketrans(_FROM, b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
#: A break between pieces, among words: no word has a full stop.
_BREAK = b"."


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(language, words and breaks) of the texts of blocks."""
    for batch in blocks(batches, "text"):
        data, starts = texts(batch.column("text"))
        raw, ends = data.tobytes(), starts.tolist()
        of: dict[str, list[bytes]] = {}
        for lang, a, b in zip(batch.column("lang").to_pylist(), ends, ends[1:], strict=False):
            of.setdefault(lang, []).append(raw[a:b])
        for lang, said in of.items():
            yield lang, b"\n".join(said).translate(_PIECES).replace(b"\n", b" . ").split()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n), and a row of null word for all of a language's."""
    counts: dict[str, Counter[bytes]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, count in counts.items():
            count.pop(_BREAK, None)
            words, n = [None, *count.keys()], [sum(count.values()), *count.values()]
            for a in range(0, len(words), 50_000):
                part = words[a : a + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(part, pa.binary()).cast(pa.string()), pa.array(n[a : a + 50_000], pa.int64())], ["lang", "word", "n"])
        counts.clear()

    for lang, words in _by_language(batches):
        counts.setdefault(lang, Counter()).update(words)
        if sum(map(len, counts.values())) > WORDS_COUNTED:
            yield from out()
    yield from out()


def _rows(ids: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of ids, cut between pieces; without words that stand alone, and one 0 between pieces."""
    around = np.concatenate([[0], ids, [0]])
    ids = np.where((around[:-2] > 0) | (around[2:] > 0), ids, 0)
    word = ids > 0
    ids = ids[word | np.concatenate([[False], word[:-1]])]
    ends = np.flatnonzero(ids == 0) + 1
    at = 0
    while at < len(ids):
        i = np.searchsorted(ends, at + ROW_IDS)
        end = int(ends[i]) if i < len(ends) else len(ids)
        yield ids[at:end]
        at = end


def _lists(rows: list[np.ndarray]) -> pa.RecordBatch:
    ends = np.cumsum([0, *map(len, rows)])
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows), pa.int32()))], ["ids"])


def _encoded_by_broadcast(said: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(ids): rows of encoded text, each task with all frequent words."""
    found = vocabulary.select("lang", "word", "id").toArrow()
    at = pa.compute.sort_indices(found.column("lang"))
    langs, words, ids = (found.column(c).take(at).to_pylist() for c in ("lang", "word", "id"))
    starts = [i for i in range(len(langs)) if not i or langs[i] != langs[i - 1]]
    packed = [(langs[i], "\n".join(words[i:j]).encode(), np.array(ids[i:j], np.int32)) for i, j in zip(starts, [*starts[1:], len(langs)], strict=False)]  # no word has a line end
    sent = said.sparkSession.sparkContext.broadcast(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = {lang: dict(zip(words.split(b"\n"), of.tolist(), strict=True)) for lang, words, of in sent.value}
        for lang, words in _by_language(batches):
            if rows := list(_rows(np.fromiter(map(ids.get(lang, {}).get, words, repeat(0)), np.int32, len(words)))):
                yield _lists(rows)

    return said.mapInArrow(tidily(run), "ids array<int>")


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, lang, word, places): where the words of each block of text stand."""
    block = TaskContext.get().partitionId() << 40
    for lang, words in _by_language(batches):
        seen = {w: i for i, w in enumerate(dict.fromkeys(words))}
        code = np.fromiter(map(seen.__getitem__, words), np.int32, len(words))
        order = np.argsort(code, kind="stable").astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(seen)))])
        names = list(seen)
        for a in range(0, len(names), 10_000):
            b = min(len(names), a + 10_000)
            lists = pa.ListArray.from_arrays(pa.array(ends[a : b + 1] - ends[a], pa.int32()), pa.array(order[ends[a] : ends[b]]))
            yield pa.RecordBatch.from_arrays([pa.array([block] * (b - a)), pa.array([lang] * (b - a)), pa.array(names[a:b], pa.binary()).cast(pa.string()), lists], ["block", "lang", "word", "places"])
        block += 1


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of encoded text, of (block, id, places) sorted by block."""
    block, found = None, []

    def out() -> Iterator[pa.RecordBatch]:
        ids = np.zeros(max(int(at.max()) for _, at in found) + 1, np.int32)
        for i, at in found:
            ids[at] = i
        if rows := list(_rows(ids)):
            yield _lists(rows)
        found.clear()

    for batch in batches:
        for new, i, at in zip(batch.column("block").to_pylist(), batch.column("id").to_pylist(), batch.column("places"), strict=True):
            if found and new != block:
                yield from out()
            block = new
            found.append((i, at.values.to_numpy()))
    if found:
        yield from out()


def _encoded_by_join(said: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(ids): rows of encoded text; a block's words find their ids in a join, each once."""
    places = table(said.mapInArrow(tidily(_places), "block long, lang string, word string, places array<int>"), "places")
    joined = places.join(vocabulary.select("lang", "word", "id"), ["lang", "word"]).select("block", "id", "places")
    return joined.repartition("block").sortWithinPartitions("block").mapInArrow(tidily(_placed), "ids array<int>")


def _keys(ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k-grams that begin at each place, as two numbers of two ids each; gram and place mean nothing where a 0 is inside."""
    wide = ids.astype(np.int64)
    n = max(0, len(wide) - k + 1)
    w = [wide[i : i + n] for i in range(k)]
    zero = np.zeros(n, np.int64)
    return w[0] << 32 | (w[1] if k > 1 else zero), (w[2] if k > 2 else zero) << 32 | (w[3] if k > 3 else zero)


def _bit(hi: np.ndarray, lo: np.ndarray, bits: int) -> np.ndarray:
    return (mix(hi.view(np.uint64) ^ mix(lo.view(np.uint64) + np.uint64(1))) >> np.uint64(64 - bits)).astype(np.int64)


def _frequent(level: DataFrame, bits: int) -> np.ndarray:
    """The set of a level's grams: bits, 64 in a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bit = np.unique(_bit(*(batch.column(c).to_numpy() for c in ("hi", "lo")), bits))
            starts = np.flatnonzero(np.diff(bit >> 6, prepend=-1))
            yield pa.RecordBatch.from_arrays([pa.array(bit[starts] >> 6), pa.array(np.bitwise_or.reduceat(np.uint64(1) << (bit & 63).astype(np.uint64), starts).view(np.int64))], ["slot", "bits"])

    found = level.select("hi", "lo").mapInArrow(tidily(run), "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(max(1, 1 << (bits - 6)), np.uint64)
    out[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _level(encoded: DataFrame, k: int, below: DataFrame | None, least: int, bits: int) -> DataFrame:
    """(hi, lo, f) of the k-grams that occur `least` times; `below` has those of k - 1, or is None where these are the words."""
    sent = None if below is None else encoded.sparkSession.sparkContext.broadcast(_frequent(below, bits))

    def counted(hi: np.ndarray, lo: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(_bit(hi, lo, 63)) if k > 2 else np.argsort(hi)
        hi, lo = hi[order], lo[order]
        starts = np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])]))
        return pa.RecordBatch.from_arrays([pa.array(hi[starts]), pa.array(lo[starts]), pa.array(np.diff(np.append(starts, len(hi))))], ["hi", "lo", "n"])

    def emitted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shorter = ids > 0
        for _ in range(k - 2):
            shorter = shorter[1:] & shorter[:-1]
        if sent is not None and len(shorter):
            at = np.flatnonzero(shorter)
            bit = _bit(*(x[at] for x in _keys(ids, k - 1)), bits)
            shorter[at] = (sent.value[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) > 0
        both = np.flatnonzero(shorter[1:] & shorter[:-1])
        hi, lo = _keys(ids, k)
        return hi[both], lo[both]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            for row in batch.column("ids"):
                waiting.append(emitted(row.values.to_numpy()))
                n += len(waiting[-1][0])
                if n > GRAMS_COUNTED:
                    yield counted(*map(np.concatenate, zip(*waiting, strict=True)))
                    waiting, n = [], 0
        if n:
            yield counted(*map(np.concatenate, zip(*waiting, strict=True)))

    grams = encoded.mapInArrow(tidily(run), "hi long, lo long, n long")
    return grams.groupBy("hi", "lo").agg(F.sum("n").alias("f")).where(F.col("f") >= least)


def _ids(k: int) -> Column:
    """The words of a gram, as an array of ids."""
    each = [F.shiftright("hi", 32), F.col("hi").bitwiseAND(0xFFFFFFFF), F.shiftright("lo", 32), F.col("lo").bitwiseAND(0xFFFFFFFF)]
    return F.array(*each[:k]).cast("array<int>")


def _scored(grams: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates (g, a) with lang, l, r and score of their worst cut. grams: (g, lang, f), lang for words only."""
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("g") - 1)))
    cuts = cuts.withColumns({"left": F.slice("g", F.lit(1), F.col("k")), "right": F.slice("g", F.col("k") + 1, F.size("g") - F.col("k"))})
    lefts = grams.select(F.col("g").alias("left"), F.col("f").alias("l"), "lang")
    rights = grams.select(F.col("g").alias("right"), F.col("f").alias("r"))
    both = cuts.join(lefts, "left").join(rights, "right")
    score = F.expr(f"(CAST(a AS DECIMAL(20,0)) * CAST({SCALE} AS DECIMAL(8,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    return both.groupBy("g", "a").agg(F.max("lang").alias("lang"), F.min(F.struct(score.alias("score"), F.col("k"), F.col("l"), F.col("r"))).alias("worst")).select("g", "a", "lang", "worst.score", "worst.l", "worst.r")


def _uncovered(candidates: DataFrame) -> DataFrame:
    """Candidates (g, a) without those that a longer one covers."""
    size = F.size("g")
    inside = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.slice("g", i, n))))
    longer = candidates.where(size > 2).select(F.explode(inside).alias("g"), "a").groupBy("g").agg(F.max("a").alias("longer"))
    return candidates.join(longer, "g", "left").where(F.coalesce(100 * F.col("longer") < COVERED * F.col("a"), F.lit(True))).drop("longer")


def _best(scored: DataFrame, top: int) -> DataFrame:
    """What may be among a language's first `top`, ties at the end included: found in parts, so no task gets a language."""
    for salts in SALTS:
        order = Window.partitionBy("lang", F.pmod(F.xxhash64("g"), F.lit(salts))).orderBy(F.desc("score"), F.desc("a"))
        scored = scored.withColumn("at", F.rank().over(order)).where(F.col("at") <= top).drop("at")
    return scored


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP, broadcast_words: int = BROADCAST_WORDS, bits: int = BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to `longest` words (at most 4).

    A-Z are lower-cased; .,;:!? and line ends (\\x0A-\\x0D) cut a text into pieces, spaces and tabs cut pieces into words.
    A phrase lies in a piece. It is a candidate with `least` occurrences, a. Its cut of the lowest
    score, floor(2000000 * a / (l + r)), counts; l and r are the occurrences of the cut's two parts.
    Candidates inside a longer one with 80 % of their occurrences go. n: the language's words.

    A null language is `und`, a null or empty text has no words. Every row counts, repeated ones too;
    an empty table gives no phrase. Other columns are not read. Frequent words may be
    2**31 at most.
    """
    if not 2 <= longest <= 4:
        raise ValueError("phrases have 2 to 4 words")
    small_batches(docs.sparkSession)
    said = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    counts = said.mapInArrow(tidily(_count_words), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("f"))
    words = table(counts.where(F.col("word").isNull() | (F.col("f") >= least)).withColumn("at", F.monotonically_increasing_id()), "words")
    totals = words.where("word IS NULL").select("lang", F.col("f").alias("n"))
    vocabulary = _numbered(words)
    n, size = vocabulary.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
    few = n <= broadcast_words and size <= BROADCAST_BYTES
    encoded = table((_encoded_by_broadcast if few else _encoded_by_join)(said, vocabulary), "encoded")
    grams = vocabulary.select(F.array("id").alias("g"), "f", "lang")
    levels, level = [], None
    for k in range(2, longest + 1):
        level = table(_level(encoded, k, level, least, bits), f"level{k}")
        levels.append(level.select(_ids(k).alias("g"), F.col("f").alias("a")))
    drop(encoded)
    candidates = levels[0]
    for more in levels[1:]:
        candidates = candidates.unionByName(more)
    grams = grams.unionByName(candidates.select("g", F.col("a").alias("f"), F.lit(None).cast("string").alias("lang")))
    best = _best(_scored(grams, _uncovered(candidates)), top)
    named = best.select("*", F.posexplode("g").alias("i", "id")).join(vocabulary.select("id", "word"), "id")
    named = named.groupBy("g", "lang", "a", "l", "r", "score").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    return named.withColumn("rank", rank).where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _numbered(words: DataFrame) -> DataFrame:
    """(lang, word, f, id) of frequent words: ids without gaps, from 1."""
    found = words.where("word IS NOT NULL").withColumn("part", F.shiftright("at", 33))
    sizes = found.groupBy("part").agg(F.max(F.col("at").bitwiseAND((1 << 33) - 1)).alias("n"))  # a row for each partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum(F.col("n") + 1).over(before), F.lit(0)).alias("offset"))
    number = F.col("offset") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    checked = F.when(number < 1 << 31, number).otherwise(F.raise_error(F.lit("more than 2**31 frequent words")).cast("long"))
    return table(found.join(F.broadcast(offsets), "part").select("lang", "word", "f", checked.cast("int").alias("id")), "vocabulary")
