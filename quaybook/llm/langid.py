"""Language identification: words first, then ever shorter character n-grams.

A model has the log frequency of known words and of the character n-grams of words in
each language. A text's words are looked up; a word that the model doesn't know gets
the mean of its longest known n-grams. Fitting uses a bounded sample of labelled rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quaybook.llm.common import blocks, runs, tidily

UNDETERMINED = "und"
#: Labelled documents that a language is learned from, chosen by a hash of their ids.
SAMPLE_DOCS = 1500
#: The most frequent words kept for each language.
WORDS = 50_000
#: Longest n-gram to fall back to.
LONGEST = 5
#: Words that a worker remembers before it starts anew, and words x languages that it holds at once.
WORDS_KEPT = 150_000
CELLS = 2_000_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def ngrams(word: str, n: int) -> list[str]:
    """The n-grams of a word between spaces; single characters without them."""
    padded = word if n == 1 else f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


class Table:
    """Counts of items (words, or n-grams of one length) by language, as sparse rows.

    A row holds only the languages that the item was seen in; the others share one
    default a language. So the size goes with what was counted, not with items x languages.
    """

    def __init__(self, counts: list[dict[str, int]]) -> None:
        items = sorted(set(chain.from_iterable(counts)))
        self.rows = dict(zip(items, range(len(items)), strict=True))
        sizes = [len(c) for c in counts]
        row = np.fromiter((self.rows[x] for c in counts for x in c), np.int32, sum(sizes))
        lang = np.repeat(np.arange(len(counts), dtype=np.int32), sizes)
        n = np.fromiter((x for c in counts for x in c.values()), np.float64, sum(sizes))
        order = np.argsort(row, kind="stable")
        self.at = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(items)))])
        self.lang = lang[order]
        total = np.maximum(np.bincount(lang, weights=n, minlength=len(counts)) + 0.5 * len(items), 1)
        self.default = np.log(0.5 / total)
        #: what being seen adds to the default, and the log of a row's evidence for all languages together
        self.more = np.log1p(2 * n[order]).astype(np.float32)
        seen = np.add.reduceat((n / total[lang])[order], self.at[:-1]) if items else np.empty(0)
        self.all = np.log((0.5 / total).sum() + seen)

    def evidence(self, rows: list[list[int]]) -> np.ndarray:
        """Log share of the evidence for each language; for each list of rows the mean over them."""
        sizes = np.array([len(x) for x in rows])
        of = np.repeat(np.arange(len(rows)), sizes)
        row = np.fromiter(chain.from_iterable(rows), np.int64, len(of))
        out = self.default - (np.bincount(of, self.all[row], len(rows)) / sizes)[:, None]
        n = self.at[row + 1] - self.at[row]
        cell, of = np.repeat(self.at[row], n) + runs(n), np.repeat(of, n)
        more = np.bincount(of * len(self.default) + self.lang[cell], self.more[cell] / sizes[of], out.size)
        return (out + more.reshape(out.shape)).astype(np.float32)


class Model:
    """Per language, log frequencies of words and of n-grams; normalised over the languages, as evidence."""

    def __init__(self, counts: dict[str, dict[str, int]]) -> None:
        """counts: words of each language with how often they occur."""
        self.languages = sorted(counts)
        words = [counts[lang] for lang in self.languages]
        self.words = Table(words)
        self.grams = {}
        for n in range(1, LONGEST + 1):
            grams = [Counter() for _ in words]
            for seen, of in zip(grams, words, strict=True):
                for w, c in of.items():
                    for g in ngrams(w, n):
                        seen[g] += c
            self.grams[n] = Table(grams)
        self.forget()

    def forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.known = np.empty((0, len(self.languages)), np.float32)
        self.lettered = np.empty(0, bool)

    def evidence(self, words: list[str]) -> np.ndarray:
        """Log share of the evidence for each language in each word."""
        out = np.full((len(words), len(self.languages)), -np.log(len(self.languages)), np.float32)
        left = []
        for i, w in enumerate(words):
            if (row := self.words.rows.get(w)) is not None:
                left.append((i, self.words, [row]))
                continue
            for n in range(min(LONGEST, len(w) + 2), 0, -1):
                known = self.grams[n].rows
                if found := [known[g] for g in ngrams(w, n) if g in known]:
                    left.append((i, self.grams[n], found))
                    break
        for table in (self.words, *self.grams.values()):
            if some := [(i, rows) for i, t, rows in left if t is table]:
                at, rows = zip(*some, strict=True)
                out[list(at)] = table.evidence(rows)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """A language and a score from 0 to 1 for each text: the mean over its words of the language's share of the evidence."""
        score, best = np.zeros(len(texts)), np.full(len(texts), -1)
        if self.languages:
            for i, text in enumerate(texts):
                total, share, letters = self._weigh(words_of(text))
                if letters:
                    best[i] = total.argmax()
                    score[i] = share[best[i]] / letters
        return [self.languages[b] if b >= 0 else UNDETERMINED for b in best], np.clip(score, 0, 1)

    def _weigh(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
        """Sums over a text's words of the log evidence and of the evidence for each language, and how many words have letters.

        Words x languages are held for CELLS of them at once, so neither a long text nor many languages need more.
        """
        step = max(1, CELLS // len(self.languages))
        total, share, letters = np.zeros(len(self.languages)), np.zeros(len(self.languages)), 0
        for a in range(0, len(words), step):
            part = words[a : a + step]
            if len(self.slots) > min(WORDS_KEPT, step):
                self.forget()
            new = sorted(set(part).difference(self.slots))
            if new:
                self.slots.update(zip(new, range(len(self.slots), len(self.slots) + len(new)), strict=True))
                if len(self.slots) > len(self.known):  # room for twice as many, so that growing costs little
                    room = 2 * len(self.slots) - len(self.known)
                    self.known = np.concatenate([self.known, np.empty((room, len(self.languages)), np.float32)])
                    self.lettered = np.concatenate([self.lettered, np.empty(room, bool)])
                at = slice(len(self.slots) - len(new), len(self.slots))
                self.known[at] = self.evidence(new)
                self.lettered[at] = [any(map(str.isalpha, w)) for w in new]
            slot = np.fromiter(map(self.slots.__getitem__, part), np.int64, len(part))
            slot = slot[self.lettered[slot]]
            log = self.known[slot].astype(np.float64)
            total += log.sum(axis=0)
            share += np.exp(log).sum(axis=0)
            letters += len(slot)
        return total, share, letters


def held_out(key: Column) -> Column:
    """Documents never learned from: crc32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample_docs: int = SAMPLE_DOCS, words: int = WORDS) -> Model:
    """A model from docs that have a language and a key and are not held out.

    Of each language about `sample_docs` documents are read, whole, chosen by a hash of
    the key; its `words` most frequent words make the model. So what comes to the driver
    is bounded by that times the number of languages; every language is learned, a rare
    one from all its documents. Without any labelled row the model has no language and says "und".
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key))).select(F.col(lang).cast("string").alias("lang"), F.col(key).alias("key"), F.col(text).alias("text"))
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("size"))
    # a row for each language: fewer than the model has of each, which comes to the driver
    sample = labelled.join(F.broadcast(sizes), "lang").where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < sample_docs / F.col("size") * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            seen: dict[str, Counter] = defaultdict(Counter)
            for name, body in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seen[name].update(w for w in words_of(body or ""))
            rows = [(name, w, n) for name, c in seen.items() for w, n in c.items() if any(map(str.isalpha, w))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["lang", "word", "n"])

    counted = sample.select("lang", "text").mapInArrow(tidily(count), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for row in counted.withColumn("rank", rank).where(F.col("rank") <= words).collect():
        counts[row["lang"]][row["word"]] = row["n"]
    return Model(counts)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred and score, from the whole of `text` alone.

    lang_pred is a language of the model, the first of several that score alike, or "und"
    with score 0 where the text is null or has no letter. Every row counts, repeated ones
    too; the other columns pass through, and columns of these two names are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_here = shared.value
        for batch in blocks(batches, text):
            lang, score = model_here.predict(batch.column(text).fill_null("").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score)], names=[*batch.schema.names, "lang_pred", "score"])
        model_here.forget()

    return docs.mapInArrow(tidily(run), schema)
