"""Byte-level BPE: many words at once in flat numpy arrays.

A block's texts are cut into words by the tokenizer's pattern. Each new word goes
through merge rounds with all others: neighbouring symbols form pair keys, a binary
search over the sorted keys of all merges gives ranks, and in every word the pairs of
its lowest rank merge. A worker keeps the words it has met, up to a bound.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quaybook.llm.common import blocks, runs, texts, tidily

#: Words that a worker remembers before it starts anew.
WORDS_KEPT = 300_000
#: Longer words are merged one pair at a time, from a heap: their rounds would each pass over the whole word.
LONG_WORD = 2000
NO_RANK = np.int64(1 << 40)


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Bpe:
    """Tables of one tokenizer file, and the words met so far."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        shown = _byte_symbols()
        to_byte = {c: b for b, c in enumerate(shown)}
        size = max(names) + 1
        self.bytes_of = Table([bytes(to_byte[c] for c in names.get(i, "")) for i in range(size)])
        self.decimals = Table([b"%d," % i for i in range(size)])
        self.first = np.array([vocab[c] for c in shown], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right = (np.array([vocab[m[i]] for m in merges], np.int64) for i in (0, 1))
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.words = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.forget()

    def forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.store, self.at = np.empty(0, np.int64), np.zeros(1, np.int64)
        if self.special:
            self._learn(list(self.special), np.array(list(self.special.values())), np.ones(len(self.special), np.int64))

    def _learn(self, words: list[str], ids: np.ndarray, n: np.ndarray) -> None:
        self.slots.update(zip(words, range(len(self.slots), len(self.slots) + len(words)), strict=True))
        self.at = np.append(self.at, self.at[-1] + np.cumsum(n))
        self.store = np.append(self.store, ids)

    def split(self, text: str) -> list[str]:
        """The words of a text; strings of special tokens stand for themselves."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.words.findall(text)
        found: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            found += [part] if i % 2 else self.words.findall(part)
        return found

    def rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair's merge, NO_RANK if there is none, and its row."""
        key = left << 32 | right
        row = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[row] == key, self.ranks[row], NO_RANK), row

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of them each word has)."""
        lengths = np.array([len(w) for w in words], np.int64)
        sym = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        rank, row = self._ranks(sym, word)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            size = np.diff(np.append(starts, len(word)))
            least = np.repeat(np.minimum.reduceat(rank, starts), size)
            ready = least == NO_RANK
            if ready.any():
                done.append((word[ready], sym[ready]))
                sym, word, rank, row, least = (x[~ready] for x in (sym, word, rank, row, least))
                if not len(sym):
                    break
            at = np.flatnonzero(rank == least)
            new_run = np.diff(at, prepend=-2) != 1  # of x x x x only every second pair merges
            begin = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
            sym[at] = self.made[row[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            stale = np.zeros(len(sym), bool)
            stale[at] = stale[at[at > 0] - 1] = True
            sym, word, rank, row, stale = sym[keep], word[keep], rank[keep], row[keep], stale[keep]
            redo = np.flatnonzero(stale)
            rank[redo], row[redo] = self._ranks(sym, word, redo)
        which = np.concatenate([w for w, _ in done])
        ids = np.concatenate([s for _, s in done])[np.argsort(which, kind="stable")]
        return ids, np.bincount(which, minlength=len(words))

    def _ranks(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """rank() of the pairs that begin at `at` (all of them); the last symbol of a word begins none."""
        if at is None:
            at = np.arange(len(sym))
        after = np.minimum(at + 1, len(sym) - 1)
        rank, row = self.rank(sym[at], sym[after])
        rank[(word[at] != word[after]) | (at == after)] = NO_RANK
        return rank, row

    def merge_long(self, word: bytes) -> np.ndarray:
        """The ids of one very long word, in n log n."""
        sym = self.first[np.frombuffer(word, np.uint8)].tolist()
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        table = {k: (r, m) for k, r, m in zip(self.keys.tolist(), self.ranks.tolist(), self.made.tolist(), strict=True)} if n > 50_000 else None

        def pair(i: int, j: int) -> tuple[int, int] | None:
            key = sym[i] << 32 | sym[j]
            if table is not None:
                return table.get(key)
            row = int(np.searchsorted(self.keys, key))
            return (int(self.ranks[row]), int(self.made[row])) if row < len(self.keys) and self.keys[row] == key else None

        heap = [(p[0], i, sym[i], sym[i + 1], p[1]) for i in range(n - 1) if (p := pair(i, i + 1))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i] if sym[i] == a else n
            if j >= n or sym[j] != b:
                continue
            sym[i], sym[j], after[i] = made, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (p := pair(x, y)):
                    heapq.heappush(heap, (p[0], x, sym[x], sym[y], p[1]))
        return np.array([s for s in sym if s >= 0], np.int64)

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many of them each text has)."""
        if len(self.slots) > WORDS_KEPT:
            self.forget()
        split = [self.split(t) for t in batch]
        new = set().union(*split).difference(self.slots)
        short, long = [], []
        for w in new:
            (long if len(w) > LONG_WORD else short).append(w)
        if short:
            self._learn(short, *self.merge([w.encode() for w in short]))
        for w in long:
            ids = self.merge_long(w.encode())
            self._learn([w], ids, np.array([len(ids)]))
        per_text = np.array([len(words) for words in split], np.int64)
        slot = np.fromiter(map(self.slots.__getitem__, chain.from_iterable(split)), np.int64, per_text.sum())
        begin, size = self.at[slot], self.at[slot + 1] - self.at[slot]
        ids = self.store[np.repeat(begin, size) + runs(size)]
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(per_text)])]
        return ids, np.diff(ends)


class Table:
    """Byte strings by number."""

    def __init__(self, rows: list[bytes]) -> None:
        self.size = np.array([len(r) for r in rows], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(rows), np.uint8)

    def join(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The joined strings of ids[:ends[0]], ids[ends[0]:ends[1]] ..."""
        size = self.size[ids]
        data = self.data[np.repeat(self.at[ids], size) + runs(size)].tobytes()
        cuts = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], ends])].tolist()
        return [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


@cache
def load(path: str) -> Bpe:
    return Bpe(path)


def encode_texts(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids): each whole text's token ids, without added special tokens.

    A null or empty text has no ids. Every row counts, repeated ones and those with
    null keys too; other columns are not read. `path` is a byte-level BPE file of the
    tokenizers library, at the same place on every machine.
    """
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in blocks(batches, text):
            ids, n = bpe.encode(batch.column(text).fill_null("").to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(key), lists], [key, "ids"])

    return docs.select(key, text).mapInArrow(tidily(run), schema)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, where each list ends); null is empty."""
    n = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(n)


def decode_ids(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, text) from (key, ids): bytes that are not UTF-8 become replacement characters, null ids an empty text."""
    schema = f"{key} {encoded.schema[key].dataType.simpleString()}, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            decoded = [x.decode("utf-8", "replace") for x in bpe.bytes_of.join(*_lists(batch.column("ids")))]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(decoded, pa.string())], [key, "text"])

    return encoded.select(key, "ids").mapInArrow(tidily(run), schema)


def digests(encoded: DataFrame, path: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256[, ids]) of (key, ids): of the decimal ids joined by commas, and of the decoded text."""
    schema = f"{key} {encoded.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 250):
                part = batch.slice(a, 250)
                ids, ends = _lists(part.column("ids"))
                numbers = [hashlib.sha256(x[:-1]).hexdigest() for x in bpe.decimals.join(ids, ends)]
                decoded = [hashlib.sha256(x.decode("utf-8", "replace").encode()).hexdigest() for x in bpe.bytes_of.join(ids, ends)]
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(np.diff(ends, prepend=0)), pa.array(numbers), pa.array(decoded), *[part.column("ids")] * with_ids], [x.split()[0] for x in schema.split(", ")])

    return encoded.select(key, "ids").mapInArrow(tidily(run), schema)
