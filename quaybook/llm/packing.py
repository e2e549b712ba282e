"""Packing into training sequences: vector bin packing by dot products.

An example's demand is a vector (tokens, segments, loss-bearing tokens), and so is what
a sequence has left. The sequence that is open takes, again and again, the example that
fits and whose demand has the largest dot product with what is left, each part measured
in its limit: while tokens are plenty and segments scarce, long examples come first, and
so on. When nothing fits, the example of the largest product is cut, if cuts are allowed.

Each task packs the documents of its own partition from a pool of bounded size, so nothing is
shuffled, and a task that runs again makes whole sequences again.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaybook.llm.common import blocks, runs, tidily

#: Id that ends each example.
END_ID = 2
#: Tokens, segments and loss-bearing tokens that a sequence may have.
LIMITS = (4096, 256, 4096)
#: Examples, and tokens, that wait in a task's pool.
POOL_ITEMS, POOL_TOKENS = 1024, 1 << 20
#: Words that a worker remembers before it starts anew, and their bytes.
KEPT, KEPT_BYTES = 1_000_000, 32_000_000
#: Bytes of texts of ASCII and U+00C0 to U+00FF, but for control characters that aren't blanks.
PLAIN = bytes([9, 10, 11, 12, 13, *range(32, 127), *range(0x80, 0xC0), 0xC3])
#: What the tokenizer's file cuts plain lower-case text into (fixed, as the file has it).
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")


class Words:
    """A word tokenizer of the tokenizers library, and the words met so far.

    For files that lower-case, drop blanks, cut at PARTS and mark the last token of each part
    with </w>, as word_bpe_49k.json does. Texts of PLAIN bytes are cut into parts here, and the parts that
    are new go to the library together, as one text. Other texts are cut at ASCII blanks (each is a blank
    to the tokenizer, too, and none joins its neighbours) and go to the library as they are.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.last = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(self.tokenizer.get_vocab_size())])
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.slots: dict[str | bytes, int] = {}
        self.forget()

    def forget(self) -> None:
        self.slots.clear()
        self.bytes = 0
        self.ids = Lists()

    def _learn(self, new: list[str] | list[bytes]) -> None:
        if isinstance(new[0], str):
            ids = np.array(self.tokenizer.encode(" ".join(new), add_special_tokens=False).ids, np.int32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(new):
                raise ValueError("the tokenizer doesn't mark the ends of words")
            sizes = np.diff(ends, prepend=0)
        else:
            made = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch([w.decode() for w in new], add_special_tokens=False)]
            ids, sizes = np.concatenate(made), np.array([len(x) for x in made])
        self.slots.update(zip(new, range(len(self.slots), len(self.slots) + len(new)), strict=True))
        self.ids.extend(ids, sizes)
        self.bytes += sum(map(len, new))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.slots) > KEPT or self.bytes > KEPT_BYTES:
            self.forget()
        plain = [not t.translate(None, PLAIN) and not any(s in t for s in self.special) for t in texts]
        out: list[np.ndarray | None] = [None] * len(texts)
        for kind, cut in ((True, lambda t: PARTS.findall(t.decode().lower())), (False, bytes.split)):
            rows = [i for i, p in enumerate(plain) if p is kind]
            split = [cut(texts[i]) for i in rows]
            words = list(chain.from_iterable(split))
            at = np.fromiter(map(self.slots.get, words, repeat(-1)), np.int64, len(words))
            if len(unknown := np.flatnonzero(at < 0)):
                new = [words[i] for i in unknown.tolist()]
                self._learn(list(dict.fromkeys(new)))
                at[unknown] = np.fromiter(map(self.slots.__getitem__, new), np.int64, len(new))
            ids, size = self.ids.take(at)
            ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *map(len, split)])].tolist()
            for i, a, b in zip(rows, ends, ends[1:], strict=False):
                out[i] = ids[a:b]
        return out


class Lists:
    """Lists of ids, one after another in arrays that grow."""

    def __init__(self) -> None:
        self.n = self.end = 0
        self.ids, self.begin, self.size = np.empty(1 << 16, np.int32), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int32)

    def extend(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        for name, more in (("ids", self.end + len(ids)), ("begin", self.n + len(sizes)), ("size", self.n + len(sizes))):
            if more > len(x := getattr(self, name)):
                setattr(self, name, np.concatenate([x, np.empty(max(more, 2 * len(x)) - len(x), x.dtype)]))
        self.ids[self.end : self.end + len(ids)] = ids
        self.begin[self.n : self.n + len(sizes)] = self.end + np.cumsum(sizes) - sizes
        self.size[self.n : self.n + len(sizes)] = sizes
        self.n, self.end = self.n + len(sizes), self.end + len(ids)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids of these lists, how many each has)."""
        size = self.size[at].astype(np.int64)
        return self.ids[np.repeat(self.begin[at], size) + runs(size)], size


@cache
def load(path: str) -> Words:
    return Words(path)


@dataclass(slots=True)
class Example:
    """What is still to be placed of a document: ids[start:]; the ids before `prompt` bear no loss."""

    key: object
    ids: np.ndarray
    prompt: int
    start: int = 0

    def need(self) -> tuple[int, int, int]:
        n = len(self.ids) - self.start
        return n, 1, n - max(0, min(n, self.prompt - self.start))


#: (example, start, length) of a piece, and the number of a sequence with its pieces.
Piece = tuple[Example, int, int]


class Pool:
    """Examples that wait, and the sequences made of them."""

    def __init__(self, limits: tuple[int, int, int], cut: bool) -> None:
        self.limits, self.cut = np.array(limits, np.int64), cut
        self.items: list[Example | None] = []
        self.need = np.zeros((3, 0), np.int64)  # none of a segment for what is placed
        self.free = np.zeros(0, np.int64)  # ids before the loss begins
        self.waiting = self.tokens = 0
        self.done: list[list[Piece]] = []

    def add(self, new: list[Example]) -> None:
        """Examples beyond a limit give whole pieces at once, cut or not: what is left fits an empty sequence."""
        for x in new:
            while (np.array(x.need()) > self.limits).any():
                n = int(self._prefix(len(x.ids) - x.start, x.prompt - x.start, self.limits))
                self._close([(x, x.start, n)])
                x.start += n
        alive = [i for i, x in enumerate(self.items) if x is not None]
        self.items = [self.items[i] for i in alive] + new
        self.need = np.concatenate([self.need[:, alive], np.array([x.need() for x in new], np.int64).reshape(-1, 3).T], axis=1)
        self.free = np.concatenate([self.free[alive], np.array([x.prompt - x.start for x in new], np.int64)])
        self.waiting, self.tokens = len(self.items), int(self.need[0].sum())

    def _prefix(self, n, free, left):  # noqa: ANN001, ANN202 - of numbers or of arrays
        """The longest beginning that fits what is left."""
        return np.minimum(np.minimum(n, left[0]), np.maximum(free, 0) + left[2])

    def fill(self) -> None:
        """Make one sequence."""
        left, pieces = self.limits.copy(), []
        tokens, segments, loss = self.need
        while self.waiting and left[0] and left[1]:
            worth = left / self.limits**2
            product = tokens * worth[0] + segments * worth[1] + loss * worth[2]
            fits = np.where((tokens <= left[0]) & (loss <= left[2]), product, 0)
            i = int(fits.argmax())
            if fits[i] > 0:
                n = int(tokens[i])
            elif self.cut:
                prefix = self._prefix(tokens, self.free, left)
                i = int(np.where(prefix > 0, product, -1).argmax())
                n = int(prefix[i])
                if not n:
                    break
            else:
                break
            x = self.items[i]
            pieces.append((x, x.start, n))
            before = self.need[:, i].copy()
            x.start += n
            rest = np.array(x.need(), np.int64) if x.start < len(x.ids) else np.zeros(3, np.int64)
            left -= before - rest
            left[1] -= rest[1]  # the piece is a segment, and its rest will be one
            self.need[:, i], self.free[i] = rest, x.prompt - x.start
            self.tokens -= n
            if not rest[1]:
                self.items[i] = None
                self.waiting -= 1
        self._close(pieces)

    def _close(self, pieces: list[Piece]) -> None:
        """A full sequence stands as it is; what is short is cut to powers of two, which need no padding, if cuts are allowed."""
        n = sum(p[2] for p in pieces)
        if n == self.limits[0] or not self.cut:
            self.done.append(pieces)
            return
        rest = list(reversed(pieces))
        while n:
            room = 1 << (n.bit_length() - 1)
            n -= room
            made: list[Piece] = []
            while room:
                x, start, size = rest.pop()
                if size > room:
                    rest.append((x, start + room, size - room))
                    size = room
                made.append((x, start, size))
                room -= size
            self.done.append(made)

    def taken(self) -> list[list[Piece]]:
        out, self.done = self.done, []
        return out


def pack_examples(examples: DataFrame, path: str, text: str = "text", key: str = "doc_id", prompt: str | None = None, limits: tuple[int, int, int] = LIMITS, cut: bool = True, with_ids: bool = True) -> DataFrame:
    """A row for each piece: (key, start, length, n_loss, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    An example is the ids of its prompt, if there is such a column, those of its text, and
    END_ID; the prompt's bear no loss. `path` is a file of the tokenizers library whose
    pre-tokenizer drops blanks, at the same place on every machine. Each id lies in exactly one
    piece; within `limits` a sequence has its pieces without gaps, in the order of
    `offset`. With `cut`, examples are cut to fill sequences, and a sequence that stays short is
    cut to lengths that are powers of two. Without, only examples that exceed a limit by
    themselves are cut, and short sequences are the reader's to pad.

    A null or empty text is END_ID alone. Every row counts, repeated ones and those with null
    keys too; an empty table gives no piece. Other columns are not read. sequence_id is
    unique, not dense: the partition's number and a count.
    """
    if min(limits) < 1:
        raise ValueError("every limit must be 1 at least")
    names = [key, "start", "length", "n_loss", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]
    schema = f"`{key}` {examples.schema[key].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in names[1:8]) + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pool, made = load(path), Pool(limits, cut), TaskContext.get().partitionId() << 40

        def rows(kind: pa.DataType) -> Iterator[pa.RecordBatch]:
            nonlocal made
            sequences = pool.taken()
            for a in range(0, len(sequences), 250):
                columns: list[list] = [[] for _ in names]
                for pieces in sequences[a : a + 250]:
                    offset = 0
                    for x, start, n in pieces:
                        part = x.ids[start : start + n]
                        row = (x.key, start, n, n - max(0, min(n, x.prompt - start)), zlib.crc32(part.astype("<u4").tobytes()), len(x.ids), made, offset, part)
                        for c, v in zip(columns, row, strict=False):
                            c.append(v)
                        offset += n
                    made += 1
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:8]), *(pa.array(c, pa.list_(pa.int32())) for c in columns[8:])], names)

        kind = None
        for batch in blocks(batches, text):
            kind = batch.column(key).type
            parts = []
            for c in [*([prompt] if prompt else []), text]:
                parts.append(words.encode([x or b"" for x in batch.column(c).cast(pa.large_binary()).to_pylist()]))
            new = []
            for i, k in enumerate(batch.column(key).to_pylist()):
                own = [ids[i] for ids in parts]
                new.append(Example(k, np.concatenate([*own, [END_ID]]).astype(np.int32), len(own[0]) if prompt else 0))
            for a in range(0, len(new), POOL_ITEMS):
                pool.add(new[a : a + POOL_ITEMS])
                if pool.waiting > POOL_ITEMS or pool.tokens > POOL_TOKENS:
                    while pool.waiting > POOL_ITEMS // 2 or pool.tokens > POOL_TOKENS // 2:
                        pool.fill()
                yield from rows(kind)
        while pool.waiting:
            pool.fill()
        if kind is not None:
            yield from rows(kind)

    return examples.select(*dict.fromkeys([key, *([prompt] if prompt else []), text])).mapInArrow(tidily(run), schema)


def sequences(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """(sequence_id, ids, segments, loss) of pack_examples()'s pieces: for each id, the number of its segment from 1, and whether it bears loss."""
    part = F.struct("offset", "length", "n_loss", "ids")
    one = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))  # a sequence is within its limit of tokens
    numbered = F.transform("parts", lambda p, i: F.array_repeat(i + 1, p["length"].cast("int")))
    bears = F.transform("parts", lambda p: F.concat(F.array_repeat(F.lit(False), (p["length"] - p["n_loss"]).cast("int")), F.array_repeat(F.lit(True), p["n_loss"].cast("int"))))
    return one.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"), F.flatten(numbered).alias("segments"), F.flatten(bears).alias("loss"))
