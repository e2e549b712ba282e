"""Quality rules on repetition: how much of a text lies in repeated n-grams and lines.

A block of texts is one byte array. Rolling hashes give each word, line and window of
n words 64 bits; sorting these finds what occurs twice in the same text. A window of n
words can only be repeated where its two windows of n - 1 words are, so each length
looks at what the one before it left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quaybook.llm.common import blocks, mix, rolling, texts, tidily

BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F

# The largest shares allowed by the repetition rules of Rae et al. 2021, table A1.
TOP_NGRAM = {2: 0.20, 3: 0.18, 4: 0.16}
DUP_NGRAM = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
DUP_LINE_SHARE = 0.30
DUP_LINE_CHARS = 0.20

COLUMNS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean",
    "dup_line_share": "double", "dup_line_chars": "double", **{f"top_{n}gram_chars": "double" for n in TOP_NGRAM}, **{f"dup_{n}gram_chars": "double" for n in DUP_NGRAM},
}


def _repeated(key: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    if len(key) < 2:
        return np.zeros(len(key), bool)
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return np.zeros(len(key), bool)
    return twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def measure(raw: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """COLUMNS of the texts raw[starts[i]:starts[i + 1]]."""
    docs = len(starts) - 1

    def total(doc: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(doc, values, docs).astype(np.int64)

    gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    fresh = np.ones(len(raw) + 1, bool)
    fresh[1:-1] = gap[:-1]
    fresh[starts] = True  # a text's first byte, and the end
    solid = np.append(~gap, False)
    begin = np.flatnonzero(solid & fresh)
    end = np.flatnonzero(np.append(solid[:-1] & (~solid[1:] | fresh[1:]), False)) + 1
    at_char = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    sums, inverse = rolling(raw.astype(np.uint64) + np.uint64(1), BYTE_BASE)
    word = mix((sums[end] - sums[begin]) * inverse[begin])
    doc = np.searchsorted(starts, begin, side="right") - 1
    chars = at_char[end] - at_char[begin]
    out = {"n_words": total(doc), "word_chars": total(doc, chars)}
    marks = np.flatnonzero(np.isin(raw, np.frombuffer(b"#*$%&|<>", np.uint8)))
    out["n_symbols"] = total(np.searchsorted(starts, marks, side="right") - 1)

    breaks = np.flatnonzero(raw == 10)
    line_at = np.union1d(starts[:-1], breaks + 1)
    line_at = line_at[line_at < len(raw)]
    line_doc = np.searchsorted(starts, line_at, side="right") - 1
    line_end = np.append(line_at[1:], len(raw))
    ends_with_break = (line_end > line_at) & (raw[line_end - 1] == 10)
    line_end = line_end - ends_with_break
    has_word = np.searchsorted(begin, line_end) > np.searchsorted(begin, line_at)
    line_at, line_end, line_doc = line_at[has_word], line_end[has_word], line_doc[has_word]
    line = mix(mix((sums[line_end] - sums[line_at]) * inverse[line_at]) + line_doc.astype(np.uint64))
    first = np.unique(line, return_index=True)[1]
    again = np.ones(len(line), bool)
    again[first] = False
    line_chars = at_char[line_end] - at_char[line_at]
    out["n_dup_lines"] = total(line_doc[again])
    out["dup_line_share"] = _share(out["n_dup_lines"], total(line_doc))
    out["dup_line_chars"] = _share(total(line_doc, line_chars * again), total(line_doc, line_chars))

    word_sums, word_inverse = rolling(word, WORD_BASE)
    char_sums = np.concatenate([[0], np.cumsum(chars)])
    last = np.searchsorted(begin, starts[1:])  # where each text's words end
    left = last[doc] - np.arange(len(doc))  # words from here to the text's end
    window = np.arange(len(word))
    salt = mix(doc.astype(np.uint64))
    for n in range(2, max(DUP_NGRAM) + 1):
        window = window[left[window] >= n]
        key = mix((word_sums[window + n] - word_sums[window]) * word_inverse[window] + salt[window])
        twice = _repeated(key)
        window, key = window[twice], key[twice]
        if n in TOP_NGRAM:
            _, one, count = np.unique(key, return_index=True, return_counts=True)
            size = (char_sums[window[one] + n] - char_sums[window[one]]) * count
            top = np.zeros(docs, np.int64)
            np.maximum.at(top, doc[window[one]], size)
            out[f"top_{n}gram_chars"] = _share(top, out["word_chars"])
        if n == 3 or n in DUP_NGRAM:
            edge = np.zeros(len(word) + 1, np.int64)
            np.add.at(edge, window, 1)
            np.add.at(edge, window + n, -1)
            covered = np.cumsum(edge[:-1]) > 0
            if n == 3:
                out["n_repeat_words"] = total(doc[covered])
            if n in DUP_NGRAM:
                out[f"dup_{n}gram_chars"] = _share(total(doc, chars * covered), out["word_chars"])
        pair = np.zeros(len(word) + 1, bool)
        pair[window] = True
        window = window[pair[window + 1]]
    failed = (out["n_words"] < 50) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
    kept = ~failed & (out["dup_line_share"] <= DUP_LINE_SHARE) & (out["dup_line_chars"] <= DUP_LINE_CHARS)
    for n, most in TOP_NGRAM.items():
        kept &= out[f"top_{n}gram_chars"] <= most
    for n, most in DUP_NGRAM.items():
        kept &= out[f"dup_{n}gram_chars"] <= most
    return out | {"base_failed": failed, "kept": kept}


def repetition(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, COLUMNS): word and repetition counts of every whole text, and the verdicts.

    Words are runs of bytes other than space and U+0009 to U+000D. base_failed: under 50
    words, or more than half of them in 3-word windows that occur twice. kept: not
    base_failed, and no repetition share above its bound. Shares are of the words'
    characters, those of lines of the characters in lines that have a word; top_n is the
    n-gram that takes most characters among those that occur twice. A null or empty text
    has zeros and is not kept. Every row counts, repeated ones and those with null keys
    too; other columns are not read.
    """
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, " + ", ".join(f"{k} {v}" for k, v in COLUMNS.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            found = measure(*texts(batch.column(text)))
            yield pa.RecordBatch.from_arrays([batch.column(key), *(pa.array(found[c]) for c in COLUMNS)], [key, *COLUMNS])

    return docs.select(key, text).mapInArrow(tidily(run), schema)
