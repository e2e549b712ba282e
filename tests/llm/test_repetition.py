import random
import re
from collections import Counter

import pytest

from quaybook.llm.repetition import DUP_LINE_CHARS, DUP_LINE_SHARE, DUP_NGRAM, TOP_NGRAM, repetition

SCHEMA = "doc_id long, text string, kept string, n_words int"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    chars = sum(map(len, words))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    again = [x for i, x in enumerate(lines) if x in lines[:i]]
    out = {"n_words": len(words), "word_chars": chars, "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": len(again)}
    out["dup_line_share"] = len(again) / max(1, len(lines))
    out["dup_line_chars"] = sum(map(len, again)) / max(1, sum(map(len, lines)))
    for n in range(2, 11):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        count = Counter(grams)
        covered = {i + j for i, g in enumerate(grams) if count[g] > 1 for j in range(n)}
        if n in TOP_NGRAM:
            out[f"top_{n}gram_chars"] = max([0, *(c * sum(map(len, g)) for g, c in count.items() if c > 1)]) / max(1, chars)
        if n in DUP_NGRAM:
            out[f"dup_{n}gram_chars"] = sum(len(words[i]) for i in covered) / max(1, chars)
        if n == 3:
            out["n_repeat_words"] = len(covered)
    out["base_failed"] = len(words) < 50 or 100 * out["n_repeat_words"] > 50 * len(words)
    out["kept"] = not out["base_failed"] and out["dup_line_share"] <= DUP_LINE_SHARE and out["dup_line_chars"] <= DUP_LINE_CHARS
    out["kept"] = out["kept"] and all(out[f"top_{n}gram_chars"] <= m for n, m in TOP_NGRAM.items()) and all(out[f"dup_{n}gram_chars"] <= m for n, m in DUP_NGRAM.items())
    return out


def cases():
    rng = random.Random(5)
    yield from [None, "", " ", "\n\n", "a", "é b\x0bc\x85d", "a b c " * 40, "x\n" * 9, "one\r\none\n one\none"]
    for size in (5, 30, 400, 60_000):
        for vocab in (3, 30, 5000):
            yield "".join(f"w{rng.randrange(vocab)}é{rng.choice([' ', ' ', ' ', '  ', chr(10), ' | '])}" for _ in range(size))


def test_matches_brute_force(spark):
    texts = list(cases()) + ["same words here " * 20] * 2
    rows = [(None if i == 3 else i, t, "x", 1) for i, t in enumerate(texts)]
    got = sorted(repetition(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: -1 if r.doc_id is None else r.doc_id)
    assert len(got) == len(rows)
    for row in got:
        want = brute(texts[3 if row.doc_id is None else row.doc_id])
        for name, value in want.items():
            assert row[name] == pytest.approx(value), (row.doc_id, name)


def test_empty_table(spark):
    assert repetition(spark.createDataFrame([], SCHEMA)).count() == 0
