"""Phrases against all windows of words, counted one by one."""

import random
import re
from collections import Counter, defaultdict

import pytest

from quaybook.llm.phrases import phrases

SCHEMA = "doc_id long, text string, lang string, rank string, phrase string, score string"


def plain(rows, least, longest, top):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    covered = set()
    for (lang, g), a in often.items():
        for size in range(2, len(g)):
            for i in range(len(g) - size + 1):
                part = (lang, g[i : i + size])
                if 100 * a >= 80 * often[part]:
                    covered.add(part)
    found = defaultdict(list)
    for (lang, g), a in often.items():
        if (lang, g) not in covered:
            cuts = []
            for k in range(1, len(g)):
                left, right = f[lang, g[:k]], f[lang, g[k:]]
                cuts.append((2_000_000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            found[lang].append((-score, -a, " ".join(g).encode(), left, right))
    return sorted((lang, i + 1, g.decode(), -a, left, right, n[lang], -score) for lang, x in found.items() for i, (score, a, g, left, right) in enumerate(sorted(x)[:top]))


def some(seed, n, vocabulary):
    rng = random.Random(seed)
    fixed = ["Über Alles geht", "new york city hall", "as well as", "\x1c odd é"]
    rows = []
    for i in range(n):
        words = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        rows.append((i, "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "!"]) for w in words), rng.choice(["en", "de", None, "und", ""]), "x", "y", "z"))
    return rows


ROWS = {
    "mixed": some(1, 300, ["a", "B", "cc", "Dd", "é", "É", "漢字", "\xa0", "'", "-"]),
    "many words": some(2, 200, [f"w{i}" for i in range(3000)]),
    "one word": [(1, "go " * 5000, "en", "x", "y", "z"), (2, None, "en", "x", "y", "z"), (3, "", None, "x", "y", "z"), (None, "go go", None, "x", "y", "z")],
    "repeated rows": [(7, "the quick brown fox, jumps over it", "en", "x", "y", "z")] * 40,
    "long": [(1, " ".join(f"k{i % 700}" for i in range(60_000)), "en", "x", "y", "z"), (2, "z" * 400_000 + " end of it", "en", "x", "y", "z")],
}


@pytest.mark.parametrize(("name", "options"), [*((name, {}) for name in ROWS), ("mixed", {"broadcast_words": 0}), ("long", {"broadcast_words": 0}), ("many words", {"bits": 7})])
def test_phrases(spark, name, options):
    df = spark.createDataFrame(ROWS[name], SCHEMA).repartition(3)
    for least, longest, top in ((5, 4, 2000), (2, 3, 20)) if name == "mixed" and not options else ((2, 4, 100),):
        out = phrases(df, least=least, longest=longest, top=top, **options)
        assert out.columns == "lang rank phrase a l r n score".split()
        assert sorted(map(tuple, out.collect())) == plain(ROWS[name], least, longest, top)


def test_no_rows(spark):
    df = spark.createDataFrame([(1, None, None, "x", "y", "z")], SCHEMA)
    assert phrases(df).isEmpty()
    assert phrases(df.where("false")).isEmpty()
    with pytest.raises(ValueError, match="words"):
        phrases(df, longest=5)
