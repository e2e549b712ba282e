"""Predictions against the formula written out, for every language densely."""

import math
import random
from collections import Counter

import pytest

from quaybook.llm import langid


def brute(counts, text):
    languages = sorted(counts)

    def share(tables, item):
        items = set().union(*tables)
        if item not in items:
            return None
        log = [math.log((t.get(item, 0) + 0.5) / (sum(t.values()) + 0.5 * len(items))) for t in tables]
        whole = math.log(sum(map(math.exp, log)))
        return [x - whole for x in log]

    words = [counts[x] for x in languages]
    grams = {n: [Counter() for _ in languages] for n in range(1, langid.LONGEST + 1)}
    for n, tables in grams.items():
        for table, of in zip(tables, words, strict=True):
            for w, c in of.items():
                table.update({g: c * k for g, k in Counter(langid.ngrams(w, n)).items()})

    def evidence(word):
        if known := share(words, word):
            return known
        for n in range(min(langid.LONGEST, len(word) + 2), 0, -1):
            found = [x for g in langid.ngrams(word, n) if (x := share(grams[n], g))]
            if found:
                return [sum(c) / len(found) for c in zip(*found, strict=True)]
        return [-math.log(len(languages))] * len(languages)

    rows = [evidence(w) for w in langid.words_of(text) if any(map(str.isalpha, w))]
    if not rows:
        return "und", 0.0
    total = [sum(c) for c in zip(*rows, strict=True)]
    best = max(range(len(languages)), key=lambda i: (round(total[i], 5), -i))
    return languages[best], sum(math.exp(r[best]) for r in rows) / len(rows)


@pytest.mark.parametrize("n", [1, 2, 7])
def test_predictions(n, monkeypatch):
    monkeypatch.setattr(langid, "CELLS", 12)  # texts are weighed in parts
    rng = random.Random(n)

    def word():
        return "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))

    counts = {f"l{i}": {word(): rng.randint(1, 9) for _ in range(30)} for i in range(n)}
    model = langid.Model(counts)
    pool = [w for c in counts.values() for w in c]
    texts = [" ".join(rng.choice(pool) if rng.random() < 0.6 else word() + rng.choice(["", "zz"]) for _ in range(rng.randint(0, 25))) for _ in range(60)]
    for text, lang, score in zip(texts, *model.predict(texts), strict=True):
        want = brute(counts, text)
        assert lang == want[0], text
        assert score == pytest.approx(want[1], abs=1e-5)


def test_ties_go_to_the_first():
    model = langid.Model({"b": {"one": 2, "two": 1}, "a": {"one": 2, "two": 1}})
    assert model.predict(["one two", "three", "", "12"])[0] == ["a", "a", "und", "und"]


def test_many_languages():
    """There is no limit to the languages, and a table's size goes with what was counted."""
    counts = {f"l{i:04}": {f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}": 3} for i in range(1500)}
    model = langid.Model(counts)
    assert len(model.words.lang) == 1500
    assert model.predict([next(iter(counts["l1234"]))])[0] == ["l1234"]
