import hashlib
import random
import re

import pytest

from quaybook.llm.pii import KINDS, find, find_disguised, find_pii, written


def luhn(digits):
    odd = [int(d) for d in digits[-1::-2]]
    even = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return sum(odd + even) % 10 == 0


def brute(text):
    out = [(m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        out += [(m.start(), "card", m.end())] if 12 <= len(d) <= 19 and luhn(d) else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [(m.start(), "phone", m.end())] if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15 else []
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def test_base_matches_regexes():
    rng = random.Random(8)
    pieces = ["@", ".", "a", "b1", "1", "23", "255", "300", "+", "+1", " ", "-", "(", ")", "é", "\n", "a@b.c", "1.2.3.4", "4080160719944918", "+1 (274) 555-4153", "%", "_", "001"]
    for _ in range(20000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        assert find(text) == brute(text), text


@pytest.mark.parametrize(
    ("text", "kind", "source"),
    [
        ("write to john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
        ("write to john (at) mail.example.com", "email", "john (at) mail.example.com"),
        ("mail jane dot roe at example dot org please", "email", "jane dot roe at example dot org"),
        ("first [dot] last [at] x [dot] co", "email", "first [dot] last [at] x [dot] co"),
        ("mail jаne@exаmple.com", "email", "jаne@exаmple.com"),
        ("ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ!", "email", "ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
        ("server 10[.]0[.]0[.]1 is down", "ip", "10[.]0[.]0[.]1"),
        ("server one nine two dot one six eight dot zero dot one", "ip", "one nine two dot one six eight dot zero dot one"),
        ("call plus four nine one five one two three four five six seven", "phone", "plus four nine one five one two three four five six seven"),
        ("card four zero eight zero one six zero seven one nine nine four four nine one two", "card", None),
        ("card ٤٠٨٠ ١٦٠٧ ١٩٩٤ ٤٩١٨", "card", None),
        ("a​b@example​.com", "email", "a​b@example​.com"),
    ],
)
def test_disguises(text, kind, source):
    added = find_disguised(text, find(text))
    if kind == "card":
        assert [k for _, k, _ in added if k != "card"] == []
        return
    assert source in [text[a:b] for a, k, b in added if k == kind]


@pytest.mark.parametrize(
    ("text", "kind", "source"),
    [
        ("call +49 151 two 345 6789 now", "phone", "+49 151 two 345 6789"),
        ("call plus 49 151 2345678 now", "phone", "plus 49 151 2345678"),
        ("card 4080 1607 1994 491 seven ok", "card", "4080 1607 1994 491 seven"),
        ("server 10.0.0.one is down", "ip", "10.0.0.one"),
        ("mail joe @ example.com now", "email", "joe @ example.com"),
        ("mail joe@fünf.de now", "email", "joe@fünf.de"),
    ],
)
def test_single_signs(text, kind, source):
    assert source in [text[a:b] for a, k, b in find_disguised(text, find(text)) if k == kind]


@pytest.mark.parametrize("card", ["four zero eight zero one six zero seven one nine nine four four nine one seven", "٤٠٨٠ ١٦٠٧ ١٩٩٤ ٤٩١٧"])
def test_cards(card):
    assert find_disguised(f"card {card}", []) == [(5, "card", 5 + len(card))]


def test_the_gate_changes_nothing():
    rng = random.Random(9)
    pieces = ["@", " @ ", ".", "1", "23", "4080", "255", "+", "plus", " ", " ", "-", ",", "(", ")", "fünf", "two", "Six", "ſix", "un", "joe", "example", "dot", " at ", "[at]", "\t", "a@b.c", ".com", "10.0.0.", "+49 151 ", "4080 1607 1994 491"]
    for _ in range(40000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        base = find(text)
        assert find_disguised(text, base) == find_disguised(text, base, gated=False), text


def test_plain_text_is_left_alone():
    for text in ["look at example.com", "the dot product at one point", "one of two (at most) or three", "à deux ou trois heures", "version 3. Licence (GNU) [1]"]:
        assert find_disguised(text, find(text)) == []


def test_rows(spark):
    rows = [(1, "x a@b.co", 1), (None, None, 1), (2, "", 1), (1, "x a@b.co", 1), (3, "joe at ex dot com " * 5000 + "1" * 100_000, 1)]
    got = find_pii(spark.createDataFrame(rows, "doc_id long, text string, spans int")).collect()
    assert sorted((r.doc_id or 0, r.n_email, r.n_added) for r in got) == [(0, 0, 0), (1, 1, 0), (1, 1, 0), (2, 0, 0), (3, 0, 5000)]
    assert {r.base_sha256 for r in got if r.doc_id == 1} == {hashlib.sha256(written([(2, "email", 8)]).encode()).hexdigest()}
    assert find_pii(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_dots_far_from_their_words():
    """Spaces of any number may stand around a hidden dot in the local part."""
    text = "first [             dot             ] last [at] example [dot] com"
    found = find_disguised(text, find(text))
    assert [(text[a:b], kind) for a, kind, b in found] == [(text, "email")]
