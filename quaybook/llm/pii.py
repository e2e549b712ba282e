"""Personal data, plain and disguised, at its place in the source text.

A Tape is a text whose every character knows the source characters it came from.
Transducers rewrite a tape: look-alike characters to ASCII, spelled digits to digits,
"at" and "dot" disguises to @ and full stops. Identifiers found on the rewritten tape
map back to the source. Texts without any sign of a disguise skip all that.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from quaybook.llm.common import blocks, tidily

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, str, int]

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters that look like ASCII ones, in pairs.
LOOKALIKES = "аa еe оo рp сc уy хx іi јj ѕs һh ԁd ԛq ԝw ѵv ɡg ɑa ıi ℓl αa οo νv ρp υu κk ιi τt АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЈJ ЅS ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX"
# Other signs for @ . - + and the space, and characters without width.
SIGNS = {"@": "﹫", ".": "․﹒。", "-": "‐‑‒–—−﹣", "+": "﹢", " ": "              　", "": "­​‌‍⁠﻿"}
# The digits 0 to 9 in English, German, Spanish and French.
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
    "zéro un deux trois quatre cinq six sept huit neuf",
)


def _glyphs() -> dict[int, str]:
    table = {ord(a): b for a, b in LOOKALIKES.split()}
    table |= {ord(c): sign for sign, others in SIGNS.items() for c in others}
    table |= {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}  # full-width forms
    for c in range(0x660, 0x1FBFA):  # decimal digits of all scripts
        if (digit := unicodedata.decimal(chr(c), None)) is not None:
            table[c] = str(digit)
    return table


_GLYPHS = _glyphs()
_GLYPH = re.compile("[" + "".join(map(chr, _GLYPHS)) + "]")
_GLYPH_CHARACTERS = set(map(chr, _GLYPHS))
_DIGIT_OF = {w: str(d) for words in DIGIT_WORDS for d, w in enumerate(words.split())}
_ONE_WORD = "(?:" + "|".join(sorted(_DIGIT_OF, key=len, reverse=True)) + ")"
#: What may stand between the digits of a number, before or after the transducers.
_BETWEEN = r"[\s,().-]"
#: Where spelled_digits() can bring an identifier to light: a digit word next to a digit or to another one, "plus" before a digit. For folded text: without (?i) most words fail at their first letter.
_SPELLED = re.compile(rf"\b(?:{_ONE_WORD}\b{_BETWEEN}*(?:[0-9]|\b{_ONE_WORD}\b)|plus[\s,-]{{1,3}}[0-9])|[0-9]{_BETWEEN}+{_ONE_WORD}\b")
#: The words of which _SPELLED needs one, each whole.
_SPELLING, _WORD = {*_DIGIT_OF, "plus"}, re.compile(r"\w+")
#: Signs that (?i) takes for letters of digit words, though lower() doesn't give these.
_FOLD = str.maketrans("ſİıK", "siik")
#: A digit word that isn't ASCII can also complete the domain after an @.
_NON_ASCII_WORD = re.compile("(?i)[ſİıK]|" + "|".join(sorted(w for w in _DIGIT_OF if not w.isascii())))
_SPELLED_OR_DIGIT = re.compile(rf"(?i)\b(?P<word>{_ONE_WORD})\b|(?P<digit>[0-9])")
_JOINT = re.compile(r"[\s,-]{1,3}")

_OPEN, _CLOSE = r"\s*[\[({<]\s*", r"\s*[\])}>]\s*"
_AT_WORD, _DOT_WORD = "(?:at|arroba)", "(?:dot|punkt|punto)"
_BRACKETED_AT = rf"{_OPEN}(?:{_AT_WORD}|@){_CLOSE}"
_BRACKETED_DOT = rf"{_OPEN}(?:{_DOT_WORD}|\.){_CLOSE}"
_ANY_DOT = rf"(?:{_BRACKETED_DOT}|[ \t]+{_DOT_WORD}[ \t]+|\.)"
_HIDDEN_DOT = rf"(?:{_BRACKETED_DOT}|[ \t]+{_DOT_WORD}[ \t]+)"
_NAME = r"[A-Za-z0-9-]+"
#: An @ in brackets or beside spaces with any dots; a bare "at", or any @, with hidden dots; numbers between hidden dots.
_ADDRESS = re.compile(rf"(?i)(?<=[A-Za-z0-9._%+-])(?:(?P<a>{_BRACKETED_AT}|[ \t]+@[ \t]*|@[ \t]+){_NAME}(?:{_ANY_DOT}{_NAME})+|(?P<b>[ \t]+{_AT_WORD}[ \t]+|[ \t]*@[ \t]*){_NAME}(?:{_HIDDEN_DOT}{_NAME})+)")
_IN_LOCAL = re.compile(rf"(?i){_HIDDEN_DOT}(?=[A-Za-z0-9])")
_NUMBERS = re.compile(rf"(?i)[0-9]{{1,3}}(?:{_ANY_DOT}[0-9]{{1,3}}(?![0-9])){{3}}")
_SOME_DOT = re.compile(rf"(?i){_HIDDEN_DOT}")
_SIGN = re.compile(rf"(?i)[\[({{<]\s*(?:at\b|dot\b|@|\.|arroba|punkt|punto)|\b(?:dot|punkt|punto)\b")
_PLUS = re.compile(r"(?i)\bplus[\s,-]{1,3}(?=[0-9])")
_SPACED_AT = re.compile(r"[ \t]@|@[ \t]")
_HINTS = ("dot", "punkt", "punto", "[", "(", "{", "<")


class Tape:
    """A text and, for each of its characters, where in the source it begins and ends."""

    def __init__(self, text: str, begin: list[int] | None = None, end: list[int] | None = None) -> None:
        self.text = text
        self.begin = list(range(len(text))) if begin is None else begin
        self.end = list(range(1, len(text) + 1)) if end is None else end

    def rewrite(self, changes: list[tuple[int, int, str]]) -> Tape:
        """With text[a:b] replaced for each (a, b, by), in order and apart; `by` has at most one character."""
        text, begin, end, at = [], [], [], 0
        for a, b, by in changes:
            text += [self.text[at:a], by]
            begin += self.begin[at:a]
            end += self.end[at:a]
            if by:
                begin.append(self.begin[a])
                end.append(self.end[b - 1])
            at = b
        return Tape("".join([*text, self.text[at:]]), begin + self.begin[at:], end + self.end[at:])


def plain_glyphs(tape: Tape) -> Tape:
    return tape.rewrite([(m.start(), m.end(), _GLYPHS[ord(m.group())]) for m in _GLYPH.finditer(tape.text)])


def spelled_digits(tape: Tape) -> Tape:
    """Digit words to digits; what separates a digit word from the next digit goes."""
    changes, last = [], None
    for m in _SPELLED_OR_DIGIT.finditer(tape.text):
        word = m["word"]
        if last and (word or last[1]) and last[0] < m.start() and _JOINT.fullmatch(tape.text, last[0], m.start()):
            changes.append((last[0], m.start(), ""))
        if word:
            changes.append((m.start(), m.end(), _DIGIT_OF[word.translate(_FOLD).lower()]))
        last = m.end(), word
    tape = tape.rewrite(changes)
    return tape.rewrite([(m.start(), m.end(), "+") for m in _PLUS.finditer(tape.text)])


def _before_dot(text: str, at: int) -> int:
    """Where a hidden dot that ends at `at` can begin: before spaces, brackets, a word or a full stop, brackets and spaces."""
    for fits in (_beside_dot, str.isalpha, _beside_dot):
        while at and (fits(text[at - 1]) or (fits is str.isalpha and text[at - 1] == ".")):
            at -= 1
    return at


def _beside_dot(c: str) -> bool:
    return c.isspace() or c in "[](){}<>"


def signs(tape: Tape) -> Tape:
    """Disguised @ and full stops of addresses and of four numbers."""
    changes = []
    for m in _ADDRESS.finditer(tape.text):
        local = m.start()
        while True:  # hidden dots in the local part: first [dot] last [at] ...
            while local and tape.text[local - 1] in _LOCAL:
                local -= 1
            hidden = next((x for x in _IN_LOCAL.finditer(tape.text, _before_dot(tape.text, local), local + 1) if x.end() == local), None)
            if hidden is None or not hidden.start() or (changes and changes[-1][1] > hidden.start()):
                break
            changes.append((hidden.start(), hidden.end(), "."))
            local = hidden.start()
        group = "a" if m["a"] is not None else "b"
        changes.append((*m.span(group), "@"))
        changes += [(x.start(), x.end(), ".") for x in _SOME_DOT.finditer(tape.text, m.end(group), m.end())]
    tape = tape.rewrite(sorted(set(changes)))
    changes = [(x.start(), x.end(), ".") for m in _NUMBERS.finditer(tape.text) for x in _SOME_DOT.finditer(tape.text, m.start(), m.end())]
    return tape.rewrite(changes)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    at, done = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            done = found.end()
            yield begin, "email", done
        else:
            done = at + 1
        at = text.find("@", max(at + 1, done))


def _numbers(text: str) -> Iterator[Span]:
    """Addresses and cards, from the runs of digits."""
    runs = [m.span() for m in _DIGITS.finditer(text)]
    i = 0
    while i + 3 < len(runs):
        four = runs[i : i + 4]
        if all(b[0] - a[1] == 1 and text[a[1]] == "." for a, b in zip(four, four[1:], strict=False)):
            if all(len(part := text[a:b].lstrip("0")) <= 3 and int(part or 0) <= 255 for a, b in four):
                yield four[0][0], "ip", four[3][1]
            i += 4
        else:
            i += 1
    i = 0
    while i < len(runs):
        j, n = i + 1, runs[i][1] - runs[i][0]
        while j < len(runs) and runs[j][0] - runs[j - 1][1] == 1 and text[runs[j - 1][1]] in " -":
            n += runs[j][1] - runs[j][0]
            j += 1
        if 12 <= n <= 19 and _luhn("".join(text[a:b] for a, b in runs[i:j])):
            yield runs[i][0], "card", runs[j - 1][1]
        i = j


def _phones(text: str) -> Iterator[Span]:
    at = text.find("+")
    while at >= 0:
        found = _PHONE.match(text, at)
        if found and 9 <= sum(map(str.isdigit, found.group())) <= 15:
            yield at, "phone", found.end()
        at = text.find("+", found.end() if found else at + 1)


def find(text: str) -> list[Span]:
    """(start, kind, end) of the identifiers that stand there undisguised, by start, then kind."""
    found = list(_emails(text)) if "@" in text else []
    if _DIGITS.search(text):
        found += _numbers(text)
        if "+" in text:
            found += _phones(text)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def may_be_disguised(text: str) -> bool:
    """Whether the transducers can bring anything to light; true for more texts than those, never for fewer."""
    if not text.isascii() and (not _GLYPH_CHARACTERS.isdisjoint(text) or ("@" in text and _NON_ASCII_WORD.search(text) is not None)):
        return True
    lower = text.lower()
    if any(h in lower for h in _HINTS) and _SIGN.search(text) is not None:
        return True
    if "@" in text and _SPACED_AT.search(text) is not None:
        return True
    folded = lower if text.isascii() else text.translate(_FOLD).lower()
    return not _SPELLING.isdisjoint(_WORD.findall(folded)) and _SPELLED.search(folded) is not None


def find_disguised(text: str, base: list[Span], gated: bool = True) -> list[Span]:
    """What more the transducers bring to light: identifiers that overlap none of their kind in `base`.

    Not gated, they also run where there is nothing for them, with the same result.
    """
    if gated and not may_be_disguised(text):
        return []
    tape = spelled_digits(plain_glyphs(Tape(text)))
    tape = signs(tape)
    taken = {kind: ([a for a, k, _ in base if k == kind], [b for _, k, b in base if k == kind]) for kind in KINDS}
    found = []
    for a, kind, b in find(tape.text):
        begin, end = tape.begin[a], tape.end[b - 1]
        starts, ends = taken[kind]  # those of a kind don't overlap, so both rise
        before = bisect_left(starts, end)
        if not before or ends[before - 1] <= begin:
            found.append((begin, kind, end))
    return found


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def find_pii(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every whole text.

    The counts and base_sha256 are of undisguised identifiers; `spans` has these and the
    n_added disguised ones, as kind:start:end in code points of the source. A null or
    empty text has none. Every row counts, repeated ones and those with null keys too;
    other columns are not read.
    """
    names = [key, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            rows = []
            for body in batch.column(text).fill_null("").to_pylist():
                base = find(body)
                added = find_disguised(body, base)
                everything = sorted(base + added, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))
                kinds = [s[1] for s in base]
                rows.append((*map(kinds.count, KINDS), hashlib.sha256(written(base).encode()).hexdigest(), written(everything), len(added)))
            types = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(key), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names)

    return docs.select(key, text).mapInArrow(tidily(run), schema)
