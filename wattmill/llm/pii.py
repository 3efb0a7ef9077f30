"""Personal data in whole texts, disguised or not, with offsets of the original.

Base spans are what four plain patterns find: e-mail addresses, IPv4 addresses, payment
cards and phone numbers. A transducer then rewrites disguises to a normal form
-- look-alike letters and digits, invisible characters, digits spelled in four languages, ``[at]``, ``(@)``, ``(dot)``,
``name at host dot tld`` and its German, Spanish and French forms, ``%40``, entities, addresses with a blank after every
character -- and records for every rewritten place where it came
from. The same detectors run over the normal form; a span found there is mapped back to the
original characters and added when it holds at least one rewritten place and is not inside a base span; a base card or phone number
is not extended by a single digit word after it.

Offsets are code points of the original text, end exclusive. Null and empty texts
have no spans. Every scan is linear in the text, so very long texts and runs are safe.
Repeated rows are handled one by one. Columns of the input that clash with the new ones are replaced.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, index of the kind, end

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){13,}+")
_CARD_RUN = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += _DOUBLED[int(c)] if i & 1 else int(c)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the e-mail pattern: each ``@`` takes all local characters before it."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            last = domain.end()
            yield start, last
            at = text.find("@", last)
        else:
            last = at + 1
            at = text.find("@", last)


def detect(text: str) -> list[Span]:
    """Spans of all four kinds, by start, then kind."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    if _CARD.search(text):
        for m in _CARD_RUN.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# Look-alikes of ASCII characters and words for digits.
_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "ο": "o", "ν": "v", "ρ": "p", "α": "a", "ι": "i", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M",
    "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "․": ".", "。": ".", "‐": "-", "‑": "-", "–": "-", " ": " ",
    "﹫": "@", "﹒": ".", "﹢": "+",
}
# Words for the digits 0 to 9 in English, German, Spanish and French.
_DIGIT_LISTS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
    "zéro un deux trois quatre cinq six sept huit neuf",
)
_DIGIT_WORDS = {word: str(i) for words in _DIGIT_LISTS for i, word in enumerate(words.split())}
_DIGIT_WORDS |= {"fuenf": "5", "fÜnf": "5", "zwo": "2", "zÉro": "0"}
#: Endings that a host of two labels has to have for bare ``at`` and ``dot`` to be taken for a disguise; longer hosts may have any.
_ENDINGS = "com|org|net|edu|gov|info|io|co|uk|de|fr|es|eu|it|nl|us|ch|at|ru|cn|jp|in|br|biz|dev|app|museum|mx|ar|ca|pl|se|email|cloud|online"
#: Words before a bare ``at`` that make it a preposition.
_PROSE = frozenset(
    "look looks looked looking stare stared see seen meet met arrive arrived arriving available found find listed hosted based work works worked"
    " working live lived living is are was were be been it them us me him her you here there and or not point pointed aimed visit page site".split()
)
_INVISIBLE = "­​‌‍⁠﻿"


def _wide() -> dict[str, str]:
    """Full-width forms, other scripts' and mathematical digits, by their regular code ranges."""
    table = {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}
    for zero in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6):
        table |= {chr(zero + i): str(i) for i in range(10)}
    return table


_CHARS = {**_wide(), **_LOOKALIKES, **dict.fromkeys(_INVISIBLE, "")}
_WORD = "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True))
_FIRST = sorted({w[0] for w in _DIGIT_WORDS})
_NUMBER = rf"(?:{_WORD})(?![A-Za-zÀ-ÿ])"
#: The rest of a digit word whose first letter was read.
_NUMBER_REST = "|".join(
    f"(?<={c})(?:{'|'.join(w[1:] for w in sorted(_DIGIT_WORDS, key=len, reverse=True) if w[0] == c)})" for c in _FIRST
)
_LABEL = "[a-z0-9-]{1,63}"
_DOT = r"(?:[\x20](?:dot|punkt|punto)[\x20])"
_ANY_DOT = r"(?:\.|[\x20](?:dot|punkt|punto|point)[\x20])"


def _bracketed(words: str) -> str:
    pairs = (r"\[", r"\]"), (r"\(", r"\)"), (r"\{", r"\}"), ("<", ">")
    return rf"(?:{'|'.join(rf'{a}[\x20]?(?:{words})[\x20]?{b}' for a, b in pairs)})[\x20]?"


_AT_SIGN, _DOT_SIGN = _bracketed("at|@|ät|arroba|arobase"), _bracketed(r"dot|\.|punkt|punto|point")
#: One rewritable place; the digit word takes the blanks up to a next digit or digit word with it. Every alternative starts with a
#: set of characters, so that most places of a text fail at once, and ends with an empty group that names it.
_PLACES = re.compile(
    rf"[{''.join(map(re.escape, _CHARS))}](?P<char>)"
    rf"|(?=[\[({{<])(?:{_AT_SIGN}(?P<at>)|{_DOT_SIGN}(?P<dot>))"
    r"|[&%](?:(?:(?<=&)(?:#64;|#x40;|commat;)|(?<=%)40)(?P<codeat>)"
    r"|(?:(?<=&)(?:#46;|#x2e;|period;)|(?<=%)2e)(?P<codedot>)"
    r"|(?:(?<=&)(?:#43;|#x2b;|plus;)|(?<=%)2b)(?P<codeplus>))"
    rf"|[\x20](?:{_AT_SIGN}(?P<blankat>)|{_DOT_SIGN}(?P<blankdot>)"
    rf"|(?<=[a-z0-9._%+-].)(?:at|ät)[\x20](?={_LABEL}(?:{_DOT}{_LABEL}){{0,4}}?{_DOT}"
    rf"(?:(?:{_ENDINGS})(?![a-z0-9-])|{_LABEL}{_DOT}[a-z]{{2,24}}(?![a-z0-9-])))(?P<bareat>)"
    rf"|(?<=[a-z0-9._%+-].)(?:arroba|arobase|klammeraffe)[\x20](?={_LABEL}{_ANY_DOT}[a-z0-9])(?P<wordat>)"
    r"|(?<=[a-z0-9].)dot[\x20](?=[a-z0-9])(?P<baredot>)"
    rf"|(?<=[a-z0-9].)(?<!\.com.|\.org.|\.net.)(?<!\.de.|\.fr.|\.es.)(?:punkt|punto|point)[\x20]"
    rf"(?={_NUMBER}|[0-9]|(?:{_LABEL}{_ANY_DOT}){{0,4}}?(?:{_ENDINGS})(?![a-z0-9-]))(?P<worddot>))"
    rf"|[pm](?<![a-z].)(?:(?<=p)lus|(?<=m)[aáÁ]s)[\x20](?={_NUMBER}|[0-9])(?P<plus>)"
    r"|[oil](?<=[0-9].)(?=[0-9])(?P<slip>)"
    rf"|[{''.join(_FIRST)}](?<![a-z].)(?:{_NUMBER_REST})(?![A-Za-zÀ-ÿ])(?:[\x20-](?={_NUMBER}|[0-9]))?(?P<number>)"
)
#: What follows an ``@`` when every letter is set apart by a blank.
_SPACED_HOST = re.compile(r"(?:[\x20][a-z0-9-](?![a-z0-9-]))++(?:[\x20]\.(?:[\x20][a-z0-9-](?![a-z0-9-]))++)+")
_SPACED_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _spaced(lowered: str) -> list[int]:
    """Blanks inside addresses written with a blank between all characters."""
    blanks: list[int] = []
    last, at = 0, lowered.find(" @ ")
    while at >= 0:
        start = at + 1
        if host := _SPACED_HOST.match(lowered, at + 2):
            while start - 2 >= last and lowered[start - 1] == " " and lowered[start - 2] in _SPACED_LOCAL and (start == 2 or not lowered[start - 3].isalnum()):
                start -= 2
            if start <= at:
                blanks += [i for i in range(start, host.end()) if lowered[i] == " "]
                last = host.end()
        at = lowered.find(" @ ", max(last, at + 2))
    return blanks


def _ascii_lower(text: str) -> str:
    return text.lower() if text.isascii() else text.encode().lower().decode()


#: What a named place stands for, by the end of its name.
_SIGNS = {before + name: sign for before in ("", "code", "blank", "bare", "word") for name, sign in (("at", "@"), ("dot", "."), ("plus", "+"))}


def _word_before(lowered: str, end: int) -> str:
    start = end
    while start and end - start < 16 and lowered[start - 1].isalpha():
        start -= 1
    return lowered[start:end]


#: Letters between digits that stand for a digit.
_SLIPS = {"o": "0", "i": "1", "l": "1"}


class Normal:
    """The normal form of a text and the way back."""

    def __init__(self, text: str):
        lowered = _ascii_lower(text)
        parts: list[str] = []
        self.at: list[int] = [0]  # where segments start in the normal form
        self.source: list[tuple[int, int, bool]] = []  # their start and end in the text, rewritten or not
        self.edits: list[int] = []  # rewritten places of the text
        places: list[tuple[int, int, str]] = []
        for m in _PLACES.finditer(lowered):
            kind, start = m.lastgroup, m.start()
            if kind == "number":
                if start and lowered[start - 1].isalpha():
                    continue
                new = _DIGIT_WORDS[m[0].rstrip(" -")]
            elif kind == "char":
                new = _CHARS[text[start]]
            elif kind == "bareat" and _word_before(lowered, start) in _PROSE:
                continue
            else:
                new = _SIGNS.get(kind) or _SLIPS[m[0]]
            places.append((start, m.end(), new))
        if blanks := _spaced(lowered):
            places = sorted(places + [(i, i + 1, "") for i in blanks])
        done = 0
        for start, end, new in places:
            if start < done:
                continue
            self._add(parts, text[done:start], done, start, False)
            self._add(parts, new, start, end, True)
            self.edits.append(start)
            done = end
        self._add(parts, text[done:], done, len(text), False)
        self.text = "".join(parts)

    def _add(self, parts: list[str], piece: str, start: int, end: int, rewritten: bool) -> None:
        if piece:
            parts.append(piece)
            self.source.append((start, end, rewritten))
            self.at.append(self.at[-1] + len(piece))

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """Original start and end of a span of the normal form, and whether it holds a rewritten place."""
        first = bisect.bisect_right(self.at, start) - 1
        last = bisect.bisect_right(self.at, end - 1) - 1
        a, _, fresh = self.source[first]
        from_ = a if fresh else a + start - self.at[first]
        a, b, fresh = self.source[last]
        to = b if fresh else a + end - self.at[last]
        return from_, to, self.places(from_, to) > 0

    def places(self, start: int, end: int) -> int:
        """Rewritten places between two characters of the text."""
        return bisect.bisect_left(self.edits, end) - bisect.bisect_left(self.edits, start)


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Spans that only the normal form shows."""
    normal = Normal(text)
    if not normal.edits:
        return []
    held: list[list[tuple[int, int]]] = [[(a, b) for a, k, b in base if k == kind] for kind in range(len(KINDS))]
    found = []
    for start, kind, end in detect(normal.text):
        a, b, changed = normal.back(start, end)
        while b > a and text[b - 1] in " -":  # blanks that a digit word took along
            b -= 1
        while a < b and text[a] == " ":
            a += 1
        spans = held[kind]
        near = bisect.bisect_right(spans, (a, len(text) + 1)) - 1
        if not changed or near >= 0 and spans[near][1] >= b:
            continue
        if kind >= 2 and near >= 0 and spans[near][0] == a and normal.places(spans[near][1], b) < 2:
            continue  # a number and the one word after it
        found.append((a, kind, b))
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def spans_of(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans and added spans of one text."""
    if not text:
        return [], []
    base = detect(text)
    return base, disguised(text, base)


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by ``<kind>``; overlapping spans become one, named by the first."""
    out, done = [], 0
    merged: list[list[int]] = []
    for a, k, b in sorted(spans):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([a, k, b])
    for a, k, b in merged:
        out += [text[done:a], f"<{KINDS[k]}>"]
        done = b
    return "".join([*out, text[done:]])


_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("added", pa.bool_())]))


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: an array of kind, start, end and whether the disguise pass added it."""

    @F.arrow_udf("array<struct<kind:string,start:int,end:int,added:boolean>>")
    def scan(texts: pa.Array) -> pa.Array:
        rows = []
        for value in texts.to_pylist():
            base, added = spans_of(value)
            both = [(s, False) for s in base] + [(s, True) for s in added]
            rows.append([{"kind": KINDS[k], "start": a, "end": b, "added": new} for (a, k, b), new in sorted(both)])
        return pa.array(rows, _SPAN_TYPE)

    return docs.withColumn("spans", scan(F.col(text)))


def redact_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with all spans of ``text`` replaced by the name of their kind; null stays null."""

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        rows = []
        for value in texts.to_pylist():
            base, added = spans_of(value)
            rows.append(redact(value, base + added) if base or added else value)
        return pa.array(rows, pa.string())

    return docs.withColumn(text, clean(F.col(text)))


