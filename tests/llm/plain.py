"""Plain-Python versions of the operators, for comparison."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_pii(text: str) -> list[tuple[int, int, int]]:
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[\x20-]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def quality_counts(text: str) -> dict[str, int]:
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + o for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for o in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_capitals": len(re.findall(r"[A-Z]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_lines": len(lines),
        "n_repeat_words": len(covered),
    }


def good(text: str) -> bool:
    c = quality_counts(text)
    return not (
        c["n_words"] < 10
        or 100 * c["n_repeat_words"] > 20 * c["n_words"]
        or 100 * c["n_symbols"] > 5 * c["word_chars"]
        or 100 * c["n_capitals"] > 50 * c["word_chars"]
        or 100 * c["n_dup_lines"] > 30 * c["n_lines"]
        or not 2 * c["n_words"] <= c["word_chars"] <= 20 * c["n_words"]
    )


def shingles(text: str | None) -> set:
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(docs: list[tuple[int, str | None]]) -> dict[int, int]:
    sets = [(i, shingles(t)) for i, t in docs]
    up = {i: i for i, _ in docs}

    def root(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for k, (a, sa) in enumerate(sets):
        for b, sb in sets[k + 1 :]:
            if sa and sb and 100 * min(len(sa), len(sb)) >= 75 * max(len(sa), len(sb)):
                both = len(sa & sb)
                if 100 * both >= 75 * (len(sa) + len(sb) - both):
                    x, y = sorted((root(a), root(b)))
                    up[y] = x
    return {i: root(i) for i, _ in docs}
