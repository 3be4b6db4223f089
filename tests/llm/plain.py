"""Brute-force versions of the operators' results."""

from __future__ import annotations

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def without_repeats(texts: list[str | None], k: int) -> list[tuple[int, int, str]]:
    split = [words(t) for t in texts]
    count = collections.Counter(tuple(w[i : i + k]) for w in split for i in range(len(w) - k + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - k + 1):
            if count[tuple(w[i : i + k])] > 1:
                gone |= set(range(i, i + k))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingles(text: str | None, k: int = 5) -> frozenset:
    w = words(ascii_lower(text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def groups(n: int, links) -> list[int]:
    """Least index reachable, for each index."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near_links(sets: list[frozenset], percent: int = 75):
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                yield i, j


def quality(text: str | None) -> tuple[int, ...]:
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    count = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {i + j for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
