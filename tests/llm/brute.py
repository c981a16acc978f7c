"""Plain Python versions of the rules, to test against."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

UPPER = {c: c + 32 for c in range(65, 91)}


def fold(text: str) -> str:
    return text.translate(UPPER)


def words_of(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", fold(text or ""))


def shingle_set(text: str | None) -> set[tuple[str, ...]]:
    w = words_of(text)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def components(ids: list, links: list[tuple]) -> dict:
    parent = {i: i for i in ids}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {i: top(i) for i in ids}


def near_duplicates(rows: list[tuple]) -> dict:
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    links = [
        (a, b)
        for n, (a, x) in enumerate(sets)
        for b, y in sets[n + 1 :]
        if x and y and 100 * len(x & y) >= 75 * len(x | y)
    ]
    return components([i for i, _ in sets], links)


def kept_lines(rows: list[tuple], blanks: str = " \t\n\x0b\x0c\r") -> list[tuple[int, int, str]]:
    """Lines, dropped lines and kept text of each row."""
    owners = defaultdict(set)
    lines = [(i, [(line, fold(line.strip(blanks))) for line in (t or "").split("\n")]) for i, t in rows]
    for i, found in lines:
        if i is not None:
            for _, key in found:
                if len(key) >= 10:
                    owners[key].add(i)
    out = []
    for i, found in lines:
        keep = [line for line, key in found if i is None or len(owners[key]) < 2 or min(owners[key]) == i]
        out.append((len(found), len(found) - len(keep), "\n".join(keep)))
    return out


class Ppm:
    """Escape method C with exclusion, by explicit tries."""

    def __init__(self, texts: list[str | None], depth: int = 3) -> None:
        self.depth, self.seen = depth, defaultdict(Counter)
        for text in texts:
            s = self.symbols(text)
            for i in range(depth, len(s)):
                for k in range(depth + 1):
                    self.seen[tuple(s[i - k : i])][s[i]] += 1

    def symbols(self, text: str | None) -> list[int]:
        return [256] * self.depth + list((text or "").encode()) + [256]

    def bits(self, text: str | None, exclusion: bool = True) -> float:
        s, total = self.symbols(text), 0.0
        for i in range(self.depth, len(s)):
            out: set[int] = set()
            for k in range(self.depth, -1, -1):
                found = self.seen.get(tuple(s[i - k : i]), {})
                left = {a: n for a, n in found.items() if a not in out}
                if not left:
                    continue
                n, d = sum(left.values()), len(left)
                if s[i] in left:
                    total -= math.log2(left[s[i]] / (n + d))
                    break
                total -= math.log2(d / (n + d))
                if exclusion:
                    out |= set(left)
            else:
                total += math.log2(257 - len(self.seen.get((), {})))
        return total
