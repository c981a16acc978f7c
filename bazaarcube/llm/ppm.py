"""Prediction by partial matching over bytes, compiled to a table of code lengths.

Training counts every byte with its three predecessors (a text is preceded and ended
by a mark, so the empty text has a probability too). These counts are a byte-context
trie of depth three: the counts of shorter contexts are sums of them. A symbol not
seen in a context costs an escape, with the number of distinct successors as the
escape count (method C), and is then coded in the context shortened by one byte,
where symbols already ruled out are excluded; the last resort is a uniform code over
the symbols not seen at all. Since the statistics are frozen, all this depends on the
context and the symbol only, so it is computed once per context: a text is scored
with two lookups per byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from bazaarcube.llm.textops import WINDOW, buffers

#: The mark before and after a text; bytes are 0 to 255.
END = 256
N_SYMBOLS = 257
_BITS = np.uint64(9)
_MASK = np.uint64(511)
#: Depth of the compiled tables. Counts may be deeper (``order``), to be joined to.
ORDER = 3


def symbols(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each preceded by ``order`` marks and ended by one; and where
    each text's marks begin."""
    n = np.diff(offsets)
    starts = np.concatenate([[0], np.cumsum(n + order + 1)])
    out = np.full(starts[-1], END, np.uint16)
    if len(data):
        shift = np.repeat(starts[:-1] + order - offsets[:-1], n)
        out[np.arange(len(data)) + shift] = data
    return out, starts


def pieces(data: np.ndarray, offsets: np.ndarray, size: int = WINDOW, *, order: int = ORDER) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]]:
    """Some texts at a time: symbols, the positions that are coded, the first text's
    number, and each coded position's text counted from it. A longer text is cut, each piece with the ``order`` bytes before it."""
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        hi = min(hi, lo + size, len(offsets) - 1)
        if offsets[hi] - offsets[lo] <= size:
            part, starts = symbols(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], order)
            keep = np.ones(len(part), bool)
            for i in range(order):
                keep[starts[:-1] + i] = False
            at = np.flatnonzero(keep)
            yield part, at, lo, np.repeat(np.arange(hi - lo), np.diff(starts) - order)
        else:
            a, b = offsets[lo], offsets[hi]
            for s in range(a, b, size):
                e = min(s + size, b)
                before = data[max(a, s - order) : s].astype(np.uint16)
                head = np.full(order, END, np.uint16)
                if len(before):
                    head[order - len(before) :] = before
                tail = [np.array([END], np.uint16)] if e == b else []
                part = np.concatenate([head, data[s:e].astype(np.uint16), *tail])
                yield part, np.arange(order, len(part)), lo, np.zeros(len(part) - order, np.int64)
        lo = hi


def grams(part: np.ndarray, at: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Codes of each coded position's symbol and the ``order`` before it."""
    wide = part.astype(np.uint64)
    code = wide[at - order]
    for i in range(order - 1, -1, -1):
        code = code << _BITS | wide[at - i]
    return code


class Counter:
    """Adds up codes in bounded steps."""

    def __init__(self) -> None:
        self.codes, self.counts, self.wait, self.waiting = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, codes: np.ndarray) -> None:
        if len(codes):
            self.wait.append(np.unique(codes, return_counts=True))
            self.waiting += len(self.wait[-1][0])
            if self.waiting > max(1 << 20, len(self.codes)):
                self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if self.wait:
            codes = np.concatenate([self.codes, *(c for c, _ in self.wait)])
            counts = np.concatenate([self.counts, *(n for _, n in self.wait)])
            self.codes, inverse = np.unique(codes, return_inverse=True)
            self.counts = np.bincount(inverse, counts, len(self.codes)).astype(np.int64)
            self.wait, self.waiting = [], 0
        return self.codes, self.counts


def count_grams(text: pa.Array, into: Counter, order: int = ORDER) -> None:
    data, offsets = buffers(text)
    for part, at, _, _ in pieces(data, offsets, order=order):
        into.add(grams(part, at, order))


def marked(a: int, column: np.ndarray, contexts: np.ndarray) -> np.ndarray | None:
    """For each context of three columns, whether its symbols are one of ``contexts``."""
    if not len(contexts):
        return None
    x, y, z = (column[contexts.astype(np.int64) >> s & 511].astype(np.int64) for s in (18, 9, 0))
    out = np.zeros(a * a * a, bool)
    out[(x * a + y) * a + z] = True
    return out


class Requests:
    """Positions whose cost is to be corrected by a join: runs of equal codes of a text."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, doc: np.ndarray, code: np.ndarray, cost: np.ndarray) -> None:
        """Equal codes have equal costs."""
        order = np.lexsort((code, doc))
        self.parts.append((doc[order], code[order], cost[order]))

    def runs(self, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where each text's runs begin, and the runs' codes, lengths and costs."""
        if not self.parts:
            return np.zeros(n_docs + 1, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0,))
        doc, code, cost = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((code, doc))
        doc, code, cost = doc[order], code[order], cost[order]
        new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])]))[: len(doc)]
        times = np.diff(np.append(new, len(doc)))
        offsets = np.searchsorted(doc[new], np.arange(n_docs + 1)).astype(np.int32)
        return offsets, code[new].astype(np.int64), times, cost[new]


class Model:
    """Code lengths in bits, compiled from counts of four-symbol codes.

    ``shorter`` has the counts of three-symbol codes where the trie's deepest level was
    reduced to its most frequent contexts; without it they are summed here. ``rare``:
    the contexts left out, whose positions ``coded`` reports.
    """

    def __init__(
        self, codes: np.ndarray, counts: np.ndarray, shorter: tuple[np.ndarray, np.ndarray] | None = None,
        exclusion: bool = True, rare: np.ndarray | tuple = (),
    ) -> None:
        """``codes`` and ``counts``: how often each code of four symbols occurs."""
        levels = {3: (codes.astype(np.uint64), counts.astype(np.float64))}
        level = levels[3] if shorter is None else (shorter[0].astype(np.uint64), shorter[1].astype(np.float64))
        if shorter is not None:
            levels[2] = level
        for order in (2, 1, 0):
            if order not in levels:
                keys, inverse = np.unique(level[0] & np.uint64((1 << 9 * (order + 1)) - 1), return_inverse=True)
                levels[order] = (keys, np.bincount(inverse, level[1], len(keys)))
            level = levels[order]
        # symbols that never occur share one column: each costs the escapes and a uniform code
        seen = (levels[0][0] & _MASK).astype(np.int64)
        self.a = a = len(seen) + 1
        self.column = np.full(N_SYMBOLS, a - 1, np.int32)
        self.column[seen] = np.arange(a - 1)
        self.index = np.zeros(a * a * a, np.int32)
        tables: list[np.ndarray] = []
        base = 0
        for order in range(ORDER + 1):
            keys, n = levels[order]
            context, symbol = (keys >> _BITS).astype(np.int64), self.column[(keys & _MASK).astype(np.int64)]
            rows, row = np.unique(context, return_inverse=True)
            if order == 0 and not len(rows):
                rows = np.zeros(1, np.int64)
            up = np.searchsorted(last_rows, rows & ((1 << 9 * (order - 1)) - 1)) if order else None
            found = np.zeros((len(rows), a), np.float32 if order == ORDER else np.float64)
            found[row, symbol] = n
            cost = np.empty((len(rows), a), np.float32)
            for lo in range(0, len(rows), 4096):  # the whole level, some rows at a time
                f = found[lo : lo + 4096].astype(np.float64)
                has = f > 0
                t, d = f.sum(1, keepdims=True), has.sum(1, keepdims=True).astype(float)
                if order == 0:
                    rest = np.log2(np.maximum(N_SYMBOLS - d, 1))
                elif exclusion:
                    rest = _after_escape(up[lo : lo + 4096], has, shorter_found, tables[-1])
                else:
                    rest = tables[-1][up[lo : lo + 4096]]
                with np.errstate(divide="ignore", invalid="ignore"):
                    escape = np.where(d > 0, -np.log2(d / (t + d)), 0.0)
                    cost[lo : lo + 4096] = np.where(has, -np.log2(f / (t + d)), escape + rest)
            tables.append(cost)
            self._point(order, rows, base)
            last_rows, base, shorter_found = rows, base + len(rows), found
        self.cost = np.concatenate(tables).ravel()
        self.rare = marked(a, self.column, np.asarray(rare, np.int64))

    def _point(self, order: int, rows: np.ndarray, base: int) -> None:
        """Each context of three symbols points to its longest known suffix."""
        a, index = self.a, self.index.reshape(self.a, self.a, self.a)
        number = np.arange(len(rows), dtype=np.int32) + base
        x, y, z = (self.column[rows >> s & 511] for s in (18, 9, 0))
        if order == 1:
            index[:, :, z] = number
        elif order == 2:
            index[:, y, z] = number
        elif order == 3:
            index[x, y, z] = number

    def lengths(self, text: pa.Array) -> np.ndarray:
        """Bits needed for each text, its end included."""
        return self.coded(text)[0]

    def coded(self, text: pa.Array, order: int = ORDER) -> tuple[np.ndarray, Requests]:
        """Bits needed for each text, and the positions that longer contexts correct:
        those in a rare context, or all if the counts go deeper than these tables."""
        data, offsets = buffers(text)
        bits, requests = np.zeros(len(offsets) - 1), Requests()
        for part, at, lo, doc in pieces(data, offsets, order=order):
            wide = self.column[part]
            context = (wide[at - 3] * self.a + wide[at - 2]) * self.a + wide[at - 1]
            cost = self.cost[self.index[context].astype(np.int64) * self.a + wide[at]]
            sums = np.bincount(doc, cost)
            bits[lo : lo + len(sums)] += sums
            if order > ORDER:
                requests.add(doc + lo, grams(part, at, order), cost)
            elif self.rare is not None:
                hit = np.flatnonzero(self.rare[context])
                requests.add(doc[hit] + lo, grams(part, at[hit]), cost[hit])
        return bits, requests


def _after_escape(up: np.ndarray, has: np.ndarray, counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Code lengths in the contexts ``up`` (one symbol shorter) when the symbols of
    ``has`` are excluded: what the longer context already ruled out takes no share."""
    n = np.where(has, 0.0, counts[up])
    t, d = n.sum(1, keepdims=True), (n > 0).sum(1, keepdims=True).astype(float)
    full = counts[up]
    ft, fd = full.sum(1, keepdims=True), (full > 0).sum(1, keepdims=True).astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        own = -np.log2(n / (t + d))
        # beyond this context everything it has seen is excluded in any case, so the
        # rest is what its own table holds after its own escape
        rest = table[up] - np.where(fd > 0, -np.log2(fd / (ft + fd)), 0.0)
        escape = np.where(d > 0, -np.log2(d / (t + d)), 0.0)
    return np.where(n > 0, own, escape + rest)


class Models:
    """Several models over one index, so that a byte is looked up once for all."""

    def __init__(self, models: list[Model], rare: np.ndarray | tuple = ()) -> None:
        """``rare``: contexts left out of some model, whose positions ``coded`` reports."""
        used = np.unique(np.concatenate([np.flatnonzero(m.column != m.a - 1) for m in models]))
        a = len(used) + 1
        self.a, self.column = a, np.full(N_SYMBOLS, a - 1, np.int32)
        self.column[used] = np.arange(a - 1)
        own = [np.append(m.column[used], m.a - 1) for m in models]
        # contexts that some model tells apart: a row for each combination of rows
        index, step = np.zeros((a, a, a), np.int64), 1
        for m, o in zip(models, own, strict=True):
            rows = m.index.reshape(m.a, m.a, m.a)[np.ix_(o, o, o)]
            index, step = index * (len(m.cost) // m.a) + rows, step * (len(m.cost) // m.a)
            kinds, index = np.unique(index, return_inverse=True)
            index = index.reshape(a, a, a)
        self.index = index.astype(np.int32).ravel()
        first = np.unique(self.index, return_index=True)[1]
        x, y, z = np.unravel_index(first, (a, a, a))
        self.cost = np.empty((len(first), a, len(models)), np.float32)
        for i, (m, o) in enumerate(zip(models, own, strict=True)):
            rows = m.index.reshape(m.a, m.a, m.a)[o[x], o[y], o[z]]
            self.cost[:, :, i] = m.cost.reshape(-1, m.a)[rows][:, o]
        self.cost = self.cost.reshape(-1, len(models))
        self.rare = marked(a, self.column, np.asarray(rare, np.int64))

    def lengths(self, text: pa.Array) -> np.ndarray:
        """Bits for each text (row) by each model (column)."""
        return self.coded(text)[0]

    def coded(self, text: pa.Array) -> tuple[np.ndarray, Requests]:
        """Bits for each text by each model, and the positions in rare contexts."""
        data, offsets = buffers(text)
        bits, requests = np.zeros((len(offsets) - 1, self.cost.shape[1])), Requests()
        for part, at, lo, doc in pieces(data, offsets, WINDOW // 2):
            wide = self.column[part]
            context = (wide[at - 3] * self.a + wide[at - 2]) * self.a + wide[at - 1]
            cost = self.cost[self.index[context].astype(np.int64) * self.a + wide[at]]
            edge = np.flatnonzero(np.diff(doc, prepend=-1))
            bits[lo + doc[edge]] += np.add.reduceat(cost.astype(np.float64), edge, axis=0)
            if self.rare is not None:
                hit = np.flatnonzero(self.rare[context])
                requests.add(doc[hit] + lo, grams(part, at[hit]), cost[hit])
        return bits, requests
