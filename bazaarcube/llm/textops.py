"""Vectorised work on Arrow text columns, shared by the operators of this package.

All functions read the UTF-8 bytes of a batch where they lie, in windows of a few
megabytes that may end inside a document (between two words), so temporary memory
does not grow with the length of a text. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes worked on at a time.
WINDOW = 1 << 21

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_ORDER = _rng.integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

#: A-Z become a-z; other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: The blanks of the word rule: space and \\t \\n \\x0b \\x0c \\r.
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
#: For word features: everything but letters, digits and bytes of other scripts separates.
MARK = np.ones(256, bool)
MARK[48:58] = MARK[65:91] = MARK[97:123] = False
MARK[128:] = False

_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, WINDOW + 4096)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers = (np.cumprod(up), np.cumprod(down))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def buffers(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last ends."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = text.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = offsets[0] if len(offsets) else 0
    return data[first : offsets[-1]], offsets - first


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 4 * WINDOW) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in smaller batches of about ``size`` bytes of text."""
    for batch in batches:
        _, offsets = buffers(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def windows(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes that cut no word."""
    at, end = 0, len(data)
    while at < end:
        to = min(at + size, end)
        if to < end:
            back = np.flatnonzero(sep[data[at:to]])
            border = offsets[np.searchsorted(offsets, to, "right") - 1]
            cut = max(at + back[-1] + 1 if len(back) else at, border)
            if cut <= at:  # one word fills the window: it ends at the next separator or document
                after = offsets[np.searchsorted(offsets, at, "right")]
                cut, step = to, size
                while cut < after:
                    found = np.flatnonzero(sep[data[cut : min(cut + step, after)]])
                    if len(found):
                        cut += found[0]
                        break
                    cut = min(cut + step, after)
            to = int(cut)
        yield at, to
        at = to


def words(text: pa.Array, sep: np.ndarray = BLANK, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all texts in order, and for each
    text the position of its first word (with the total at the end)."""
    data, offsets = buffers(text)
    hashes, starts_all = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at, to in windows(data, offsets, sep, size):
        part = data[at:to]
        gap = sep[part]
        begin = ~gap
        begin[1:] &= gap[:-1]
        inner = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, to)] - at
        begin[inner] = ~gap[inner]
        starts = np.flatnonzero(begin)
        if not len(starts):
            continue
        up, down = _power_tables(len(part))
        value = _BYTE[LOWER[part]] * up[: len(part)]
        value[gap] = 0
        hashes.append(mix(np.add.reduceat(value, starts) * down[starts]))
        starts_all.append(starts + at)
    starts = np.concatenate(starts_all)
    return np.concatenate(hashes), np.searchsorted(starts, offsets)


def doc_of(first: np.ndarray) -> np.ndarray:
    """For each word, the number of its text in the batch."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def shingles(text: pa.Array, width: int = 5, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 48-bit hashes of the word shingles of all texts, sorted within each
    text, and where each text's begin. Texts of fewer words give one shingle."""
    h, first = words(text, BLANK, size)
    n = np.diff(first)
    out, counts = [], []
    lo = 0
    while lo < len(n):  # some texts at a time: a third of a million words, or one text
        hi = max(lo + 1, int(np.searchsorted(first, first[lo] + WINDOW // 4, "right")) - 1)
        hi = min(hi, lo + 60_000, len(n))
        w, f, m = h[first[lo] : first[hi]], first[lo:hi] - first[lo], n[lo:hi]
        full = np.flatnonzero(m >= width)
        per = m[full] - width + 1
        doc = np.repeat(full, per)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per) + f[doc]
        x = np.zeros(len(doc), np.uint64)
        for i in range(width):
            x += w[at + i] * _ORDER[i]
        short = np.flatnonzero((m > 0) & (m < width))
        y = m[short].astype(np.uint64) * _ORDER[7]
        for i in range(width - 1):
            has = m[short] > i
            y[has] += w[f[short[has]] + i] * _ORDER[i]
        doc = np.concatenate([doc, short]).astype(np.uint64)
        key = np.sort(doc << np.uint64(48) | mix(np.concatenate([x, y])) >> np.uint64(16))
        if len(key):
            key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        out.append(key & np.uint64((1 << 48) - 1))
        counts.append(np.bincount((key >> np.uint64(48)).astype(np.int64), minlength=hi - lo))
        lo = hi
    sizes = np.concatenate([np.zeros(1, np.int64), *counts])
    return np.concatenate([np.zeros(0, np.uint64), *out]), np.cumsum(sizes)
