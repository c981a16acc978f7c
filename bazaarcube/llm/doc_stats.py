"""Statistics of whole documents, vectorised over Arrow text columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from bazaarcube.llm.textops import BLANK, WINDOW, buffers, words

#: Only a line break separates.
_LINE = np.zeros(256, bool)
_LINE[10] = True

_GROUPS = {
    "lower": list(range(97, 123)),
    "upper": list(range(65, 91)),
    "digit": list(range(48, 58)),
    "blank": list(np.flatnonzero(BLANK)),
    "other_script": list(range(128, 256)),
}
_SIGNS = {
    "stops": b".", "commas": b",", "loud": b"!?", "quotes": b"\"'`", "brackets": b"()[]{}<>", "bars": b"|\\/_~", "marks": b"#$%&*@^+=", "dashes": b"-:;",
}
NAMES = [
    "log_bytes", "log_words", *(f"share_{g}" for g in _GROUPS), *(f"{s}_per_word" for s in _SIGNS), "bytes_per_word",
    "distinct_words", "commonest_word", "log_lines", "log_bytes_per_line", "repeated_lines", "byte_entropy",
]


def byte_counts(text: pa.Array) -> np.ndarray:
    """How often each byte occurs in each text."""
    data, offsets = buffers(text)
    counts = np.zeros((len(offsets) - 1, 256), np.int64)
    for at in range(0, len(data), WINDOW):
        to = min(at + WINDOW, len(data))
        lo, hi = np.searchsorted(offsets, at, "right") - 1, np.searchsorted(offsets, to, "left")
        doc = np.repeat(np.arange(hi - lo), np.diff(np.clip(offsets[lo : hi + 1], at, to)))
        counts[lo:hi] += np.bincount(doc * 256 + data[at:to], minlength=(hi - lo) * 256).reshape(-1, 256)
    return counts


def repetition(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text, its number of distinct hashes and the count of the commonest."""
    n = len(first) - 1
    distinct, most = np.zeros(n, np.int64), np.zeros(n, np.int64)
    lo = 0
    while lo < n:  # some texts at a time: a third of a million hashes, or one text
        hi = min(n, max(lo + 1, int(np.searchsorted(first, first[lo] + WINDOW // 4, "right")) - 1), lo + 60_000)
        part = hashes[first[lo] : first[hi]]
        doc = np.repeat(np.arange(hi - lo, dtype=np.uint64), np.diff(first[lo : hi + 1]))
        key = np.sort(doc << np.uint64(48) | part >> np.uint64(16))
        if len(key):
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            owner = (key[begin] >> np.uint64(48)).astype(np.int64)
            distinct[lo:hi] = np.bincount(owner, minlength=hi - lo)
            np.maximum.at(most[lo:hi], owner, np.diff(np.append(begin, len(key))))
        lo = hi
    return distinct, most


def statistics(text: pa.Array) -> np.ndarray:
    """A row of ``NAMES`` for each text; all 0 for a null or empty one."""
    counts = byte_counts(text)
    total = counts.sum(1)
    size = np.maximum(total, 1)
    h, first = words(text, BLANK)
    n_words = np.diff(first)
    per_word = np.maximum(n_words, 1)
    distinct, most = repetition(h, first)
    lines, first_line = words(text, _LINE)
    n_lines = np.diff(first_line)
    distinct_lines, _ = repetition(lines, first_line)
    share = counts / size[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = -np.where(counts > 0, share * np.log2(share), 0).sum(1)
    solid = total - counts[:, _GROUPS["blank"]].sum(1)
    return np.column_stack([
        np.log1p(total), np.log1p(n_words),
        *(share[:, g].sum(1) for g in _GROUPS.values()),
        *(counts[:, list(s)].sum(1) / per_word for s in _SIGNS.values()),
        solid / per_word, distinct / per_word, most / per_word,
        np.log1p(n_lines), np.log1p(total / np.maximum(n_lines, 1)), (n_lines - distinct_lines) / np.maximum(n_lines, 1), entropy,
    ])
