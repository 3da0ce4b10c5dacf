"""Vectorised word and shingle hashing over Arrow string columns.

Words are maximal runs of digits, letters and any non-ASCII character after A-Z are lower-cased. In UTF-8 each byte of
a non-ASCII character is 0x80 or above, so the split can be made on bytes, for a whole batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15
_U = np.uint64
#: Lower-cased byte of a word, or 0 between words.
_FOLD = np.zeros(256, np.uint8)
_FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_powers = np.ones(1, _U)
_inverses = np.ones(1, _U)
#: Odd multipliers of the words of a shingle, by position.
_PLACE = np.cumprod(np.full(64, 0xD6E8FEB86659FD93, _U), dtype=_U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        _powers = np.concatenate([np.ones(1, _U), np.cumprod(np.full(size, _BASE, _U), dtype=_U)])
        _inverses = np.concatenate([np.ones(1, _U), np.cumprod(np.full(size, inverse, _U), dtype=_U)])
    return _powers, _inverses


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; null counts as empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, so that working memory doesn't follow the batch size."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0)).astype(np.int64))
    low = 0
    while low < len(column):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield low, high
        low = high


@dataclass
class Words:
    """The words of some rows: row number, byte range in ``folded`` and hash of each; ``first[r]:first[r + 1]`` are row r's."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hashed: np.ndarray
    first: np.ndarray
    folded: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, i: int) -> bytes:
        return self.folded[self.start[i] : self.end[i]].tobytes()


def words(column: pa.Array) -> Words:
    data, offsets = utf8(column)
    n, rows = len(data), len(column)
    folded = _FOLD[data]
    inside = folded != 0
    begins = np.empty(n + 1, bool)
    begins[:n] = inside
    begins[n] = False
    ends = np.zeros(n + 1, bool)
    ends[1:] = inside
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    inner = cut[inside[cut] & inside[cut - 1]]  # a word may not run over the end of its row
    begins[1:n] &= ~inside[: n - 1] if n else True
    ends[:n] &= ~inside
    begins[inner] = True
    ends[inner] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    power, inverse = _power_tables(n + 1)
    total = np.zeros(n + 1, _U)
    np.cumsum(folded.astype(_U) * power[:n], out=total[1:])
    hashed = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(_U))
    first = np.searchsorted(start, offsets).astype(np.int64)
    return Words(np.repeat(np.arange(rows), np.diff(first)), start, end, hashed, first, folded)


def grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of each run of ``k`` words within a row."""
    m = len(w.hashed) - k + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    at = np.flatnonzero(w.row[:m] == w.row[k - 1 :])
    total = np.zeros(m, _U)
    for j in range(k):
        total += w.hashed[j : j + m] * _PLACE[j]
    return at, mix(total[at] + _U(k))


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, one row after another, and the row offsets among them.

    A row of fewer than ``k`` words, but not none, has its whole word sequence as its only shingle.
    """
    at, value = grams(w, k)
    row, counts = w.row[at], w.count
    for short in range(1, k):
        rows = np.flatnonzero(counts == short)
        if len(rows):
            total = np.zeros(len(rows), _U)
            for j in range(short):
                total += w.hashed[w.first[rows] + j] * _PLACE[j]
            row, value = np.concatenate([row, rows]), np.concatenate([value, mix(total + _U(short))])
    if len(row) and np.any(np.diff(row) < 0):
        order = np.argsort(row, kind="stable")
        row, value = row[order], value[order]
    value = value.copy()
    bounds = np.searchsorted(row, np.arange(len(counts) + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            value[a:b].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[new], np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=len(counts)))]).astype(np.int64)
