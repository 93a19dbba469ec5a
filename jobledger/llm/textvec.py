"""Whole Arrow string columns as numpy arrays: words, word hashes, row sums.

A batch of texts is read as one byte buffer with row offsets, so that words
are found and hashed with a few array operations instead of a Python loop per
word. ``slices`` bounds the memory: rows are handed out in runs of about
``SLICE`` bytes, a longer text on its own.
"""

from __future__ import annotations

import numpy as np

SLICE = 1 << 20

# bytes that end a word: space and 0x09-0x0D
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

# A-Z to a-z, other bytes as they are
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# bytes that are no part of a bare word: ASCII other than letters and digits
BARE = np.ones(256, bool)
BARE[48:58] = BARE[65:91] = BARE[97:123] = BARE[128:] = False

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: list = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INV)):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _POWERS[k] = np.cumprod(row, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string column (null: empty)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    at = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    at = at[column.offset: column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, at


def slices(at: np.ndarray, size: int = SLICE):
    """(first, last + 1) of runs of rows of about ``size`` bytes."""
    i, n = 0, len(at) - 1
    while i < n:
        j = int(np.searchsorted(at, at[i] + size, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words(data: np.ndarray, at: np.ndarray, ends: np.ndarray = SPACE):
    """Starts and ends of words in ``data``, and the row that each is in.

    ``at``: row offsets into ``data`` (first 0). Rows never share a word.
    """
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~ends[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    cut = at[:-1][(at[:-1] < n)]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    last = at[1:][at[1:] > 0] - 1
    after[last] = False
    stops = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(at, starts, side="right") - 1
    return starts, stops, row


def prefix(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of the lower-cased bytes, for ``hashes``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * _powers(len(data) + 1)[0][: len(data)], out=sums[1:])
    return sums


def hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each word's lower-cased bytes and length."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    sums = prefix(data) if sums is None else sums
    value = (sums[stops] - sums[starts]) * _powers(len(data) + 1)[1][starts]
    return mix(value + (stops - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence, from that of its beginning and of its last word."""
    return mix(left * np.uint64(0xFF51AFD7ED558CCD) + right + np.uint64(0x2545F4914F6CDD1D))


def row_sums(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values`` by ``row`` (ascending) for n rows, in double."""
    return np.bincount(row, weights=values, minlength=n)
