"""Vectorised helpers on the bytes of many texts, used inside Arrow functions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

STEP = 1 << 16
_rng = np.random.default_rng(20240229)
BYTE = _rng.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ODD = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a column without nulls one after the other, and where each text starts and ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no rows
        column = pa.array([], column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets[:-1] - offsets[0], offsets[1:] - offsets[0]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= ODD[0]
    h ^= h >> np.uint64(29)
    return h


def _grams(codes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k codes in a row; pieces of doubled length are joined with their own factor."""
    h, size, level = codes, 1, 1
    while 2 * size <= k:
        h = h[:-size] * ODD[level] + h[size:]
        size, level = 2 * size, level + 1
    if size < k:
        h = h[: len(h) - (k - size)] * ODD[level + 20] + h[k - size :]
    return h


def _sliding_minimum(h: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while 2 * size <= w:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (w - size)], h[w - size :]) if size < w else h


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k consecutive codes."""
    return window_minimum(codes, k, k)


def window_minimum(data: np.ndarray, k: int, window: int, table: int = 0) -> np.ndarray:
    """For each window of consecutive codes, the least hash of the k-grams in it.

    data holds bytes or 64-bit codes. Works in steps that stay in the processor's cache.
    """
    n = len(data) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for lo in range(0, n, STEP):
        part = data[lo : min(lo + STEP, n) + window - 1]
        codes = BYTE[table][part] if part.dtype == np.uint8 else part
        out[lo : lo + STEP] = _sliding_minimum(mixed(_grams(codes, k)), window - k + 1)
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def word_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word, a maximal run without ASCII white space."""
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    texts = starts[starts < ends]
    begins[texts] = inside[texts]
    first = np.flatnonzero(begins)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    lasts = ends[starts < ends] - 1
    closes[lasts] = inside[lasts]
    last = np.flatnonzero(closes) + 1
    return first, last, np.searchsorted(ends, first, "right")


def word_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray, table: int = 0) -> np.ndarray:
    """A 64-bit hash of every word: byte codes, each multiplied by a power of its place in the word."""
    out = np.zeros(len(first), np.uint64)
    lo = 0
    while lo < len(first):
        hi = max(lo + 1, int(np.searchsorted(first, first[lo] + 4 * STEP)))
        a, b = first[lo:hi], last[lo:hi]
        part = data[a[0] : b[-1]]
        base = a - a[0]
        # the place of each byte in its word, counted from the word before it; blanks count as 0
        place = np.arange(len(part)) - np.repeat(base, np.diff(np.append(base, len(part))))
        codes = BYTE[table][part] * _powers(int(place.max()) + 1, table)[place]
        codes[_SPACE[part]] = 0
        out[lo:hi] = np.add.reduceat(codes, base)
        lo = hi
    return mixed(out + (last - first).astype(np.uint64) * ODD[40 + table])


_power_tables: dict[int, np.ndarray] = {}


def _powers(n: int, table: int) -> np.ndarray:
    held = _power_tables.get(table)
    if held is None or len(held) < n:
        steps = np.full(max(n, 4096), ODD[50 + table])
        steps[0] = 1
        held = _power_tables[table] = np.cumprod(steps, dtype=np.uint64)
    return held


def groups(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1]))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one after the other."""
    shift = starts - np.cumsum(sizes) + sizes
    return np.repeat(shift, sizes) + np.arange(int(sizes.sum()))
