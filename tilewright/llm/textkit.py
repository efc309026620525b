"""Vectorised words and window hashes over Arrow string columns, used inside tasks.

A word is a run of bytes outside ``\\x20 \\x09-\\x0D``; null texts have none. All hashes are
64 bits: a polynomial over random per-byte values, finished with a mixer. They depend on
fixed seeds only, so every task of every run gives the same value to the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in slices of about this many bytes; temporaries are some 40 times that.
SLICE_BYTES = 1 << 20

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUES = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_WINDOW_BASE = 0xD1342543DE82EF95 | 1
_powers_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective finisher: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    known = _powers_cache.get(base)
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        up, down = np.full(size, base, dtype=np.uint64), np.full(size, inverse, dtype=np.uint64)
        up[0] = down[0] = 1
        known = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size <= 4 << 20:
            _powers_cache[base] = known
    return known


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hash of ``values[start:end]`` for every span, from one prefix sum."""
    up, down = _powers(base, len(values) + 1)
    prefix = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of a slice of rows: ``first[i]:first[i + 1]`` are the words of row ``i``."""

    rows: slice
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool) -> np.ndarray:
        table = _BYTE_VALUES[_LOWER] if lower else _BYTE_VALUES
        return span_hashes(table[self.data], self.starts, self.ends)


def ragged(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[slice]:
    """Runs of rows of at most ``most`` bytes, or single longer rows."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        stop = min(stop, n)
        yield slice(row, stop)
        row = stop


def words(column: pa.Array | pa.ChunkedArray, most: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of a string column, slice by slice; every row is in exactly one slice."""
    data, offsets = ragged(column)
    for rows in row_slices(offsets, most):
        local = offsets[rows.start : rows.stop + 1] - offsets[rows.start]
        part = data[offsets[rows.start] : offsets[rows.stop]]
        black = ~_WHITE[part]
        edge = np.zeros(len(part) + 1, dtype=bool)
        edge[local] = True
        begins = black & edge[:-1]
        begins[1:] |= black[1:] & ~black[:-1]
        stops = black & edge[1:]
        stops[:-1] |= black[:-1] & ~black[1:]
        starts = np.flatnonzero(begins)
        yield Words(rows, part, local, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, local))


def window_hashes(word_hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one row, and the word each run starts at."""
    n = len(word_hashes)
    if n < size:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    inside = np.ones(n, dtype=bool)
    for back in range(1, size):
        at = first[1:] - back
        inside[at[at >= first[:-1]]] = False
    inside[max(0, n - size + 1) :] = False
    starts = np.flatnonzero(inside)
    return span_hashes(word_hashes, starts, starts + size, _WINDOW_BASE), starts
