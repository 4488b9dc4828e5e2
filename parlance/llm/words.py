"""Word tables of Arrow string columns, computed for many texts at once.

A word is a maximal run of bytes of one class; class 0 separates words. All
separators are ASCII, so working on the UTF-8 bytes finds the same words as
working on code points. Every word gets a 64-bit hash; nothing here depends on the machine or
the partition, so equal words have equal hashes everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once; one longer text is handled alone. The arrays take about 60 times as much.
PIECE_BYTES = 1 << 19

BASE = np.uint64(0x9E3779B97F4A7C15)
ODD = np.uint64(0xD6E8FEB86659FD93)

# --- Fixed values: byte classes of the word rules; 0 separates -----------------
SPACED = np.ones(256, np.uint8)
SPACED[[0x20, *range(0x09, 0x0E)]] = 0
ALNUM = np.ones(256, np.uint8)
ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = 0
# Letters and digits of either case as words, runs of other marks as words of their own.
MARKED = np.where(SPACED == 0, 0, 2).astype(np.uint8)
MARKED[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1

FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20
KEEP = np.arange(256, dtype=np.uint8)


class Words(NamedTuple):
    """Words of several texts: byte ranges, text numbers, hashes, and first word per text."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # words of text i are first[i] to first[i + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of BASE and of its inverse modulo 2**64, extended on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, PIECE_BYTES + 1)
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            self.up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, BASE))))
            self.down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, inverse))))
        return self.up, self.down


powers = _Powers()


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each."""
    _, offsets = texts_of(batch.column(column))
    row = 0
    while row < len(batch):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield batch.slice(row, stop - row)
        row = stop


def words_of(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> Words:
    """Words of texts given as one byte array and offsets."""
    kind = np.zeros(len(data) + 2, np.uint8)
    kind[1:-1] = classes[data]
    change = kind[1:] != kind[:-1]
    borders = offsets[1:-1]
    change[borders[(borders > 0) & (borders < len(data))]] = True
    starts = change & (kind[1:] > 0)
    ends = change & (kind[:-1] > 0)
    start, end = np.flatnonzero(starts), np.flatnonzero(ends)
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    value = (total[end] - total[start]) * down[start]
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(start, end, text, mix(value + (end - start).astype(np.uint64) * ODD), first)


def runs_hash(values: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive values."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = values[:n].copy()
    for k in range(1, length):
        out = out * BASE + values[k:k + n]
    return mix(out + np.uint64(length * int(ODD) % (1 << 64)))


def as_long(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit hashes as Spark longs."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))
