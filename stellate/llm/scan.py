"""Vectorised text scanning inside tasks: numpy over the bytes of an Arrow column.

A block is a slice of an Arrow batch whose texts hold a bounded number of
bytes (a single longer text forms a block of its own).  Words are found with
one byte mask and hashed with a 64-bit polynomial over prefix sums, so no
Python code runs per word.  A word hash is a function of its bytes only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 21
SEGMENT = 1 << 20

WS = np.zeros(256, bool)
WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Separators of alphanumeric tokens: every ASCII byte but letters and digits.
NON_ALNUM = np.ones(256, bool)
NON_ALNUM[48:58] = NON_ALNUM[65:91] = NON_ALNUM[97:123] = NON_ALNUM[128:] = False

SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and Latin-1 letters, byte for byte."""
    out = LOWER[data]
    second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[second] += 0x20
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply); input and output uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((BASE, INVERSE)):
            a = np.full(n, base, np.uint64)
            a[0] = 1
            _POWERS[k] = np.cumprod(a, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offs, data = column.buffers()
    o = np.frombuffer(offs, np.int64)[column.offset:column.offset + len(column) + 1] if offs else np.zeros(1, np.int64)
    if data is None or not len(o):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[o[0]:o[-1]], o - o[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for slices of at most ``limit`` text bytes (one row at least)."""
    for batch in batches:
        data, offs = flat(batch.column(column))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i), data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
            i = j


def spans(data: np.ndarray, offs: np.ndarray, separator: np.ndarray = WS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of every maximal run of non-separator bytes."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~separator[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(offs, start, "right") - 1


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray = SAME) -> np.ndarray:
    """uint64 hash of data[start:end] for sorted, disjoint ranges, each byte mapped through ``table``."""
    out = np.zeros(len(start), np.uint64)
    value = BYTE[table]
    i = 0
    while i < len(start):
        at = start[i]
        j = max(i + 1, int(np.searchsorted(end, at + SEGMENT, "right")))
        seg = data[at:end[j - 1]]
        power, inverse = _powers(max(len(seg), SEGMENT) + 1)
        sums = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum(value[seg] * power[:len(seg)], out=sums[1:])
        s, e = start[i:j] - at, end[i:j] - at
        out[i:j] = mix64((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        i = j
    return out


def prefix_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lengths: tuple[int, ...],
                  table: np.ndarray = SAME) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length: (numbers of the ranges that are longer, hash of their first bytes)."""
    long_enough = [np.flatnonzero(end - start > n) for n in lengths]
    out = [(at, hashes(data, start[at], start[at] + n, table)) for n, at in zip(lengths, long_enough)]
    return [(at, mix64(h ^ np.uint64(n))) for n, (at, h) in zip(lengths, out)]


def windows(word: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every n-word window inside one text."""
    m = len(word) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.full(m, n, np.uint64)
    for k in range(n):
        h = (h ^ word[k:k + m]) * np.uint64(BASE)
        h ^= h >> np.uint64(29)
    at = np.flatnonzero(doc[:m] == doc[n - 1:])
    return mix64(h[at]), at


def ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenation of the index ranges first[i] .. first[i] + size[i]."""
    total = int(size.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(size) - size
    return np.arange(total) - np.repeat(begin - first, size)
