"""Blocked Bloom filters whose bit array is assembled from slices that tasks build.

A hash picks a 512-bit block by its low bits and ``k`` bits inside it.  The
number of blocks is fixed by the caller, so the size of what the driver
gathers and broadcasts (64 bytes a block) is known before anything is built.
Members are always found; other hashes pass at the usual false-positive rate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.scan import mix64

SLICE_BLOCKS = 512
WORDS = 8


def blocks_for(entries: int, bits_per_entry: int, most_blocks: int) -> int:
    """Power of two of blocks for ``entries``, never above ``most_blocks``."""
    need = max(1, -(-entries * bits_per_entry // 512))
    return min(1 << (need - 1).bit_length(), most_blocks)


def _bits(h: np.ndarray, k: int):
    rest = mix64(h ^ np.uint64(0xD6E8FEB86659FD93))
    for i in range(k):
        bit = (rest >> np.uint64(9 * i)) & np.uint64(511)
        yield (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))


def build(hashes: DataFrame, n_blocks: int, k: int) -> np.ndarray:
    """uint64 words of the filter of the single long column of ``hashes``."""
    name = hashes.columns[0]
    per = min(SLICE_BLOCKS, n_blocks)

    def fill(t):
        h = t.column("h").to_numpy().astype(np.int64).view(np.uint64)
        words = np.zeros(per * WORDS, np.uint64)
        base = (h & np.uint64(per - 1)).astype(np.int64) * WORDS
        for word, mask in _bits(h, k):
            np.bitwise_or.at(words, base + word, mask)
        return pa.table({"slice": pa.array([t.column("slice")[0].as_py()], pa.int64()),
                         "bits": pa.array([words.tobytes()], pa.binary())})

    made = (hashes.select(F.col(name).alias("h"))
            .withColumn("slice", F.floor(F.col("h").bitwiseAND(n_blocks - 1) / per).cast("long"))
            .groupBy("slice").applyInArrow(fill, "slice long, bits binary"))
    out = np.zeros(n_blocks * WORDS, np.uint64)
    for row in made.collect():
        out[row["slice"] * per * WORDS:(row["slice"] + 1) * per * WORDS] = np.frombuffer(row["bits"], np.uint64)
    return out


def contains(words: np.ndarray, h: np.ndarray, k: int) -> np.ndarray:
    """Which of the uint64 hashes may be members."""
    out = np.zeros(len(h), bool)
    at = np.arange(len(h))
    base = ((h & np.uint64(len(words) // WORDS - 1)) * np.uint64(WORDS)).astype(np.int64)
    rest = mix64(h ^ np.uint64(0xD6E8FEB86659FD93))
    for i in range(k):
        bit = (rest >> np.uint64(9 * i)) & np.uint64(511)
        hit = (words[base + (bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0
        at, base, rest = at[hit], base[hit], rest[hit]
        if not len(at):
            return out
    out[at] = True
    return out
