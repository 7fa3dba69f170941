"""Whitening of embeddings from an exact covariance found by polarisation.

Entries become whole numbers x.  The fit list holds each distinct x vector
once.  For every dimension and every sum of two dimensions Spark adds up the
squares of the centred values n * x - S, exactly; since
(a + b)^2 - a^2 - b^2 = 2ab, differences of these variances give every
cross-covariance without a product of two dimensions ever being formed.  The
d * (d + 1) / 2 sums are assembled on the driver (the only thing that reaches
it) for ``numpy.linalg.eigh``.

Exactness: a vector is stored as the smallest signed integers that hold it,
so equal vectors have equal bytes; squares are added up as limbs of whole
numbers, in 64 bits while they fit and in Python's integers beyond.

Rows are dropped if the vector is null or holds null or non-finite entries,
or an entry whose x no long can hold.  Vectors of another length than the most
frequent one (of ties the longest) have no covariance with the rest and are
dropped, too.  Empty vectors give no rows.  Components of no variance
(constant or dependent dimensions) can't be whitened and are left out, so
fewer than ``most`` may be returned, none for a single distinct vector.  A
null vec_id is kept; repeated rows come out repeatedly; ``deviation`` is null
only where it exceeds a long.  An empty table gives no rows.  Other columns
are not looked at.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import materialize

SCALE, OFFSET = 64, 1_000_000
MOST = 16
LIMB = 32
#: Limbs hold sums of up to 2^240; centred values stay far below 2^110.
LIMBS = 8
ROWS = 1 << 13
SAFE = 1 << 62


def vectors(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(length of each row or -1 if unusable, row numbers and double matrices of the usable rows by length)."""
    column = column.cast(pa.large_list(pa.float64()))
    null = column.is_null().to_numpy(zero_copy_only=False)
    size = np.where(null, -1, pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = column.flatten()                                     # without the rows that are null
    holes = flat.is_null().to_numpy(zero_copy_only=False)
    values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False)
    bad = holes | ~np.isfinite(values)
    kept = np.maximum(size, 0)
    begin = np.cumsum(kept) - kept
    faults = np.concatenate([[0], np.cumsum(bad)])
    size = np.where(faults[begin + kept] > faults[begin], -1, size)
    rows, matrices = [], []
    for n in np.unique(size[size > 0]).tolist():
        at = np.flatnonzero(size == n)
        rows.append(at)
        matrices.append(values[begin[at][:, None] + np.arange(n)])
    return size, rows, matrices


def pack(whole: np.ndarray) -> list[bytes]:
    """Each row less OFFSET as the smallest signed integers that hold it, the width in front."""
    shifted = whole - OFFSET
    low, high = shifted.min(axis=1), shifted.max(axis=1)
    out: list[bytes] = [b""] * len(whole)
    left = np.ones(len(whole), bool)
    for width in (1, 2, 4, 8):
        most = 1 << (8 * width - 1)
        at = np.flatnonzero(left & (low >= -most) & (high < most)) if width < 8 else np.flatnonzero(left)
        left[at] = False
        if len(at):
            raw = shifted[at].astype(f"<i{width}").tobytes()
            step = width * whole.shape[1]
            for k, i in enumerate(at.tolist()):
                out[i] = bytes([width]) + raw[k * step:(k + 1) * step]
    return out


def unpack(column: pa.Array, d: int) -> np.ndarray:
    """The packed rows as a matrix of longs."""
    raw = column.to_pylist()
    out = np.empty((len(raw), d), np.int64)
    width = np.array([b[0] for b in raw])
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        out[at] = np.frombuffer(b"".join(raw[i][1:] for i in at), f"<i{w}").reshape(len(at), d)
    return out + OFFSET


def whole_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(longs, rows in which every entry has one)."""
    with np.errstate(over="ignore"):
        x = np.floor(SCALE * values)
    fits = (np.abs(x) < 2.0 ** 62).all(axis=1)
    return np.where(fits[:, None], x, 0).astype(np.int64) + OFFSET, fits


def _limbs(total: int) -> list[int]:
    """Signed limbs, lowest first, that add up to ``total``."""
    sign, total = (-1, -total) if total < 0 else (1, total)
    out = []
    for _ in range(LIMBS):
        out.append(sign * (total & ((1 << LIMB) - 1)))
        total >>= LIMB
    return out


def _sums(df: DataFrame, run) -> dict[tuple[int, int], int]:
    """Exact sums by (i, j) of the whole numbers that ``run`` yields as limbs: a row a key and task is shuffled."""
    limbs = [f"l{k}" for k in range(LIMBS)]
    rows = df.mapInArrow(run, "i int, j int, " + ", ".join(f"{x} long" for x in limbs))
    summed = rows.groupBy("i", "j").agg(*(F.sum(x).alias(x) for x in limbs))
    return {(r[0], r[1]): sum(v << (LIMB * k) for k, v in enumerate(r[2:])) for r in summed.collect()}


def _emit(found: dict[tuple[int, int], int]) -> pa.RecordBatch:
    keys = sorted(found)
    limbs = [_limbs(found[k]) for k in keys]
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32())]
        + [pa.array([x[k] for x in limbs], pa.int64()) for k in range(LIMBS)], ["i", "j"] + [f"l{k}" for k in range(LIMBS)])


def _slices(batches, column):
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS).column(column)


def square_sums(z: np.ndarray) -> np.ndarray:
    """Exact sum of squares of each column, as Python integers."""
    if z.dtype == object:
        return (z * z).sum(axis=0)
    high, low = z >> 24, z & ((1 << 24) - 1)                    # z = high * 2^24 + low
    if np.abs(high).max(initial=0) < 1 << 24:                   # products below 2^48, at most 2^13 rows
        parts = [(high * high).sum(axis=0), (high * low).sum(axis=0), (low * low).sum(axis=0)]
        h, m, w = (p.astype(object) for p in parts)
        return (h << 48) + (m << 25) + w
    z = z.astype(object)
    return (z * z).sum(axis=0)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, in longs where they hold it, in Python's integers beyond."""
    mean = np.array([s // n for s in sums], np.int64)
    rest = [s - n * int(m) for s, m in zip(sums, mean)]         # 0 .. n - 1
    apart = x - mean
    if n * (int(np.abs(apart).max(initial=0)) + 1) < SAFE // 2:
        return n * apart - np.array(rest, np.int64)
    return n * apart.astype(object) - np.array(rest, object)


def whole_vectors(vecs: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id and packed x of every usable row of the most frequent length, that length)."""
    def run(batches):
        for b in batches:
            _, rows, matrices = vectors(b.column("embedding"))
            for at, values in zip(rows, matrices):
                x, fits = whole_numbers(values)
                at, x = at[fits], x[fits]
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(pa.array(at)), pa.array(pack(x), pa.binary()),
                     pa.array(np.full(len(at), x.shape[1], np.int32))], ["vec_id", "x", "d"])

    kind = vecs.schema["vec_id"].dataType.simpleString()
    whole = materialize(vecs.select("vec_id", "embedding").mapInArrow(run, f"vec_id {kind}, x binary, d int"), "whole")
    most = whole.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    d = most.d if most else 0
    return whole.filter(F.col("d") == d).select("vec_id", "x"), d


class Fit:
    """n, sums, eigenvalues and eigenvectors of a fit list of packed vectors."""

    def __init__(self, distinct: DataFrame, d: int, most: int = MOST):
        self.d = d

        def add(batches):
            found = {(i, 0): 0 for i in range(d + 1)}
            for column in _slices(batches, "x"):
                x = unpack(column, d)
                total = x.sum(axis=0) if np.abs(x).max(initial=0) < SAFE >> 14 else x.astype(object).sum(axis=0)
                for i, v in enumerate(total.tolist()):
                    found[i, 0] += int(v)
                found[d, 0] += len(x)
            yield _emit(found)

        first = _sums(distinct, add)
        self.n = n = first[d, 0]
        self.sums = sums = [first[i, 0] for i in range(d)]

        def squares(batches):
            found = {(i, j): 0 for i in range(d) for j in range(i, d)}
            for column in _slices(batches, "x"):
                z = centred(unpack(column, d), n, sums)
                for i in range(d):
                    both = z[:, i:] + z[:, i:i + 1]
                    both[:, 0] = z[:, i]
                    for j, v in enumerate(square_sums(both), i):
                        found[i, j] += int(v)
            yield _emit(found)

        var = _sums(distinct, squares)                          # n^3 times the variance of x_i, and of x_i + x_j
        self.covariance = np.empty((d, d))
        for i in range(d):
            for j in range(i, d):
                twice = var[i, j] - var[i, i] - var[j, j] if i < j else 2 * var[i, i]
                self.covariance[i, j] = self.covariance[j, i] = float(Fraction(twice, 2 * n ** 3))
        value, vector = np.linalg.eigh(self.covariance)
        self.trace = float(np.trace(self.covariance))
        keep = [k for k in np.argsort(-value, kind="stable") if value[k] > 1e-11 * max(value.max(), 0.0) > 0][:most]
        self.value, self.vector = value[keep], vector[:, keep]

    def whiten(self, z: np.ndarray) -> np.ndarray:
        """Projections of centred rows, over the standard deviations."""
        return (z.astype(np.float64) / self.n) @ (self.vector / np.sqrt(self.value))


def identity_error(distinct: DataFrame, fit: Fit) -> float:
    """Largest absolute entry of the fit list's whitened covariance minus the identity, measured on the rows."""
    k = len(fit.value)

    def run(batches):
        total = np.zeros((k, k))
        for column in _slices(batches, "x"):
            w = fit.whiten(centred(unpack(column, fit.d), fit.n, fit.sums))
            total += w.T @ w                                    # the mean is 0: rows are centred before projection
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total.ravel())],
                                         ["i", "j", "s"])

    out = np.zeros((k, k))
    for i, j, s in distinct.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s")).collect():
        out[i, j] = s / fit.n
    return float(np.abs(out - np.eye(k)).max())


def whiten(vecs: DataFrame, most: int = MOST) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and component."""
    kind = vecs.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    rows, d = whole_vectors(vecs)
    if not d:
        return vecs.sparkSession.createDataFrame([], schema)
    distinct = materialize(rows.groupBy("x").agg(F.count("*").alias("copies")).select("x"), "distinct")
    fit = Fit(distinct, d, most)
    k = len(fit.value)
    if not k:
        return vecs.sparkSession.createDataFrame([], schema)
    error = identity_error(distinct, fit)
    explained = fit.value / fit.trace

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                z = centred(unpack(part.column("x"), fit.d), fit.n, fit.sums)
                w = fit.whiten(z)
                if z.dtype == object or int(np.abs(z).max(initial=0)) ** 2 * d >= SAFE:
                    z = z.astype(object)
                square = (z * z).sum(axis=1).tolist()
                deviation = pa.array([s if s < 1 << 63 else None for s in square], pa.int64())
                each = np.repeat(np.arange(part.num_rows), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                     pa.array(np.full(len(each), fit.n)), deviation.take(pa.array(each)), pa.array(w.ravel()),
                     pa.array(np.tile(explained, part.num_rows)), pa.array(np.full(len(each), error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
