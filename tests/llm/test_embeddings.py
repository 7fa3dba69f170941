"""Whitening and near-duplicates of embeddings against brute force."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from stellate.llm import embedding_dedup, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, n string, x string, node int, d string, component string, root int"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, g, "n", "x", 1, "d", "c", 2) for i, e, g in rows], SCHEMA).repartition(4)


def whole(rows):
    good = [(i, e) for i, e, _ in rows if e and all(c is not None and math.isfinite(c) for c in e)]
    sizes = {}
    for _, e in good:
        sizes[len(e)] = sizes.get(len(e), 0) + 1
    d = max(sizes, key=lambda k: (sizes[k], k)) if sizes else 0
    return [(i, tuple(math.floor(64 * c) + 1000000 for c in e)) for i, e in good if len(e) == d]


def brute_whitening(rows, most):
    x = whole(rows)
    fit = sorted({v for _, v in x})
    n, d = len(fit), len(fit[0])
    s = [sum(v[k] for v in fit) for k in range(d)]
    z = [[n * v[k] - s[k] for k in range(d)] for v in fit]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in z), n ** 3)) for j in range(d)] for i in range(d)])
    value, vector = np.linalg.eigh(cov)
    order = [k for k in np.argsort(-value) if value[k] > 1e-11 * value.max()][:most]
    out = []
    for i, v in x:
        c = [n * v[k] - s[k] for k in range(d)]
        w = (np.array(c, float) / n) @ vector[:, order] / np.sqrt(value[order])
        out += [(i, k + 1, n, sum(q * q for q in c), w[k], value[order[k]] / np.trace(cov)) for k in range(len(order))]
    return out


def signed_alike(got, want):
    """Components agree up to one sign each; vec_id may be null and may repeat."""
    key = lambda r: (r[1], r[0] is None, r[0] or 0, r[3], abs(r[4]))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [tuple(r[:4]) for r in got] == [tuple(r[:4]) for r in want]
    for k in {r[1] for r in want}:
        a = np.array([r[4] for r in got if r[1] == k])
        b = np.array([r[4] for r in want if r[1] == k])
        top = np.abs(b).argmax()
        assert np.allclose(a, b * np.sign(a[top] * b[top]), rtol=1e-7, atol=1e-9)
        assert np.allclose([r[5] for r in got if r[1] == k], [r[5] for r in want if r[1] == k], rtol=1e-6)


def embeddings(seed, n, d, spread):
    rnd = np.random.default_rng(seed)
    rows = [(i, (rnd.normal(size=d) * spread).tolist(), int(rnd.integers(0, 3))) for i in range(n)]
    rows += [(n + i, rows[i][1], rows[i][2]) for i in range(10)]                       # copies
    rows += [(n + 20 + i, (np.array(rows[0][1]) * (1 + 0.001 * i)).tolist(), rows[0][2]) for i in range(12)]
    rows += [(n + 40 + i, (np.array(rows[1][1]) + rnd.normal(size=d) * 0.02).tolist(), rows[1][2]) for i in range(30)]
    rows += [(n + 80, None, 0), (n + 81, [None] + [1.0] * (d - 1), 0), (n + 82, [float("nan")] * d, 0), (n + 83, [], 0),
             (n + 84, [float("inf")] + [0.0] * (d - 1), 0), (n + 85, [1.0, 2.0], 0), (n + 86, [1.0, 2.0], 0),
             (n + 87, [0.0] * d, 1), (n + 88, [0.0] * d, 1), (None, rows[2][1], rows[2][2]), (3, rows[3][1], rows[3][2]),
             (n + 89, rows[4][1], None), (n + 90, None, None), (n + 91, [-0.0] * (d - 1) + [1.0], 2), (n + 92, [0.0] * (d - 1) + [1.0], 2)]
    return rows


@pytest.mark.parametrize("spread,d", [(0.3, 7), (500.0, 5), (1e9, 4)])
def test_whitening_against_brute_force(spark, spread, d):
    rows = embeddings(4, 90, d, spread)
    got = [tuple(r) for r in whitening.whiten(frame(spark, rows), 6).collect()]
    want = [r if r[3] < 1 << 63 else (*r[:3], None, *r[4:]) for r in brute_whitening(rows, 6)]
    signed_alike([r if r[3] is not None else (*r[:3], 0, *r[4:]) for r in got],
                 [r if r[3] is not None else (*r[:3], 0, *r[4:]) for r in want])
    assert {r[6] for r in got} and max(r[6] for r in got) < 1e-6 and len({r[6] for r in got}) == 1


def test_whitening_edges(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None, 0), (2, [], 0), (3, [float("nan")], 1)])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)])).count() == 0      # no variance
    flat = whitening.whiten(frame(spark, [(i, [0.1 * i, 0.1 * i, 2.0], 0) for i in range(9)])).collect()  # one dimension
    assert {r.component for r in flat} == {1} and len(flat) == 9 and abs(flat[0].explained - 1) < 1e-9
    huge = whitening.whiten(frame(spark, [(i, [1e300, 1.0], 0) for i in range(3)] + [(9, [1.0, 2.0], 0), (8, [2.0, 1.0], 0)]))
    assert {r.vec_id for r in huge.collect()} == {8, 9}


def test_square_sums_are_exact():
    rnd = random.Random(1)
    for bits in (3, 30, 47, 60):
        z = [[rnd.randrange(-1 << bits, 1 << bits) for _ in range(3)] for _ in range(500)]
        want = [sum(r[k] ** 2 for r in z) for k in range(3)]
        assert [int(v) for v in whitening.square_sums(np.array(z, np.int64))] == want
        assert [int(v) for v in whitening.square_sums(np.array(z, object))] == want


def brute_links(rows, cosine):
    unit = []
    for _, e, g in rows:
        ok = e and g is not None and all(c is not None and math.isfinite(c) for c in e) and any(e)
        a = np.array(e) / np.abs(e).max() if ok else None
        unit.append(a / np.sqrt(a @ a) if ok else None)
    near = [[j for j in range(len(rows)) if j != i and unit[i] is not None and unit[j] is not None
             and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in range(len(rows))]
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, js in enumerate(near):
            for j in js:
                if root[j] < root[i]:
                    root[i], changed = root[j], True
    least = {}
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    return sorted(str((rows[i][0], len(near[i]), least.get(r), rows[i][0] == least.get(r))) for i, r in enumerate(root))


@pytest.mark.parametrize("tile,d,spread,cosine", [(2048, 7, 0.3, 0.98), (16, 40, 1e200, 0.98), (9, 24, 1e-200, 0.9)])
def test_near_duplicates_against_brute_force(spark, tile, d, spread, cosine):
    rows = embeddings(6, 120, d, spread)
    got = embedding_dedup.near_duplicates(frame(spark, rows), cosine, tile).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_links(rows, cosine)


def test_near_duplicates_edges(spark):
    assert embedding_dedup.near_duplicates(frame(spark, [])).count() == 0
    got = embedding_dedup.near_duplicates(frame(spark, [(1, None, 0), (None, [1.0], None), (2, [0.0], 1)])).collect()
    assert sorted(map(str, map(tuple, got))) == ["(1, 0, 1, True)", "(2, 0, 2, True)", "(None, 0, None, True)"]


def test_many_dimensions_are_only_ordered(spark, monkeypatch):
    rows = embeddings(8, 60, 12, 1.0)
    monkeypatch.setattr(embedding_dedup, "MOST_ROTATED", 4)
    got = embedding_dedup.near_duplicates(frame(spark, rows), 0.95, 16).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_links(rows, 0.95)


def test_no_pair_is_lost_by_stopping_early():
    rnd = np.random.default_rng(2)
    base = rnd.normal(size=(40, 64))
    a = np.concatenate([base + rnd.normal(size=base.shape) * s for s in (0.05, 0.15, 0.2, 0.25)])
    u = embedding_dedup.units(a)
    i, j, value = embedding_dedup.linked(u, u, 0.98)
    want = u @ u.T >= 0.98
    got = np.zeros_like(want)
    got[i[value >= 0.98], j[value >= 0.98]] = True
    assert (got == want).all() and 160 < want.sum() < 3000
