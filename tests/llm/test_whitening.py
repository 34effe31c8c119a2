"""Embedding whitening against exact rational arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tremor.llm import whitening

KIND = "vec_id long, embedding array<double>, component string, n string, whitened string"


def frame(spark, rows, kind=KIND):
    return spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], kind)


def exact(rows, size):
    """{vec_id: quantised}, n, sums and the covariance times n^3 as whole numbers."""
    x = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in rows if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    n, sums = len(x), [sum(v[j] for _, v in x) for j in range(size)]
    m = [[n * v - s for v, s in zip(r, sums, strict=True)] for _, r in x]
    return x, n, sums, m, [[sum(r[i] * r[j] for r in m) for j in range(size)] for i in range(size)]


def vectors(seed, n, size, spread):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(size, size)) * np.logspace(0, spread, size)
    return [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(n, size)) @ mix.T + rng.normal(size=size) * 1000)]


@pytest.mark.parametrize(("size", "spread"), [(12, 1), (5, 3)])
def test_whitening(spark, size, spread):
    rows = vectors(size, 300, size, spread)
    odd = [(1000, None), (1001, [None] * size), (1002, [math.nan] + [0.0] * (size - 1)), (1003, [math.inf] * size), (1004, []), (1005, [1.0]), (7, rows[7][1]), (None, rows[8][1])]
    x, n, sums, m, third = exact(rows + odd, size)
    out = whitening.whiten(frame(spark, rows + odd).repartition(5)).collect()
    k = min(8, size)
    assert len(out) == n * k == 302 * k and {r.n for r in out} == {n} and len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-9
    deviation = [sum(v * v for v in r) for r in m]
    assert sorted((r.vec_id is None, r.vec_id or 0, r.deviation) for r in out if r.component == 1) == sorted((i is None, i or 0, d) for (i, _), d in zip(x, deviation, strict=True))
    v = np.array([[float(Fraction(c, n**3)) for c in r] for r in third])
    values, found = np.linalg.eigh(v)
    values, found = values[::-1][:k], found[:, ::-1][:, :k]
    want = (np.array(m, float) / n) @ found / np.sqrt(values)
    place = {}
    for (i, _), w in zip(x, want, strict=True):
        place.setdefault(i, w)
    for r in out:
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-9)
        assert abs(abs(r.whitened) - abs(place[r.vec_id][r.component - 1])) < 1e-6
    mine = np.array([[r.whitened for r in sorted(out, key=lambda r: (str(r.vec_id), r.whitened)) if r.component == c + 1] for c in range(k)])
    assert np.abs((mine**2).mean(axis=1) - 1).max() < 1e-9


def test_compensated_sums_are_exact(spark):
    """Large means and spreads that a plain sum of squares loses: high + low is right to some 60 bits."""
    rows = [(i, [1e9 + i % 7 * 2.0**-10, float(i % 5), 1e-3 * i]) for i in range(2000)]
    x, n, sums, _, third = exact(rows, 3)
    high, low = whitening.covariance(frame(spark, rows).repartition(7).select("embedding"), n, tuple(sums), whitening.Quantiser())
    for i in range(3):
        for j in range(3):
            want = Fraction(third[i][j], n * n)
            scale = math.sqrt(third[i][i] * third[j][j]) / n**2
            assert abs(Fraction(high[i, j]) + Fraction(low[i, j]) - want) < Fraction(scale) * Fraction(1, 1 << 55)


def test_refined_eigenvectors():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.normal(size=(30, 30)))
    values = np.sort(np.concatenate([[5.0, 5.0], rng.random(28)]))[::-1]  # a tie
    a = (q * values) @ q.T
    got, v = whitening.eigen((a + a.T) / 2, np.zeros((30, 30)))
    assert np.abs(got - values).max() < 1e-14 * 50 and np.abs(v.T @ v - np.eye(30)).max() < 1e-15 * 5 and np.abs(v @ np.diag(got) @ v.T - a).max() < 1e-13


def test_flat_and_few_vectors(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    (a, b) = whitening.whiten(frame(spark, [(1, [3.0, 4.0])])).collect()
    assert (a.whitened, a.explained, a.deviation, a.identity_error, a.n) == (0.0, 0.0, 0, 0.0, 1) and b.component == 2
    out = whitening.whiten(frame(spark, [(i, [float(i % 2), 7.0]) for i in range(10)])).collect()
    assert {abs(r.whitened) for r in out if r.component == 1} == {1.0} and {r.whitened for r in out if r.component == 2} == {0.0} and out[0].identity_error < 1e-12


def test_wide_entries_and_floats(spark):
    """Sums beyond 64 bits stay exact; a deviation that no long holds is null."""
    rows = [(i, [1e30 if i % 2 else -1e30, float(i)]) for i in range(6)]
    out = whitening.whiten(frame(spark, rows)).collect()
    assert {r.deviation for r in out} == {None} and out[0].identity_error < 1e-9
    floats = spark.createDataFrame([("a", [0.1, 0.2]), ("b", [0.5, 0.1]), ("c", [0.3, 0.9])], "vec_id string, embedding array<float>")
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in ([0.1, 0.2], [0.5, 0.1], [0.3, 0.9])]
    s = [sum(c) for c in zip(*x, strict=True)]
    got = {r.vec_id: r.deviation for r in whitening.whiten(floats).collect()}
    assert got == {i: sum((3 * c - t) ** 2 for c, t in zip(v, s, strict=True)) for i, v in zip("abc", x, strict=True)}
