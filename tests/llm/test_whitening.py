"""Whitening against numpy's eigenvectors and exact determinants."""

import random
from fractions import Fraction

import numpy as np
import pytest

from touchline.llm.whitening import OUT, characteristic_polynomial, components, nth_root, polynomial_modulo, primes, roots_above, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(rows):
    return [(i, v) for i, v, *_ in rows if v and all(c is not None and np.isfinite(c) for c in v)]


def fitted(rows):
    good = usable(rows)
    x = np.floor(64 * np.array([v for _, v in good], np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    return [i for i, _ in good], x, fit


def vectors(n=300, d=9, seed=1):
    rng = np.random.default_rng(seed)
    x = (rng.standard_normal((n, d)) * np.linspace(0.2, 3, d)).astype(np.float32)
    x[50:90] = x[3]
    out = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    return [*out, (n, None, 0), (n + 1, [], 0), (n + 2, [float("nan")] * d, 0), (n + 3, [None] + [0.0] * (d - 1), 0), (n + 4, [float("inf")] * d, 0), (None, out[0][1], 0), out[7], out[7], (n + 5, [1.0], 0)]


@pytest.mark.parametrize("d", [1, 2, 9, 20])
def test_whitened(spark, d):
    rows = vectors(d=d)
    if d == 1:
        rows = rows[:-1]
    got = [tuple(r) for r in whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()]
    keep = [r for r in rows if r[1] is None or len(r[1]) in (0, d)]
    ids, x, fit = fitted(keep)
    n, s, k = len(fit), fit.sum(0), min(d, 16)
    assert len(got) == len(ids) * k
    e, u = np.linalg.eigh(np.atleast_2d(np.cov(fit.T, bias=True)))
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    want = (x - s / n) @ u / np.sqrt(e)
    deviation = ((n * x - s) ** 2).sum(1)
    by_row = {}
    for vec_id, component, n_, dev, w, explained, error in got:
        assert n_ == n and error < 1e-10 and explained == pytest.approx(e[component - 1] / np.trace(np.atleast_2d(np.cov(fit.T, bias=True))), rel=1e-9)
        by_row.setdefault((vec_id, dev), {}).setdefault(component, []).append(w)
    mine = {}
    for i, dev, w in zip(ids, deviation.tolist(), want, strict=True):
        mine.setdefault((i, dev), []).append(w)
    assert set(mine) == set(by_row)
    sign = np.ones(k)
    for c in range(k):
        a = [v for key in sorted(mine, key=str) for v in by_row[key][c + 1]]
        b = [w[c] for key in sorted(mine, key=str) for w in mine[key]]
        sign[c] = np.sign(np.dot(a, b))
        assert np.allclose(np.array(a) * sign[c], b, atol=1e-8)


def test_edges(spark):
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA)).count() == 0  # one vector: no variance
    flat = [(i, [float(i), 2.0, float(2 * i)], 0) for i in range(6)]  # rank 1: the other eigenvalues are 0
    got = whiten(spark.createDataFrame(flat, SCHEMA)).collect()
    assert [r["component"] for r in got] == [1] * 6 and got[0]["explained"] == pytest.approx(1) and got[0]["identity_error"] < 1e-10
    clash = spark.createDataFrame([(1, [1.0, 0.0], 3, 4), (2, [0.0, 1.0], 3, 4), (3, [0.0, 5.0], 3, 4)], "vec_id long, embedding array<double>, x int, n int")
    assert whiten(clash).columns == [c.split()[0] for c in OUT.split(", ")]


def test_equal_eigenvalues(spark):
    """A square's corners and axes: every direction has the same variance; any orthonormal basis whitens."""
    rows = [(4 * k + i, [float(a) if j == k else 0.0 for j in range(5)], 0) for k in range(5) for i, a in enumerate([1, -1, 2, -2])]
    got = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 20 * 5 and got[0]["identity_error"] < 1e-10
    assert all(r["explained"] == pytest.approx(0.2, rel=1e-9) for r in got)


def test_large_values(spark):
    """Entries far from the rest: exact sums, deviations beyond 64 bits are null."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.integers(-(1 << 33), 1 << 33, 4)], 0) for i in range(40)]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    x = [[int(64 * c) + 1_000_000 for c in v] for _, v, _ in rows]
    s = [sum(c) for c in zip(*x, strict=True)]
    want = [sum((40 * c - t) ** 2 for c, t in zip(v, s, strict=True)) for v in x]
    assert {r["vec_id"]: r["deviation"] for r in got} == {i: w if w < 1 << 63 else None for i, w in enumerate(want)}
    assert got[0]["identity_error"] < 1e-9


def exact_polynomial(m):
    """Faddeev and LeVerrier's recurrence in fractions."""
    d = len(m)
    c, prev = [Fraction(0)] * d + [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        shifted = [[prev[i][j] + (c[d - k + 1] if i == j else 0) for j in range(d)] for i in range(d)]
        prev = [[sum(Fraction(m[i][t]) * shifted[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
        c[d - k] = -sum(prev[i][i] for i in range(d)) / k
    return [int(v) for v in c]


def test_polynomial_and_roots(spark):
    rng = random.Random(3)
    for d in (1, 2, 6):
        a = [[rng.randint(-9, 9) for _ in range(d)] for _ in range(d + 1)]
        m = [[sum(r[i] * r[j] for r in a) for j in range(d)] for i in range(d)]
        poly = exact_polynomial(m)
        assert characteristic_polynomial(spark, m) == poly
        p = primes(1, 101)[0]
        assert polynomial_modulo(np.array(m), p) == [c % p for c in poly]
        e = np.linalg.eigvalsh(np.array(m, float))[::-1]
        for k in range(d):
            low, shift = nth_root(poly, k + 1)
            assert max(low, 0) / 2**shift == pytest.approx(e[k], rel=1e-9, abs=1e-9)
        assert [roots_above(poly, t, 0) for t in (-1, 0, 10, 50)] == [(e > t + (1e-9 if t == 0 else 0)).sum() for t in (-1, 0, 10, 50)]
    spread = [[10**12, 0, 0], [0, 1, 0], [0, 0, 0]]
    assert [round(float(e), 6) for e, _ in components(spark, spread)] == [1e12, 1.0]
    assert primes(10**40)[0] == (1 << 31) - 1
