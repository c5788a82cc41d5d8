"""Whitening: the exact parts against whole-number arithmetic, components against numpy, odd rows."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from fixtures import read
from urbanflow.llm import whitening as W
from urbanflow.llm.queries import op11_whitening


def leverrier(matrix, d):
    """Coefficients of det(xI - A) by traces of powers, in fractions."""
    a = [[Fraction(matrix[i * d + j]) for j in range(d)] for i in range(d)]
    m = [[Fraction(0)] * d for _ in range(d)]
    out = [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(a[i][l] * m[l][j] for l in range(d)) + (out[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        t = sum(a[i][l] * m[l][i] for i in range(d) for l in range(d))
        out.append(-t / k)
    return [int(c) for c in out]


def gram(rng, d, rank, size=9):
    b = np.array([[rng.randrange(-size, size + 1) for _ in range(d)] for _ in range(rank)], object).reshape(rank, d)
    return [int(v) for v in (b.T @ b).ravel()]


def test_polynomial_is_exact(spark):
    rng = random.Random(1)
    for d, rank in ((1, 1), (2, 2), (3, 1), (5, 5), (7, 4), (8, 8)):
        m = gram(rng, d, rank)
        assert W.polynomial(spark, m, d) == leverrier(m, d)
    big = gram(rng, 6, 6, 10 ** 15)
    assert W.polynomial(spark, big, 6) == leverrier(big, 6)


def test_hessenberg_with_zero_pivots():
    m = [0, 0, 1, 0, 0, 0, 0, 1, 1, 0, 0, 0, 0, 1, 0, 0]  # symmetric, zeros where pivots are looked for
    primes = W.primes_beyond(10 ** 30)
    want = leverrier(m, 4)
    assert all([int(v) for v in row] == [c % p for c in want] for row, p in zip(W.characteristic_mod(m, 4, primes), primes))


def test_primes():
    assert W.primes_beyond(10 ** 20)[:3] == [2147483647, 2147483629, 2147483587]
    assert [n for n in range(200) if W.is_prime(n)] == [n for n in range(2, 200) if all(n % k for k in range(2, n))]


def times(roots):
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([*poly, 0], [0, *poly])]
    return poly


@pytest.mark.parametrize("roots", [[5, 3, 2], [7, 7, 7, 1, 0, 0], [4], [0, 0], [10 ** 30, 10 ** 30 - 1, 1, 1], [8, 4, 2, 1],
                                   [3 ** 40, 2, 2, 0]])
def test_roots_are_found_with_multiplicity(roots):
    found = W.RealRoots(times(roots))
    want = sorted((r for r in set(roots) if r), reverse=True)
    assert found.rank == sum(r > 0 for r in roots)
    got = found.largest(len(roots))
    assert [m for _, _, m in got] == [roots.count(r) for r in want]
    for (a, places, _), r in zip(got, want):
        assert Fraction(a) / Fraction(2) ** places < r <= Fraction(a + 1) / Fraction(2) ** places
        assert Fraction(1) / Fraction(2) ** places <= r * Fraction(1, 2 ** (W.BITS - 1))


def test_fractional_roots():
    got = W.RealRoots([1, -3, 1]).largest(1)  # (3 +- sqrt 5) / 2
    assert abs(float(Fraction(2 * got[0][0] + 1, 2) / 2 ** got[0][1]) - (3 + math.sqrt(5)) / 2) < 1e-15


def plain(vectors, number=16):
    """Distinct integer vectors, S, n, and numpy's eigenvectors of their covariance."""
    x = np.unique(np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + W.OFFSET, axis=0)
    n, s = len(x), x.sum(axis=0)
    v, c = np.linalg.eigh(np.cov((x - W.OFFSET).T, bias=True))
    return n, [int(a) for a in s], v[::-1][:number], c.T[::-1][:number], float(v.sum())


def test_query_equals_numpy(spark):
    sf = "/root/testdata/sf0.001"
    rows = op11_whitening(spark, sf).collect()
    given = {r["vec_id"]: r["embedding"] for r in read(spark, "embeddings").collect()}
    n, s, values, vectors, trace = plain(list(given.values()))
    assert len(rows) == 16 * len(given) and len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9
    by = {}
    for r in rows:
        by.setdefault(r["component"], {})[r["vec_id"]] = r
    for k in range(16):
        x = {i: np.floor(64 * np.array(v, np.float32).astype(float)).astype(np.int64) + W.OFFSET for i, v in given.items()}
        centred = {i: np.array([float(Fraction(int(a)) - Fraction(b, n)) for a, b in zip(v, s)]) for i, v in x.items()}
        want = {i: float(c @ vectors[k]) / math.sqrt(values[k]) for i, c in centred.items()}
        first = max(want, key=lambda i: abs(want[i]))
        sign = math.copysign(1, want[first] * by[k + 1][first]["whitened"])
        for i, r in by[k + 1].items():
            assert r["n"] == n and abs(r["whitened"] * sign - want[i]) < 1e-7
            assert abs(r["explained"] - values[k] / trace) < 1e-9 * r["explained"] + 1e-12
            assert r["deviation"] == sum((n * int(a) - b) ** 2 for a, b in zip(x[i], s))


def test_repeated_variances_and_missing_directions(spark):
    axes = [[float(64 * s) if i == k else 0.0 for i in range(5)] + [1.5] for k in range(4) for s in (1, -1)] + [[0.0] * 4 + [9.0, 1.5], [0.0] * 4 + [-9.0, 1.5]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(axes + axes[:3])], "vec_id long, embedding array<float>")
    rows = W.whiten(df).collect()
    assert len(rows) == 13 and rows[0]["n"] == 10 and all(len(r["whitened"]) == 5 for r in rows)  # the last entry never varies
    e = rows[0]["explained"]
    assert len(set(e[:4])) == 1 and e[4] < e[0] and abs(sum(e) - 1) < 1e-12 and rows[0]["identity_error"] < 1e-12


def test_nearly_equal_variances_are_told_apart():
    m = [10 ** 20 + 1, 1, 0, 1, 10 ** 20, 0, 0, 0, 5]
    roots = W.RealRoots(leverrier(m, 3)).largest(3)
    assert [r[2] for r in roots] == [1, 1, 1]
    v = [W.null_vectors(m, 3, *r)[0] for r in roots]
    golden = (1 + math.sqrt(5)) / 2
    assert np.allclose(np.abs(v[0]), [golden / math.hypot(golden, 1), 1 / math.hypot(golden, 1), 0], atol=1e-15)
    assert np.allclose(np.abs(np.array(v) @ np.array(v).T), np.eye(3), atol=1e-15)


def test_large_entries_stay_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) * 1e15, rng.uniform(-1, 1) * 3e8, rng.uniform(-1, 1)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = [[math.floor(c * 64) + W.OFFSET for c in v] for _, v in rows]
    n, s = len(x), [sum(c) for c in zip(*x)]
    got = {r["vec_id"]: r for r in W.whiten(df).collect()}
    for i, v in enumerate(x):
        assert int(got[i]["deviation"]) == sum((n * a - b) ** 2 for a, b in zip(v, s))
    assert got[0]["identity_error"] < 1e-6


def test_limbs():
    z = np.array([[-(1 << 62), (1 << 61) + 7, -5], [12345678901, -1, 0]])
    limbs = W._limbs(z)
    assert (sum(a.astype(np.int64).astype(object) * (1 << (W.LIMB * k)) for k, a in enumerate(limbs)) == z.astype(object)).all()


def test_edges(spark):
    from pyspark.sql import functions as F
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0]), (7, []),
            (None, [3.0, -4.0]), (8, [0.0, 0.0]), (9, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    wide = df.withColumns({c: F.lit("own") for c in ("x", "v", "n", "w", "Deviation", "whitened", "label", "size")})
    got = W.whiten(wide).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in got) == [(False, 1), (False, 1), (False, 8), (True, 0)]
    assert all(r["n"] == 3 and r["label"] == "own" and len(r["whitened"]) == 2 for r in got)
    assert W.whiten(df.limit(0)).count() == 0 and W.whiten(df.where("vec_id = 2")).count() == 0
    one = W.whiten(df.where("vec_id = 1")).collect()
    assert len(one) == 2 and one[0]["whitened"] == [] and one[0]["deviation"] == 0 and one[0]["identity_error"] is None
    none = W.whiten(df.where("vec_id = 7")).collect()
    assert len(none) == 1 and none[0]["whitened"] == [] and none[0]["n"] == 1
    equal = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(3)], "vec_id long, embedding array<float>")
    assert [len(r["whitened"]) for r in W.whiten(equal).collect()] == [1, 1, 1]
