import math
from fractions import Fraction

import numpy as np
import pytest

from glossa.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>"


def integers(rows):
    return np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in rows], object)


def check(spark, vectors, components=32, extra=()):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)] + list(extra)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS component", "1 AS n", "2 AS deviation").repartition(3)
    got = W.whitened_components(frame, components).collect()
    x = integers(vectors)
    n, s = len(x), x.sum(0)
    z = n * x - s
    v = (z.T.dot(z) // n).astype(float) / n ** 2  # z'z is n * M
    e = np.linalg.eigvalsh(v)[::-1]
    rank = int((e > 1e-9 * e[0]).sum()) if e[0] > 0 else 0
    k = min(components, rank)
    assert len(got) == n * k
    out = np.zeros((n, k))
    for r in got:
        out[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and int(r.deviation) == sum(int(c) ** 2 for c in z[r.vec_id])
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-6)
        assert r.identity_error < 1e-6
    if k:
        assert np.abs(out.T @ out / n - np.eye(k)).max() < 1e-8
        # the rows are V's eigenvectors: a whitened column projects back onto its eigenvalue
        back = (z / n).astype(float).T @ out / n  # V u / sqrt(e) = sqrt(e) u
        assert np.abs(v @ back - back * e[:k]).max() < 1e-7 * e[0] ** 1.5
    return out


def test_whitening_of_random_and_of_degenerate_vectors(spark):
    rng = np.random.default_rng(3)
    check(spark, rng.normal(size=(300, 40)) @ rng.normal(size=(40, 40)) / 4)
    check(spark, rng.normal(size=(200, 6)), components=3)
    check(spark, rng.normal(size=(5, 12)))  # fewer vectors than dimensions
    low = rng.integers(-50, 50, size=(60, 3)) / 64
    check(spark, np.column_stack([low, low[:, 0], low[:, 1] + low[:, 2], np.full(60, 0.5)]))  # equal, summed and constant dimensions
    axes = np.vstack([np.eye(4), -np.eye(4)])  # four equal eigenvalues
    check(spark, axes)
    check(spark, np.vstack([axes * 3, [[0, 0, 0, 0]]]) * [1, 1, 2, 2])  # two pairs of equal ones


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    extra = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [nan, 0.0, 0.0]), (904, [0.0, inf, 0.0]), (905, [1.0, 2.0])]
    check(spark, [[0.1, 0.2, 0.3], [0.5, -0.2, 0.3], [0.1, 0.9, -3.0], [0.1, 0.2, 0.3], [7.0, 1e2, 1e-30]], extra=extra)
    assert W.whitened_components(spark.createDataFrame(extra[:5], SCHEMA)).count() == 0
    assert W.whitened_components(spark.createDataFrame([], SCHEMA)).count() == 0
    same = W.whitened_components(spark.createDataFrame([(1, [0.5, 2.0]), (1, [0.5, 2.0]), (None, [0.5, 2.0])], SCHEMA))
    assert same.count() == 0 and "identity_error" in same.columns
    repeated = W.whitened_components(spark.createDataFrame([(1, [0.5, 2.0]), (1, [0.5, 2.0]), (None, [0.25, 2.0])], SCHEMA)).collect()
    assert sorted(((r.vec_id or 0), int(r.deviation), abs(round(r.whitened, 9))) for r in repeated) == [
        (0, 32 ** 2, round(2 ** 0.5, 9)), (1, 16 ** 2, round(0.5 ** 0.5, 9)), (1, 16 ** 2, round(0.5 ** 0.5, 9))]


def test_large_entries_are_summed_exactly():
    rng = np.random.default_rng(1)
    for most in (1 << 10, 1 << 30, 1 << 50, 1 << 61):
        y = rng.integers(-most, most, size=(50, 4))
        big = y.astype(object)
        assert (W.exact_scatter(y) == big.T.dot(big)).all()
        assert (W._products(np.ones((50, 1), np.int64), y)[0] == big.sum(0)).all()


def test_polynomial_and_roots():
    rng = np.random.default_rng(2)
    a = rng.integers(-9, 9, size=(7, 5)).astype(object)
    m = a.dot(a.T)  # 7 x 7, of rank 5
    p = W.primes(40)[0]
    want = np.rint(np.poly(m.astype(float)))[::-1]
    assert W.characteristic_modulo(m, p).tolist() == [int(c) % p for c in want]
    roots = W.Roots([0, 0, *[int(c) for c in np.rint(np.poly([1, 2, 2, 5]))[::-1]]])  # x^2 (x-1) (x-2)^2 (x-5)
    assert roots.zeros == 2 and [roots.beyond(Fraction(x)) for x in (0, 1, 2, 5)] == [4, 3, 1, 0]
    assert [(round(float(r), 12), k) for r, k in roots.largest(10)] == [(5.0, 1), (2.0, 2), (1.0, 1)]
    assert [k for _, k in roots.largest(2)] == [1, 2]
