"""Whitening against plain fractions and numpy, and its defined cases."""

import random
from fractions import Fraction

import numpy as np
import pytest

from millrace.llm import charpoly, whitening

ROWS = "vec_id long, x array<long>, component string, n string"


def table(spark, vectors):
    rows = [(i, None if v is None else [int(c) for c in v], "c", "n") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, ROWS).repartition(3)


def plain_polynomial(a):
    """Faddeev and LeVerrier's, in fractions."""
    n = len(a)
    m, found = [[Fraction(0)] * n for _ in range(n)], [Fraction(1)]
    for k in range(1, n + 1):
        m = [
            [sum(a[i][t] * m[t][j] for t in range(n)) + (found[-1] if i == j else 0) for j in range(n)]
            for i in range(n)
        ]
        am = [[sum(a[i][t] * m[t][j] for t in range(n)) for j in range(n)] for i in range(n)]
        found.append(-sum(am[i][i] for i in range(n)) / k)
    return [int(c) for c in found]


def test_polynomial_by_primes_is_exact():
    rng = random.Random(4)
    for size in (1, 2, 3, 6, 9):
        for rank in {1, size // 2 or 1, size}:
            y = np.array([[rng.randint(-9, 9) * 10**6 for _ in range(size)] for _ in range(rank)], object)
            a = y.T.dot(y)
            trace = int(sum(a[i, i] for i in range(size)))
            moduli = charpoly.primes(charpoly.coefficient_bits(size, trace) + 1)
            found = charpoly.combined([(p, charpoly.characteristic(a, p)) for p in moduli])
            assert found == plain_polynomial(a.tolist())


def test_roots_are_isolated_and_refined():
    # (x - 1) (x - 2) (x - 2) (x - 5) (x - 5) (x - 5), and a pair that differs by a thousandth
    poly = [1]
    for root in (1, 2, 2, 5, 5, 5):
        poly = [a - root * b for a, b in zip([*poly, 0], [0, *poly])]
    found = charpoly.largest_roots(poly, 6)
    one = 1 << charpoly.ROOT_BITS
    assert sorted((charpoly.refined(f, *at) / one, n) for f, at, n in found) == [(1, 1), (2, 2), (5, 3)]
    close = [1000 * 1000, -(3000 * 1000 + 3001 * 1000), 3000 * 3001]
    roots = [charpoly.refined(f, *at) / one for f, at, _ in charpoly.largest_roots(close, 2)]
    assert roots == [3.001, 3.0]


@pytest.mark.parametrize("seed, rank", [(1, 5), (2, 5), (3, 2)])
def test_equals_numpy(spark, seed, rank):
    rng = np.random.default_rng(seed)
    base = rng.integers(-300, 300, (60, rank)) @ rng.integers(-3, 4, (rank, 5)) + 1_000_000
    vectors = [*base, *base[:7], None, base[0]]
    found = whitening.whitened(table(spark, vectors), top=4).collect()
    fit = np.unique(base, axis=0).astype(object)
    n, sums = len(fit), fit.sum(axis=0)
    covariance = np.cov(fit.astype(float).T, bias=True)
    values, directions = np.linalg.eigh(covariance)
    k = min(4, rank)
    values, directions = values[::-1][:k], directions[:, ::-1][:, :k]
    white = {(r.vec_id, r.component): r for r in found}
    ids = [i for i, v in enumerate(vectors) if v is not None]
    assert sorted(white) == [(i, c) for i in ids for c in range(1, k + 1)] and len(found) == len(white)
    expected = (np.array([vectors[i] for i in ids], float) - (sums / n).astype(float)) @ directions
    expected /= np.sqrt(values)
    mine = np.array([[white[i, c].whitened for c in range(1, k + 1)] for i in ids])
    signs = np.sign((mine * expected).sum(axis=0))
    assert np.abs(mine - expected * signs).max() < 1e-8
    for i in ids:
        row = white[i, 1]
        assert row.n == n and row.identity_error < 1e-9
        assert row.deviation == sum((n * int(x) - int(s)) ** 2 for x, s in zip(vectors[i], sums))
        assert row.explained == pytest.approx(values[0] / np.trace(covariance), rel=1e-9)


def test_equal_eigenvalues_have_as_many_components(spark):
    vectors = [s * np.eye(4, dtype=int)[i] * 50 for i in range(4) for s in (1, -1)]
    found = whitening.whitened(table(spark, vectors)).collect()
    assert {r.component for r in found} == {1, 2, 3, 4} and len(found) == 32
    assert found[0].identity_error < 1e-12 and all(r.explained == 0.25 for r in found)


def test_cases_without_components(spark):
    for vectors in ([], [None], [[5, 6]], [[5, 6], [5, 6], [5, 6]], [[]], [[], None]):
        found = whitening.whitened(table(spark, vectors))
        assert found.count() == 0 and "identity_error" in found.columns


def test_large_values_and_other_lengths(spark):
    big = 2**52
    vectors = [[big, 1], [-big, 2], [big - 1, 7], [3, 3, 3], [1]]
    found = {(r.vec_id, r.component): r for r in whitening.whitened(table(spark, vectors)).collect()}
    assert set(found) == {(i, c) for i in range(3) for c in (1, 2)}
    assert found[0, 1].identity_error < 1e-4 and found[0, 1].deviation is None
    one = whitening.whitened(table(spark, [[0], [1]])).collect()
    assert sorted((r.vec_id, r.whitened, r.deviation) for r in one) == [(0, -1.0, 1), (1, 1.0, 1)]


def test_query_keeps_to_valid_rows(spark, tmp_path):
    rows = [
        (1, [0.5, 1.0], 1),
        (2, [0.25, -1.0], 1),
        (3, [None, 1.0], 1),
        (4, None, 1),
        (5, [float("nan"), 0.0], 1),
        (6, [float("inf"), 0.0], 1),
        (None, [0.0, 0.5], 1),
        (7, [1e30, 0.5], 1),
        (8, [0.5, 1.0], None),
        (8, [0.0, 0.0], 2),
    ]
    path = f"{tmp_path}/embeddings.parquet"
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(path)
    found = whitening.op12_whitening(spark, str(tmp_path)).collect()
    assert sorted(r.vec_id for r in found if r.component == 1) == [1, 2, 8, 8]
    assert {r.n for r in found} == {3}
