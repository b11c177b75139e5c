"""op11 against numpy's own eigensolver, exact integers, and small odd tables."""

import math

import numpy as np
import pytest

from tessera.llm import whitening


def brute(vectors):
    """(rows kept, fit list, covariance) by the contract, in plain Python."""
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    f = np.array(fit, float) - np.array(fit, float).mean(0)
    return kept, fit, f.T @ f / len(fit)


@pytest.mark.parametrize("matrix", [
    np.diag([3.0, 3.0, 2.0, 1.0]),
    np.ones((5, 5)),
    np.eye(6),
    np.array([[4.0]]),
    np.array([[2.0, 1.0], [1.0, 2.0]]),
    (lambda m: m @ m.T)(np.random.default_rng(1).normal(size=(40, 60))),
    (lambda q: q @ np.diag([5.0] * 10 + [1.0] * 20) @ q.T)(np.linalg.qr(np.random.default_rng(2).normal(size=(30, 30)))[0]),
    (lambda q: q @ np.diag(10.0 ** -np.arange(9)) @ q.T)(np.linalg.qr(np.random.default_rng(3).normal(size=(9, 9)))[0]),
])
def test_components_are_eigenvectors(matrix):
    values, vectors = whitening.components(matrix)
    want = np.sort(np.linalg.eigvalsh(matrix))[::-1][:len(values)]
    assert len(values) == min(16, len(matrix), np.linalg.matrix_rank(matrix))
    np.testing.assert_allclose(values, want, rtol=1e-6, atol=1e-13 * want[0])
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    np.testing.assert_allclose(matrix @ vectors, vectors * values, atol=1e-12 * want[0] * len(matrix))


def test_sturm_counts():
    diagonal, off = np.array([1.0, 2.0, 3.0, 4.0]), np.array([0.5, 0.0, 0.7])
    full = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    at = np.linspace(-1, 6, 50)
    want = [(np.linalg.eigvalsh(full) < a).sum() for a in at]
    assert whitening.below(diagonal, off, at).tolist() == want


def test_whole_table_against_brute_force(spark):
    random = np.random.default_rng(5)
    base = random.normal(size=(300, 20)) * np.linspace(2, 0.2, 20)
    vectors = [(i, base[i % 250].tolist()) for i in range(300)]  # repeated vectors
    vectors += [(7, base[3].tolist()), (None, base[4].tolist())]  # repeated and null ids
    vectors += [(400, None), (401, [None] * 20), (402, [float("nan")] * 20), (403, [float("inf")] + [0.0] * 19), (404, []), (405, [1.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").selectExpr("*", "1 as n", "'x' as component")
    got = whitening.whiten(df).collect()
    kept, fit, v = brute([r for r in vectors if r[1] is not None and len(r[1]) == 20])
    assert len(got) == len(kept) * 16
    s = [sum(c) for c in zip(*fit)]
    values, vectors_ = np.linalg.eigh(v)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    n = len(fit)
    of = {}
    for r in got:
        of.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    sign = None
    for i, x in kept:
        rows = of[(i, sum((n * a - b) ** 2 for a, b in zip(x, s)))]
        mine = np.array([rows[j].whitened for j in range(1, 17)])
        want = ((np.array(x) - np.array(s) / n) @ vectors_[:, :16]) / np.sqrt(values[:16])
        sign = np.sign(mine * want) if sign is None else sign
        np.testing.assert_allclose(mine * sign, want, atol=1e-7)
        assert all(r.n == n and r.identity_error < 1e-9 for r in rows.values())
        np.testing.assert_allclose([rows[j].explained for j in range(1, 17)], values[:16] / np.trace(v), rtol=1e-9)


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])]])
def test_tables_without_components(spark, vectors):
    got = whitening.whiten(spark.createDataFrame(vectors, "vec_id long, embedding array<float>"))
    assert got.collect() == []
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_huge_entries_stay_exact_or_null(spark):
    vectors = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])]
    got = whitening.whiten(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: r.deviation for r in got}[1] is None
    assert all(math.isfinite(r.whitened) for r in got)
