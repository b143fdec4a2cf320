"""Whitening against dense eigenvectors."""

import math

import numpy as np
import pytest

from panelforge.llm import whitening as W

EPS = np.finfo(float).eps


def symmetric(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0]
    return (q * values) @ q.T


@pytest.mark.parametrize(
    "values, wanted",
    [
        (np.linspace(1, 50, 400) ** 2, 10),
        (np.r_[np.full(7, 9.0), np.full(20, 4.0), np.full(273, 1.0)], 12),
        (np.r_[1e6, 1e3, np.linspace(0.9, 1, 198)], 6),
        (np.linspace(1, 2, 30), 30),
        (np.array([3.0]), 5),
        (np.r_[5.0, 2.0, np.zeros(60)], 4),
    ],
)
def test_eigenpairs(values, wanted):
    a, calls = symmetric(values), []
    theta, q = W.eigenpairs(lambda u: calls.append(u.shape[1]) or a @ u, len(values), wanted, 2 * EPS * (len(values) + 20))
    k = min(wanted, len(values))
    assert np.allclose(theta, np.sort(values)[::-1][:k], rtol=1e-11, atol=1e-11 * values.max())
    assert np.linalg.norm(a @ q - q * theta) <= 1e-11 * values.max()
    assert np.allclose(q.T @ q, np.eye(k), atol=1e-12)


def test_minres_solves():
    a = symmetric(np.linspace(-1, 3, 40))
    b = np.random.default_rng(2).normal(size=(40, 3))
    assert np.allclose(a @ W.minres(lambda t: a @ t, b, 200, 1e-12), b, atol=1e-8)


def got(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return W.whitened(df, **more).collect()


def brute(vectors):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    return x, ((n * x - s) ** 2).sum(axis=1), c, e[::-1], q[:, ::-1]


def test_against_dense(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(400, 24)) * np.linspace(1, 4, 24) + rng.normal(size=24) * 20).tolist()
    bad = [(1000, None), (1001, [*vectors[0][:-1], None]), (1002, [*vectors[0][:-1], math.nan]), (1003, [*vectors[0][:-1], math.inf]), (1004, []), (1005, [1.0] * 23)]
    rows = [*enumerate(vectors), *bad, (None, vectors[5]), (6, vectors[6])]
    every = vectors + [vectors[5], vectors[6]]
    x, deviation, c, e, q = brute(every)
    out = got(spark, rows, components=8)
    assert len(out) == 8 * len(every) and {r.n for r in out} == {len(every)}
    by = {}
    for r in out:
        by.setdefault((r.vec_id, r.component), []).append(r)
    assert len(by[None, 1]) == 1 and len(by[6, 1]) == 2 and (1004, 1) not in by
    for i in (0, 5, 399):
        z = c[i] @ q[:, :8] / np.sqrt(e[:8])
        mine = np.array([by[i, k][0].whitened for k in range(1, 9)])
        assert np.allclose(np.abs(mine), np.abs(z), atol=1e-8)
        assert by[i, 1][0].deviation == deviation[i]
    assert np.allclose([by[0, k][0].explained for k in range(1, 9)], e[:8] / e.sum(), rtol=1e-10)
    assert {r.identity_error for r in out} == {out[0].identity_error} and out[0].identity_error < 1e-9


def test_few_dimensions_and_no_variance(spark):
    rows = [(i, [float(i % 3), 5.0, float(i)]) for i in range(30)]
    out = got(spark, rows)
    assert {r.component for r in out} == {1, 2} and len(out) == 60  # the constant dimension has no variance
    z = np.array([[r.whitened for r in out if r.component == k] for k in (1, 2)])
    assert np.allclose(z @ z.T / 30, np.eye(2), atol=1e-9)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_no_rows(spark, rows):
    assert got(spark, rows) == []


def test_clashing_columns(spark):
    rows = [(i, [float(i), float(i * i % 7)], 1, 2, 3) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x int, n int, component int")
    assert W.whitened(df).count() == 18
