"""Whitening against numpy's dense eigenvectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import whitening as W
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.registry import table

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
SCHEMA = "vec_id long, embedding array<float>"


def dense(vectors):
    x = np.array([[math.floor(256 * float(c)) for c in v] for v in vectors], dtype=np.int64)
    fit = np.unique(x, axis=0)
    values, e = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(x.shape[1], -1))
    return x, fit, values[::-1], e[:, ::-1]


def check(rows, vectors, ids, components=4, tolerance=1e-9):
    x, fit, values, e = dense(vectors)
    n, sums = len(fit), fit.sum(axis=0)
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    assert len(rows) == k * len(ids)
    want = (x - sums / n) @ e[:, :k] / np.sqrt(values[:k])
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    at = {i: p for p, i in enumerate(ids)}
    got = np.zeros_like(want)
    for r in rows:
        got[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviation[at[r.vec_id]]
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-10)
        assert 0 <= r.identity_error < 1e-10
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got * signs - want).max() < tolerance


def test_query_on_given_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = table(spark, folder, "embeddings").collect()
    got = QUERIES["op11_whitening"](spark, folder)
    assert got.columns == COLUMNS
    check(got.collect(), [r.embedding for r in rows], [r.vec_id for r in rows])


def cloud(seed, n, d):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * np.linspace(3, 0.5, d) + 2).astype(np.float32)


def test_copies_count_once(spark):
    x = cloud(1, 60, 6)
    vectors = [*x, *[x[0]] * 100]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], SCHEMA).repartition(7)
    check(W.whiten(df).collect(), vectors, list(range(len(vectors))))


def test_odd_rows(spark):
    x = cloud(2, 40, 5)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [float("nan")] * 5), (103, [float("inf")] + [0.0] * 4), (104, [1.0]), (105, []), (106, [-float("inf")] * 5)]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    for name in ("x", "n", "component", "y", "i"):
        df = df.withColumn(name, F.lit("clash"))
    check(W.whiten(df).collect(), x, list(range(40)))
    assert {r.vec_id for r in W.whiten(spark.createDataFrame([*rows, (None, rows[0][1])], SCHEMA)).collect()} == {None, *range(40)}


def test_fewer_components_than_asked(spark):
    x = cloud(3, 30, 2)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    check(W.whiten(df).collect(), x, list(range(30)))
    flat = [np.array([a, 2 * a, -a, 0], np.float32) for a in range(20)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(flat)], SCHEMA)
    check(W.whiten(df).collect(), flat, list(range(20)))


def test_nothing_to_fit(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        got = W.whiten(spark.createDataFrame(rows, SCHEMA))
        assert got.columns == COLUMNS and got.collect() == []


def test_deviation_too_large_is_an_error(spark):
    df = spark.createDataFrame([(i, [float(i) * 1e13, 0.0]) for i in range(4)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="OVERFLOW|OUT_OF_RANGE|out of range|cannot be represented"):
        W.whiten(df).collect()


@pytest.mark.parametrize("d, want", [(1, 4), (3, 4), (40, 4), (120, 6)])
def test_leading_pairs(d, want):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(3 * d, d))
    a = a.T @ a / d
    values, vectors = W.leading_pairs(lambda v: a @ v, d, want)
    exact, e = np.linalg.eigh(a)
    k = min(d, want)
    assert np.allclose(values, exact[::-1][:k], rtol=1e-13)
    residual = np.linalg.norm(a @ vectors - vectors * values, axis=0)
    assert residual.max() <= 20 * np.sqrt(d) * np.finfo(float).eps * values[0]
    assert np.allclose(np.abs((vectors * e[:, ::-1][:, :k]).sum(axis=0)), 1, atol=1e-12)


def test_equal_eigenvalues():
    a = np.diag([5.0, 5, 5, 5, 5, 1, 0, 0])
    values, vectors = W.leading_pairs(lambda v: a @ v, 8, 4)
    assert np.allclose(values, 5, rtol=1e-14)
    assert np.allclose(vectors.T @ vectors, np.eye(4), atol=1e-13)


def test_minres_solves():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(12, 12))
    a = a + a.T
    shifts, b = np.array([0.3, -2.0, 1.1]), rng.normal(size=(12, 3))
    x = W.minres(lambda v, which: a @ v - shifts[which] * v, b, 1e-12, 60)
    assert np.allclose(a @ x - shifts * x, b, atol=1e-8)
