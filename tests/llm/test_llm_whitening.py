"""Whitening by Jacobi-Davidson against numpy's eigendecomposition."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxgauge.llm import whitening
from voxgauge.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(vectors):
    usable = [v for v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(v) for v in usable)
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for v in usable], float)
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    return x, n, s, e[::-1], u[:, ::-1]


def test_jacobi_davidson_equals_numpy():
    rng = np.random.default_rng(3)
    for d, m in [(64, 400), (30, 10), (5, 200)]:
        a = rng.standard_normal((m, d)) * rng.uniform(0.1, 2, d)
        v = np.cov(a.T, bias=True)
        values, vectors = whitening.jacobi_davidson(lambda w, v=v: v @ w, d, 32)
        want = np.linalg.eigvalsh(v)[::-1][: len(values)]
        assert np.allclose(values, want, rtol=0, atol=1e-12 * want[0])
        assert np.abs(v @ vectors - vectors * values).max() < 1e-11 * want[0]
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)


def test_whitening_against_numpy_with_odd_rows(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(c) for c in rng.standard_normal(6) * [3, 1, 0.5, 2, 1, 0.2]]) for i in range(60)]
    vectors += [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (102, [float("nan")] * 6), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (104, [])]
    vectors += [(5, vectors[5][1]), (106, [0.5, 0.25])]  # a repeated row and a short one, read with zeros after its end
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("component", F.lit("clash"))
    got = whitening.whiten(spark, df, components=4).collect()
    x, n, s, e, u = brute([v for _, v in vectors])
    assert n == 62 and {r.n for r in got} == {n}
    ids = [i for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    for comp in range(1, 5):
        rows = sorted((r for r in got if r.component == comp), key=lambda r: (r.vec_id, r.whitened))
        want = sorted(zip(ids, (x - s / n) @ u[:, comp - 1] / math.sqrt(e[comp - 1])))
        mine = np.array([r.whitened for r in rows])
        plain = np.array([w for _, w in want])
        assert [r.vec_id for r in rows] == [i for i, _ in want]
        assert min(np.abs(mine - plain).max(), np.abs(mine + plain).max()) < 1e-9
        assert rows[0].explained == pytest.approx(e[comp - 1] / e.sum(), rel=1e-9)
    deviation = {r.vec_id: r.deviation for r in got}
    for i, row in zip(ids, x):
        assert deviation[i] == int(((row * n - s) ** 2).sum())
    assert got[0].identity_error < 1e-9


def test_rank_deficient_and_empty(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert whitening.whiten(spark, same).count() == 0  # no variance: nothing can be whitened
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], "vec_id long, embedding array<float>")
    got = whitening.whiten(spark, line).collect()
    assert {r.component for r in got} == {1} and len(got) == 5
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whiten(spark, empty).count() == 0


def test_registered_query(spark):
    got = QUERIES["op12_embedding_whitening"](spark, SF).collect()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    x, n, s, e, u = brute([list(v) for v in rows.embedding])
    assert len(got) == n * min(32, len(e))
    assert max(r.identity_error for r in got) < 1e-4
    first = sorted((r for r in got if r.component == 1), key=lambda r: r.vec_id)
    want = (x - s / n) @ u[:, 0] / math.sqrt(e[0])
    mine = np.array([r.whitened for r in first])
    assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-8
