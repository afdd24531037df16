"""Learned inverted file: exact when every cell is opened, blocks and salts of any size, recall on the given vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxgauge.catalog import QUERIES
from voxgauge.operators import ivf


def exact(vectors, k=5):
    ids = np.array([i for i, v in vectors if v is not None and np.all(np.isfinite(v)) and np.any(np.asarray(v) != 0)])
    x = np.array([v for i, v in vectors if i in set(ids)], float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = np.round(1 - u @ u.T, 9)
    np.fill_diagonal(d, np.inf)
    out = {}
    for a, row in zip(ids, d):
        order = np.lexsort((ids, row))[:k]
        out[a] = [(int(ids[j]), round(float(row[j]), 6)) for j in order if np.isfinite(row[j])]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.question_id, r.rank)):
        out.setdefault(r.question_id, []).append((r.review_id, round(r.distance, 6)))
    return out


@pytest.mark.parametrize("block, question_block, shortlist", [(4096, 2048, 50), (7, 5, 1000)])
def test_all_cells_open_is_exact(spark, monkeypatch, block, question_block, shortlist):
    monkeypatch.setattr(ivf, "BLOCK", block)
    monkeypatch.setattr(ivf, "QUESTION_BLOCK", question_block)
    rng = np.random.default_rng(2)
    vectors = [(i, [float(c) for c in rng.standard_normal(8)]) for i in range(120)]
    vectors += [(500, None), (501, [0.0] * 8), (502, [float("nan")] + [1.0] * 7), (503, vectors[3][1])]  # a copy ties
    df = spark.createDataFrame(vectors, "review_id long, embedding array<double>")
    index = ivf.build(spark, df, cells=6)
    asked = df.select(F.col("review_id").alias("question_id"), "embedding", F.col("review_id").alias("skip"))
    got = found(ivf.search(spark, index, asked, k=5, probes=6, shortlist=shortlist).collect())
    assert got == exact(vectors)


def test_product_codes_shortlist_keeps_most(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((10, 16))
    vectors = [(i, [float(c) for c in centres[i % 10] + 0.3 * rng.standard_normal(16)]) for i in range(1500)]
    df = spark.createDataFrame(vectors, "review_id long, embedding array<double>")
    index = ivf.build(spark, df, cells=10)
    asked = df.filter("review_id % 10 = 0").select(F.col("review_id").alias("question_id"), "embedding", F.col("review_id").alias("skip"))
    got = found(ivf.search(spark, index, asked, k=5, probes=3, shortlist=20).collect())
    truth = exact(vectors)
    hits = sum(len({a for a, _ in got.get(q, [])} & {a for a, _ in truth[q]}) for q in got)
    assert hits / (5 * len(got)) >= 0.9 and len(got) == 150


def test_empty_questions(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "review_id long, embedding array<double>")
    index = ivf.build(spark, df)
    none = df.limit(0).select(F.col("review_id").alias("question_id"), "embedding")
    assert ivf.search(spark, index, none).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_registered_query_recall(spark, sf):
    got = {(r.question_id, r.review_id) for r in QUERIES["knn_ivf"](spark, sf).collect()}
    truth = {(r.question_id, r.review_id) for r in QUERIES["knn_top5"](spark, sf).collect()}
    assert len(got & truth) / len(truth) >= 0.9
