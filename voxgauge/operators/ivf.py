"""Approximate k nearest by cosine: a learned inverted file with product-quantised residuals and exact re-ranking.

Training: spherical k-means of the unit vectors into ``cells`` centroids, each Lloyd round one pass over the fitting
rows that sums vectors per cell inside each partition; then, on the residuals x - c(x), a codebook of CODES words for
each of SUBSPACES slices of the coordinates, trained the same way. The fitting rows are at most ``fit_rows`` chosen by
hash of the id; the driver holds only centroids and codebooks (cells x d + CODES x d numbers).

Index: every usable vector (not null, not zero, all entries finite) gets its cell, its residual code (one byte a slice)
and its unit vector, written in the shared folder partitioned by cell, a large cell spread over salts of at most
BLOCK vectors.

Probe: each question opens the ``probes`` cells of the nearest centroids. The index is read for the probed cells only
(a semi join on the partition column, which the planner turns into partition pruning), questions and vectors of a
cell meet in blocks of at most QUESTION_BLOCK x BLOCK, where the residual codes give approximate distances by tables
of the question's slice distances; the best ``shortlist`` of each block are re-ranked on the exact unit vectors in
double precision, and the k best of all blocks kept, ties to the smaller id. Recall depends on ``probes``; the
registered query states what it reaches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from voxgauge.session import shared_path

SUBSPACES, CODES = 8, 256
ROUNDS = 10
FIT_ROWS = 50_000
BLOCK, QUESTION_BLOCK = 4096, 2048
MAX_CELLS = 1 << 16


@dataclass
class Index:
    path: str
    centroids: np.ndarray
    codebooks: np.ndarray  # SUBSPACES x CODES x slice width (zero-padded)
    widths: list[int]
    rows: int
    id_type: str = "bigint"


def usable(corpus: DataFrame) -> DataFrame:
    """(review_id, embedding: array<double>) with an id and a finite vector that is not zero."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return corpus.filter(F.col("review_id").isNotNull() & F.col("embedding").isNotNull()).select(
        "review_id", v.alias("embedding")
    ).filter(fine)


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    if len(column) and np.any(sizes != dim):
        raise ValueError(f"vectors must all have {dim} elements")
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _bounds(dim: int) -> list[tuple[int, int]]:
    edges = np.linspace(0, dim, min(SUBSPACES, dim) + 1).round().astype(int)
    return list(zip(edges[:-1], edges[1:]))


def _lloyd(rows: DataFrame, dim: int, start: np.ndarray, assign, spherical: bool) -> np.ndarray:
    """Rounds of Lloyd's method for several problems at once (``start``: problems x centres x width); every round
    one pass that sums the points of each centre within each partition."""
    centres = start.copy()
    groups, count_c, width = centres.shape
    for _ in range(ROUNDS):
        held = centres.copy()

        def sums(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros((groups * count_c, width)), np.zeros(groups * count_c)
            for batch in batches:
                if batch.num_rows:
                    parts = assign.points(batch.column(0), dim)
                    for g, x in enumerate(parts):
                        own = assign.nearest(x, held[g, :, : x.shape[1]]) + g * count_c
                        np.add.at(total[:, : x.shape[1]], own, x)
                        count += np.bincount(own, minlength=len(count))
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(used, width + 1)), pa.array(np.tile(np.arange(width + 1), len(used))),
                 pa.array(np.column_stack([total[used], count[used]]).ravel())],
                ["centre", "slot", "value"],
            )

        summed = rows.mapInArrow(sums, "centre long, slot long, value double").groupBy("centre", "slot").agg(F.sum("value").alias("value"))
        grid = np.zeros((groups * count_c, width + 1))
        for centre, slot, value in summed.collect():  # problems x centres x (width + 1) numbers
            grid[centre, slot] = value
        flat = centres.reshape(groups * count_c, width)
        filled = grid[:, -1] > 0
        flat[filled] = grid[filled, :-1] / grid[filled, -1:]
        if spherical:
            flat[filled] /= np.maximum(np.linalg.norm(flat[filled], axis=1, keepdims=True), 1e-300)
        centres = flat.reshape(groups, count_c, width)
    return centres


class _Cells:
    @staticmethod
    def points(column, dim):
        return [_unit(column, dim)]

    @staticmethod
    def nearest(x, centres):
        return (x @ centres.T).argmax(axis=1)


class _Slices:
    """Residuals to the nearest centroid, cut into the slices of the codebooks."""

    def __init__(self, centroids: np.ndarray, bounds: list[tuple[int, int]]):
        self.centroids, self.bounds = centroids, bounds

    def points(self, column, dim):
        x = _unit(column, dim)
        residual = x - self.centroids[(x @ self.centroids.T).argmax(axis=1)]
        return [residual[:, lo:hi] for lo, hi in self.bounds]

    @staticmethod
    def nearest(x, centres):
        return ((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :]).argmin(axis=1)


def build(spark: SparkSession, corpus: DataFrame, cells: int | None = None, fit_rows: int = FIT_ROWS) -> Index:
    """Trains the cells and codebooks and writes the index of every usable row of ``corpus`` (review_id, embedding)."""
    rows = usable(corpus)
    first = rows.select(F.size("embedding")).first()
    dim = first[0] if first else 0
    n = rows.count()
    cells = int(np.clip(cells or round(np.sqrt(n)), 1, MAX_CELLS))
    dice = F.pmod(F.xxhash64("review_id"), F.lit(1 << 31))
    fitting = rows.where(dice < int((1 << 31) * min(1.0, 2 * fit_rows / max(n, 1)))).orderBy(dice, "review_id").limit(fit_rows)
    fitting = _stored(spark, "ivf-fit", fitting.select("embedding"))
    seeds = np.array([r[0] for r in fitting.limit(cells).collect()], np.float64).reshape(-1, dim)  # cells rows
    seeds /= np.linalg.norm(seeds, axis=1, keepdims=True)
    cells = len(seeds)
    centroids = _lloyd(fitting, dim, seeds[None], _Cells, spherical=True)[0]
    bounds = _bounds(dim)
    width = max(hi - lo for lo, hi in bounds)
    slicer = _Slices(centroids, bounds)
    first = np.array([r[0] for r in fitting.limit(CODES).collect()], np.float64).reshape(-1, dim)  # CODES rows
    parts = slicer.points(pa.array(first.tolist(), pa.list_(pa.float64())), dim)
    rng = np.random.default_rng(7)
    start = np.zeros((len(bounds), CODES, width))
    for m, part in enumerate(parts):
        if len(part) < CODES:  # fewer rows than codes: the rest start near them
            part = np.concatenate([part, part[rng.integers(0, len(part), CODES - len(part))] + rng.normal(0, 1e-6, (CODES - len(part), part.shape[1]))])
        start[m, :, : part.shape[1]] = part
    books = _lloyd(fitting, dim, start, slicer, spherical=False)
    id_type = rows.schema["review_id"].dataType.simpleString()
    index = Index(shared_path(spark, "ivf"), centroids, books, [hi - lo for lo, hi in bounds], n, id_type)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(batch.column(1), dim)
            own = (x @ centroids.T).argmax(axis=1)
            residual = x - centroids[own]
            codes = np.empty((len(x), len(bounds)), np.uint8)
            for m, (lo, hi) in enumerate(bounds):
                codes[:, m] = _Slices.nearest(residual[:, lo:hi], books[m, :, : hi - lo])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array([v.tobytes() for v in x], pa.binary())],
                ["review_id", "cell", "code", "unit"],
            )

    coded = _stored(spark, "ivf-coded", rows.mapInArrow(encode, f"review_id {id_type}, cell int, code binary, unit binary"))
    sizes = coded.groupBy("cell").count().withColumn("salts", F.ceil(F.col("count") / BLOCK))  # one row per cell
    salted = coded.join(F.broadcast(sizes.select("cell", "salts")), "cell").withColumn(
        "salt", F.pmod(F.xxhash64("review_id"), F.col("salts")).cast("int")
    )
    salted.drop("salts").write.partitionBy("cell").parquet(index.path)
    return index


def _stored(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def search(spark: SparkSession, index: Index, questions: DataFrame, k: int = 5, probes: int = 8, shortlist: int = 50) -> DataFrame:
    """(question_id, rank, review_id, distance) of the k nearest found; questions: question_id, embedding, optional skip."""
    centroids, books, widths = index.centroids, index.codebooks, index.widths
    dim = centroids.shape[1]
    bounds = _bounds(dim)
    probes = min(probes, len(centroids))
    q_type = questions.schema["question_id"].dataType.simpleString()
    skip = F.col("skip").cast(q_type) if "skip" in questions.columns else F.lit(None).cast(q_type)
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    asked = questions.filter(F.col("question_id").isNotNull() & F.col("embedding").isNotNull() & fine).select(
        "question_id", v.alias("embedding"), skip.alias("skip")
    )

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            x = np.array(frame["embedding"].tolist(), np.float64).reshape(len(frame), dim)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            near = np.argsort(-(x @ centroids.T), axis=1, kind="stable")[:, :probes]
            yield pd.DataFrame({
                "question_id": np.repeat(frame["question_id"].to_numpy(), probes),
                "skip": np.repeat(frame["skip"].to_numpy(), probes),
                "cell": near.ravel().astype(np.int32),
                "unit": np.repeat(np.array([r.tobytes() for r in x], object), probes),
            })

    routed = asked.mapInPandas(route, f"question_id {q_type}, skip {q_type}, cell int, unit binary")
    routed = _stored(spark, "ivf-probe", routed)
    # the cell, read back from the folder names, is an int as on the question side: both sides of a group must agree
    stored_index = spark.read.schema(f"review_id {index.id_type}, code binary, unit binary, salt int, cell int").parquet(index.path)
    opened = routed.select("cell").distinct()
    vectors = stored_index.join(opened, "cell", "left_semi")  # only the probed cells' partitions are read
    v_salts = vectors.groupBy("cell").agg(F.max("salt").alias("v_salts"))
    q_count = routed.groupBy("cell").count().withColumn("q_salts", F.ceil(F.col("count") / QUESTION_BLOCK).cast("int"))
    plan = q_count.join(v_salts, "cell")  # one row per probed cell
    left = routed.join(F.broadcast(plan), "cell").select(
        "*", F.pmod(F.xxhash64("question_id"), F.col("q_salts")).cast("int").alias("q_salt"),
        F.explode(F.sequence(F.lit(0), F.col("v_salts"))).alias("salt"),
    ).drop("count", "q_salts", "v_salts")
    right = vectors.join(F.broadcast(plan), "cell").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("q_salts") - 1)).alias("q_salt")
    ).drop("count", "q_salts", "v_salts")
    schema = f"question_id {q_type}, review_id {index.id_type}, distance double"

    def meet(key, q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if q.empty or v.empty:
            return pd.DataFrame({"question_id": [], "review_id": [], "distance": []})
        cell = int(key[0])
        qx = np.frombuffer(b"".join(q["unit"]), np.float64).reshape(len(q), dim)
        vx = np.frombuffer(b"".join(v["unit"]), np.float64).reshape(len(v), dim)
        codes = np.frombuffer(b"".join(v["code"]), np.uint8).reshape(len(v), len(bounds))
        residual = qx - centroids[cell]
        approx = np.zeros((len(q), len(v)))
        for m, (lo, hi) in enumerate(bounds):
            book = books[m, :, : hi - lo]
            table = ((residual[:, None, lo:hi] - book[None]) ** 2).sum(axis=2)  # questions x codes
            approx += table[:, codes[:, m]]
        ids = v["review_id"].to_numpy()
        skips = q["skip"].to_numpy()
        approx[ids[None, :] == skips[:, None]] = np.inf
        keep = min(shortlist, len(v))
        best = np.argpartition(approx, keep - 1, axis=1)[:, :keep]
        exact = 1 - np.einsum("qd,qkd->qk", qx, vx[best])
        ok = np.isfinite(np.take_along_axis(approx, best, axis=1))
        return pd.DataFrame({
            "question_id": np.repeat(q["question_id"].to_numpy(), keep)[ok.ravel()],
            "review_id": ids[best].ravel()[ok.ravel()],
            "distance": np.round(exact.ravel()[ok.ravel()], 9),
        })

    found = left.groupBy("cell", "salt", "q_salt").cogroup(right.groupBy("cell", "salt", "q_salt")).applyInPandas(meet, schema)
    order = Window.partitionBy("question_id").orderBy("distance", "review_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("question_id", "rank", "review_id", "distance")
