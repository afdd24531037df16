"""Whitening of embeddings by the leading eigenvectors of their covariance, found by Jacobi-Davidson.

Rows are (vec_id, embedding). A row whose vector is null or empty, or holds a null or non-finite entry, or one whose
integer below does not fit in a long (|c| above 2^50), takes no part. Each entry c, as double, becomes the integer
x = floor(SCALE * c) + OFFSET; a vector shorter than the longest is read with zeros after its end. Over the n remaining
rows with per-dimension sums S the covariance is V = sum (x - S/n)(x - S/n)' / n.

V is never formed. Every product V W for a block W is one distributed pass over the written integer rows: per partition
D' (D W) with D = n x - S, exact integers in doubles, summed by cell and divided by n^3. Around it the driver runs a
block Jacobi-Davidson method: Rayleigh-Ritz on the search space, residuals r = V u - theta u, the projected correction
equation (I - P P')(V - theta I)(I - P P') t = -r (P: locked vectors and u) solved for the whole block by MINRES in
lockstep, one pass a step, the corrections orthogonalised into the search space. A pair is locked and leaves the space
once its residual is below RESIDUAL times the largest eigenvalue, double precision up to the rounding of the sums;
the method raises if that is not reached within OUTER iterations. The driver holds only d x (search space) numbers.

Components are numbered from 1 by falling eigenvalue e, up to ``components``; one whose eigenvalue is zero to that
precision (rank-deficient data) cannot be whitened and is not returned. Signs are fixed so that the largest entry of
each eigenvector is positive. No rows: no components and an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from voxgauge.llm.shared import stored

#: Fixed values of the contract: entries become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
RESIDUAL = 1e-12
OUTER, INNER = 40, 12
#: Extra search directions beside the wanted ones, and the search space at most, in multiples of the wanted.
EXTRA, SPACE = 8, 3
LIMIT = float(1 << 50)


def integer_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, x: array<long>) for the usable rows, padded with OFFSET to the longest length."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LIMIT))
    rows = vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("c")
    ).filter(fine)
    return rows.select("vec_id", F.transform("c", lambda c: (F.floor(c * SCALE) + OFFSET).cast("long")).alias("x"))


def _padded(x: pa.Array, width: int) -> np.ndarray:
    sizes = np.diff(x.offsets.to_numpy())
    values = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.full((len(x), width), float(OFFSET))
    rows = np.repeat(np.arange(len(x)), sizes)
    cols = np.arange(len(values)) - np.repeat(x.offsets.to_numpy()[:-1], sizes)
    out[rows, cols] = values
    return out


class Centred:
    """Products of the covariance with blocks of vectors, each one pass over the written rows."""

    def __init__(self, rows: DataFrame, n: int, sums: list[int], width: int):
        self.rows, self.n, self.sums, self.width, self.passes = rows, n, sums, width, 0

    def __call__(self, w: np.ndarray) -> np.ndarray:
        n, width, b = self.n, self.width, w.shape[1]
        s = np.array([float(v) for v in self.sums])
        block = w.copy()

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((width, b))
            for batch in batches:
                if batch.num_rows:
                    d = _padded(batch.column(0), width) * n - s  # exact integers
                    total += d.T @ (d @ block)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * b)), pa.array(total.ravel())], ["cell", "value"])

        cells = self.rows.select("x").mapInArrow(partial, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
        out = np.zeros(width * b)
        for cell, value in cells.collect():  # width x b numbers
            out[cell] = value
        self.passes += 1
        return out.reshape(width, b) / (float(n) ** 3)


def _orthonormal(w: np.ndarray, against: np.ndarray, floor: float = 1e-10) -> np.ndarray:
    """Columns of ``w`` made orthonormal to ``against`` and to one another (twice), nearly dependent ones left out."""
    kept = []
    basis = against
    for j in range(w.shape[1]):
        v = w[:, j].copy()
        scale = np.linalg.norm(v)
        for _ in range(2):
            if basis.shape[1]:
                v -= basis @ (basis.T @ v)
        if scale > 0 and np.linalg.norm(v) > floor * scale:
            v /= np.linalg.norm(v)
            kept.append(v)
            basis = np.column_stack([basis, v])
    return np.array(kept).T if kept else np.zeros((w.shape[0], 0))


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, tol: float = 1e-3) -> np.ndarray:
    """Solves the symmetric systems A x_j = b_j of all columns at once by MINRES; ``apply`` takes and gives blocks."""
    cols = b.shape[1]
    x = np.zeros_like(b)
    beta1 = np.linalg.norm(b, axis=0)
    live = beta1 > 0
    safe = lambda a: np.where(np.abs(a) > 0, a, 1.0)
    r1, r2, y = b.copy(), b.copy(), b.copy()
    oldb, beta = np.zeros(cols), beta1.copy()
    dbar, epsln, phibar = np.zeros(cols), np.zeros(cols), beta1.copy()
    cs, sn = -np.ones(cols), np.zeros(cols)
    w, w2 = np.zeros_like(b), np.zeros_like(b)
    for itn in range(steps):
        if not live.any():
            break
        v = y / safe(beta)
        y = apply(v)
        if itn:
            y = y - (beta / safe(oldb)) * r1
        alfa = (v * y).sum(axis=0)
        y = y - (alfa / safe(beta)) * r2
        r1, r2 = r2, y
        oldb, beta = beta, np.linalg.norm(y, axis=0)
        oldeps = epsln
        delta = cs * dbar + sn * alfa
        gbar = sn * dbar - cs * alfa
        epsln, dbar = sn * beta, -cs * beta
        gamma = np.maximum(np.hypot(gbar, beta), 1e-300)
        cs, sn = gbar / gamma, beta / gamma
        phi, phibar = cs * phibar, sn * phibar
        w1, w2 = w2, w
        w = (v - oldeps * w1 - delta * w2) / gamma
        x = x + np.where(live, phi, 0.0) * w
        live &= (np.abs(phibar) > tol * beta1) & (beta > 0)
    return x


def jacobi_davidson(apply: Callable[[np.ndarray], np.ndarray], width: int, wanted: int, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenpairs (values falling, unit vectors as columns) of the symmetric operator ``apply``."""
    wanted = min(wanted, width)
    if wanted == 0:
        return np.zeros(0), np.zeros((width, 0))
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((width, 0)), []
    q = _orthonormal(rng.standard_normal((width, min(width, wanted + EXTRA))), locked)
    aq = apply(q)
    top = 0.0
    for _ in range(OUTER):
        h = q.T @ aq
        theta, y = np.linalg.eigh((h + h.T) / 2)
        order = np.argsort(-theta)
        theta, y = theta[order], y[:, order]
        u, au = q @ y, aq @ y
        r = au - u * theta
        r -= locked @ (locked.T @ r)
        top = max(top, abs(theta[0]) if len(theta) else 0.0, *(abs(v) for v in values))
        norms = np.linalg.norm(r, axis=0)
        need = wanted - len(values)
        done = 0
        while done < min(need, len(theta)) and norms[done] <= RESIDUAL * max(top, 1e-300):
            done += 1
        if done:
            locked = np.column_stack([locked, u[:, :done]])
            values += list(theta[:done])
            u, au, theta, r = u[:, done:], au[:, done:], theta[done:], r[:, done:]
        if len(values) >= wanted:
            break
        if locked.shape[1] + u.shape[1] >= width:  # the space is whole: Rayleigh-Ritz is exact up to rounding
            rest = wanted - len(values)
            if np.linalg.norm(r[:, :rest], axis=0).max() <= RESIDUAL * max(top, 1e-300) * 100:
                locked = np.column_stack([locked, u[:, :rest]])
                values += list(theta[:rest])
                break
        block = min(wanted - len(values), u.shape[1])
        ub, tb, rb = u[:, :block], theta[:block], r[:, :block]

        def projected(t: np.ndarray, ub=ub, tb=tb) -> np.ndarray:
            def out(z: np.ndarray) -> np.ndarray:
                z = z - locked @ (locked.T @ z)
                return z - ub * (ub * z).sum(axis=0)

            t = out(t)
            return out(apply(t) - t * tb)

        t = minres(projected, -(rb - ub * (ub * rb).sum(axis=0)), INNER)
        keep = min(u.shape[1], max(wanted - len(values) + EXTRA, block))
        q, aq = u[:, :keep], au[:, :keep]
        if q.shape[1] + block > min(width - locked.shape[1], SPACE * wanted + EXTRA):
            q, aq = u[:, :block], au[:, :block]
        fresh = _orthonormal(t, np.column_stack([locked, q]))
        if fresh.shape[1] == 0:
            fresh = _orthonormal(rng.standard_normal((width, block)), np.column_stack([locked, q]))
        if fresh.shape[1]:
            q, aq = np.column_stack([q, fresh]), np.column_stack([aq, apply(fresh)])
    else:
        raise RuntimeError(f"Jacobi-Davidson: {len(values)} of {wanted} eigenpairs converged in {OUTER} iterations")
    values = np.array(values)
    order = np.argsort(-values, kind="stable")
    vectors = locked[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[order], vectors * np.where(signs == 0, 1, signs)


def whiten(spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained, eigenvalue, identity_error.

    ``deviation`` is sum over dimensions of (n x - S)^2, exact (it raises if it leaves a long); ``whitened`` the centred
    row projected on the component over sqrt(e); ``explained`` e / trace(V); ``identity_error`` one value for the run,
    the largest absolute entry of the covariance of the whitened columns minus the identity. Extra columns of
    ``vectors`` are ignored; repeated rows count as often as they occur.
    """
    rows = stored(spark, "whiten-rows", integer_rows(vectors))
    dims = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.sum(F.col("v").cast("decimal(38,0)") * F.col("v")).alias("q")
    )
    n = rows.count()
    got = sorted((int(i), int(s), int(q)) for i, s, q in dims.collect())  # one row per dimension
    width = len(got)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, eigenvalue double, identity_error double"
    if n == 0 or width == 0:
        return spark.createDataFrame([], schema)
    # dimensions a short row does not reach count its padding value OFFSET
    reach = dict(rows.select(F.explode(F.sequence(F.lit(0), F.size("x") - 1)).alias("i")).groupBy("i").count().collect())
    sums = [s + OFFSET * (n - reach.get(i, 0)) for i, s, _ in got]
    squares = [q + OFFSET * OFFSET * (n - reach.get(i, 0)) for i, _, q in got]
    trace = sum(Fraction(n * q - s * s, n * n) for s, q in zip(sums, squares))
    values, basis = jacobi_davidson(Centred(rows, n, sums, width), width, components)
    positive = values > RESIDUAL * max(float(values[0]) if len(values) else 0.0, 1e-300) * width
    values, basis = values[positive], basis[:, positive]
    k = len(values)
    if k == 0:
        return spark.createDataFrame([], schema)
    explained = [float(Fraction(float(e)) / trace) if trace else 0.0 for e in values]
    scaled = basis / np.sqrt(values)
    s = np.array([float(v) for v in sums])

    def whitened_of(x: pa.Array) -> np.ndarray:
        return (_padded(x, width) * n - s) @ scaled / n

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            if batch.num_rows:
                w = whitened_of(batch.column(0))
                total += w.T @ w
                first += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k + k)), pa.array(np.concatenate([total.ravel(), first]))], ["cell", "value"])

    cells = rows.select("x").mapInArrow(moments, "cell long, value double").groupBy("cell").agg(F.sum("value")).collect()
    summed = np.zeros(k * k + k)
    for cell, value in cells:  # k x k + k numbers
        summed[cell] = value
    mean = summed[k * k :] / n
    cov = summed[: k * k].reshape(k, k) / n - np.outer(mean, mean)
    error = float(np.abs(cov - np.eye(k)).max())

    big = lambda v: F.lit(v).cast("decimal(38,0)")
    full = F.concat("x", F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(width) - F.size("x")))
    centred = F.zip_with(full, F.array(*[big(v) for v in sums]), lambda x, t: x.cast("decimal(38,0)") * big(n) - t)
    deviation = F.aggregate(centred, big(0), lambda acc, v: acc + v * v).cast("long")

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                w = whitened_of(batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), k)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                        pa.array(np.repeat(batch.column(2).to_numpy(zero_copy_only=False), k)),
                        pa.array(w.ravel()),
                    ],
                    ["vec_id", "component", "deviation", "whitened"],
                )

    out = rows.select("vec_id", "x", deviation.alias("deviation")).mapInArrow(
        project, "vec_id long, component int, deviation long, whitened double"
    )
    facts = spark.createDataFrame(
        [(i + 1, float(values[i]), explained[i]) for i in range(k)], "component int, eigenvalue double, explained double"
    )
    return out.join(F.broadcast(facts), "component").select(  # k rows
        "vec_id", "component", F.lit(n).alias("n"), "deviation", "whitened", "explained", "eigenvalue",
        F.lit(error).alias("identity_error"),
    )
