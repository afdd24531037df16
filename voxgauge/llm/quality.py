"""Quality of a text by a factorisation machine over hashed words, structure statistics and metadata.

The logit is b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j, the pairs in linear time as half of the sum over the factors
of (sum_i v_i x_i)^2 - sum_i v_i^2 x_i^2. Features: words hashed into ``WORD_CELLS`` cells, weighed 1 + ln tf and scaled to
length 1; each structure statistic, and the length that the metadata state, as one of ``BINS`` bins whose edges are
quantiles of the fitted rows.

The machine is fitted on at most ``FIT_ROWS`` labelled rows, those of the smallest hash of their id: one task learns, and
what it holds is bounded by the rows and the number of features. All texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from voxgauge.llm.arrow_text import ALNUM, WordHasher, byte_slices, word_bounds
from voxgauge.llm.shared import fresh_name

#: Labelled rows that the machine is fitted on, at most.
FIT_ROWS = 8000
WORD_CELLS = 2048
BINS = 10
FACTORS = 8
EPOCHS = 15
BATCH = 128
RATE, DECAY = 0.08, 1e-5

#: Classes of bytes whose shares are statistics, in the order of their numbers.
_CLASSES = ("lower", "upper", "digit", "space", "line end", "stop", "exclamation", "bar", "other sign", "not ASCII")
_CLASS_OF = np.full(256, 8, np.int64)
_CLASS_OF[97:123], _CLASS_OF[65:91], _CLASS_OF[48:58], _CLASS_OF[128:] = 0, 1, 2, 9
for _bytes, _number in ((b" \t", 3), (b"\r\n", 4), (b".,;:'\"-()", 5), (b"!?", 6), (b"|", 7)):
    _CLASS_OF[list(_bytes)] = _number
#: Statistics: shares of the classes, log length, mean word length, share of distinct words, of words equal to the one
#: before, of the most frequent word, words a line, log stated length, stated over true length.
N_STATS = len(_CLASSES) + 8
N_FEATURES = WORD_CELLS + N_STATS * BINS


def describe(data: np.ndarray, offsets: np.ndarray, stated: np.ndarray, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """Per text the word features (length 1, or 0 without words) and the statistics. ``stated``: lengths, nan if unknown."""
    n, sizes = len(offsets) - 1, np.diff(offsets)
    doc = np.repeat(np.arange(n), sizes)
    classes = np.bincount(doc * len(_CLASSES) + _CLASS_OF[data], minlength=n * len(_CLASSES)).reshape(n, -1)
    starts, ends, bounds = word_bounds(data, offsets, ALNUM)
    words = hasher(data, starts, ends)
    counts = np.diff(bounds)
    of = np.repeat(np.arange(n), counts)
    cells = np.bincount(of * WORD_CELLS + (words % np.uint64(WORD_CELLS)).astype(np.int64), minlength=n * WORD_CELLS)
    cells = cells.reshape(n, WORD_CELLS)
    x = np.zeros(cells.shape, np.float32)
    x[cells > 0] = np.log(cells[cells > 0]) + 1
    x /= np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)
    some = np.maximum(counts, 1)
    kinds, times = np.unique((of.astype(np.uint64) << np.uint64(44)) | (words >> np.uint64(20)), return_counts=True)
    owner = (kinds >> np.uint64(44)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, owner, times)
    again = np.bincount(of[1:][(words[1:] == words[:-1]) & (of[1:] == of[:-1])], minlength=n)
    characters = np.bincount(doc[(data & 0xC0) != 0x80], minlength=n)
    stats = [
        *(classes / np.maximum(sizes, 1)[:, None]).T,
        np.log1p(sizes),
        np.bincount(of, ends - starts, minlength=n) / some,
        np.bincount(owner, minlength=n) / some,
        again / some,
        most / some,
        counts / (classes[:, 4] + 1),
        np.log1p(np.where(np.isnan(stated), -0.5, np.maximum(stated, 0))),
        np.where(np.isnan(stated), -1, np.minimum(stated / np.maximum(characters, 1), 4)),
    ]
    return x, np.stack(stats, axis=1)


def features(words: np.ndarray, stats: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Word features and one 1 per statistic, for its bin."""
    x = np.zeros((len(words), N_FEATURES), np.float32)
    x[:, :WORD_CELLS] = words
    for k in range(N_STATS):
        x[np.arange(len(x)), WORD_CELLS + k * BINS + np.searchsorted(edges[k], stats[:, k], "right")] = 1
    return x


def logits(x: np.ndarray, bias: float, w: np.ndarray, v: np.ndarray) -> np.ndarray:
    return bias + x @ w + 0.5 * (((x @ v) ** 2) - (x**2) @ (v**2)).sum(axis=1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn(words: np.ndarray, stats: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Bin edges, bias, weights and factors, by adaptive gradient steps on the log loss; the same for the same rows."""
    random = np.random.default_rng(8)
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = 0.0 if 0 < y.mean() < 1 else float(np.log(share / (1 - share)))
    w, v = np.zeros(N_FEATURES), random.normal(0, 0.02, (N_FEATURES, FACTORS))
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))  # both classes count alike, however rare one is
    sum_b, sum_w, sum_v = 1e-6, np.full(w.shape, 1e-6), np.full(v.shape, 1e-6)
    if 0 < y.mean() < 1:
        for _ in range(EPOCHS):
            order = random.permutation(len(y))
            for i in range(0, len(y), BATCH):
                rows = order[i : i + BATCH]
                x = features(words[rows].astype(np.float32), stats[rows], edges).astype(np.float64)
                xv = x @ v
                z = bias + x @ w + 0.5 * (xv**2 - (x**2) @ (v**2)).sum(axis=1)
                slope = (_sigmoid(z) - y[rows]) * weight[rows] / len(rows)
                step_b = slope.sum()
                step_w = x.T @ slope + DECAY * w
                step_v = x.T @ (xv * slope[:, None]) - v * ((x**2).T @ slope)[:, None] + DECAY * v
                sum_b, sum_w, sum_v = sum_b + step_b**2, sum_w + step_w**2, sum_v + step_v**2
                bias -= RATE * step_b / np.sqrt(sum_b)
                w -= RATE * step_w / np.sqrt(sum_w)
                v -= RATE * step_v / np.sqrt(sum_v)
    return edges, bias, w, v


class QualityModel:
    def __init__(self, edges: np.ndarray, bias: float, w: np.ndarray, v: np.ndarray):
        self.edges, self.bias, self.w, self.v = edges, bias, w, v


def _stated(column: pa.Array) -> np.ndarray:
    return np.array([np.nan if x is None else x for x in column.to_pylist()], np.float64)


def _with_stated(docs: DataFrame) -> DataFrame:
    """``n_chars`` as a number, null where the table has none."""
    return docs if "n_chars" in docs.columns else docs.withColumn("n_chars", F.lit(None).cast("double"))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> QualityModel:
    """Learns from ``docs`` (doc_id, text, n_chars) and ``labels`` (doc_id, quality: 0 or 1; others teach nothing)."""
    known = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = _with_stated(docs).join(F.broadcast(sample), "doc_id")  # fit_rows pairs of numbers
    rows = rows.select(F.col("n_chars").cast("double"), "text", F.col("quality").cast("double").alias("quality"))

    def to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(seed=4)
        for batch in batches:
            stated = _stated(batch.column(0))
            for lo, hi, data, offsets in byte_slices(batch.column(1)):
                words, stats = describe(data, offsets, stated[lo:hi], hasher)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(2).slice(lo, hi - lo),
                        pa.array([x.tobytes() for x in words.astype(np.float16)], pa.binary()),
                        pa.array([x.tobytes() for x in stats], pa.binary()),
                    ],
                    ["quality", "words", "stats"],
                )

    def to_model(table: pa.Table) -> pa.Table:
        y = table.column("quality").to_numpy()
        words = np.frombuffer(b"".join(table.column("words").to_pylist()), np.float16).reshape(len(y), -1)
        stats = np.frombuffer(b"".join(table.column("stats").to_pylist())).reshape(len(y), -1)
        order = np.lexsort((*stats.T, y))  # whatever the order in which the rows arrive
        edges, bias, w, v = learn(words[order], stats[order], y[order])
        flat = np.concatenate([edges.ravel(), [bias], w, v.ravel()])
        return pa.table({"model": pa.array([flat.tolist()], pa.list_(pa.float64()))})

    described = rows.mapInArrow(to_features, "quality double, words binary, stats binary")
    found = described.groupBy().applyInArrow(to_model, "model array<double>").collect()
    if not found:
        return QualityModel(np.zeros((N_STATS, BINS - 1)), 0.0, np.zeros(N_FEATURES), np.zeros((N_FEATURES, FACTORS)))
    flat = np.array(found[0][0])
    cut = np.cumsum([N_STATS * (BINS - 1), 1, N_FEATURES])
    edges, bias, w, v = np.split(flat, cut)
    return QualityModel(edges.reshape(N_STATS, -1), float(bias[0]), w, v.reshape(N_FEATURES, FACTORS))


def score(docs: DataFrame, model: QualityModel, drop_text: bool = False) -> DataFrame:
    """Columns of ``docs`` with ``quality_score`` (0 to 1, higher: label 1 likelier), replaced if there is one.

    A null text is scored as an empty one; an unknown or odd stated length is a value of its own. Without labels to learn
    from every score is 0.5. Equal rows have equal scores.
    """
    docs = docs.drop("quality_score")
    stated = fresh_name(docs, "stated")
    rows = docs.withColumn(stated, _with_stated(docs)["n_chars"].cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double"))
    kept = [c for c in docs.columns if not (drop_text and c == "text")]
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("quality_score", T.DoubleType())])
    carried = docs.sparkSession.sparkContext.broadcast((model.edges, model.bias, model.w, model.v))
    text_at, stated_at = rows.columns.index("text"), rows.columns.index(stated)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, bias, w, v = carried.value
        w, v, hasher = w.astype(np.float32), v.astype(np.float32), WordHasher(seed=4)
        for batch in batches:
            lengths, found = _stated(batch.column(stated_at)), np.empty(batch.num_rows)
            for lo, hi, data, offsets in byte_slices(batch.column(text_at)):
                x = features(*describe(data, offsets, lengths[lo:hi], hasher), edges)
                found[lo:hi] = _sigmoid(logits(x, bias, w, v).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(found)], [*kept, "quality_score"])

    return rows.mapInArrow(judge, schema)
