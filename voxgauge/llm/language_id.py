"""Language of a text: nearest of several centroids per language, by cosine of TF-IDF vectors of byte n-grams.

A text is lower-cased (A-Z) and what is neither an ASCII letter nor part of a non-ASCII character counts as a space. Its
n-grams of bytes are hashed into ``BUCKETS`` cells; a cell weighs (1 + ln tf) times its inverse document frequency over
all texts learned from, and the vector has length 1. The texts of a language are clustered on the sphere and each cluster
mean is a centroid; one of very few texts is put aside. A text whose nearest centroid is farther than the language's
radius is rejected. Short texts lie far from every centroid, so a radius belongs to a language and a size, the number of a
text's cells: it follows a low quantile of the cosines of fitted texts, and of their beginnings, of that size.

Document frequencies cover every text learned from. Clustering and radii use at most ``FIT_ROWS`` texts per language,
those of the smallest hash of their id, so a hot language costs no more than another. What tasks carry is bounded:
``BUCKETS`` frequencies and ``CENTROIDS`` vectors per language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from voxgauge.llm.arrow_text import byte_slices, giving_back
from voxgauge.llm.shared import broadcast_if_small, fresh_name

BUCKETS = 4096
ORDERS = (2, 3, 4)
CENTROIDS = 4
#: Texts handled at once, and their bytes: each text takes a line of ``BUCKETS`` numbers, however short it is.
TEXT_ROWS, TEXT_BYTES = 128, 1 << 18
#: Texts per language that clustering and radii are fitted on.
FIT_ROWS = 1000
#: A centroid of a smaller share of the fitted texts is put aside.
LEAST_SHARE = 0.02
#: Bytes of beginnings that radii are fitted on: one of each fitted text, up to all where the texts are few.
BEGINNINGS = (8, 16, 32, 64, 128, 256, 512, 1024, 2048)
#: Sizes of texts: half powers of two of the cells they have.
SIZES = 2 * BUCKETS.bit_length()
#: Cosines so many deviations (of the median kind) below the median of their size are outliers; the quantile of the rest.
OUTLIER, LOW = 4.0, 0.01
#: A size of fewer fitted texts takes its radius from the sizes beside it.
SIZE_TEXTS = 20
#: A text is rejected if its cosine is below this share of that quantile.
RADIUS_SHARE = 0.6

_PREDICTED = [
    T.StructField("lang_pred", T.StringType()),
    T.StructField("lang_score", T.DoubleType()),
    T.StructField("cosine", T.DoubleType()),
    T.StructField("rejected", T.BooleanType()),
]

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed n-grams, one line of ``BUCKETS`` per text. N-grams with two spaces in a row are left out."""
    n = len(offsets) - 1
    # A space before and after each text keeps n-grams within it.
    at = np.arange(len(data)) + np.repeat(np.arange(1, n + 1) * 2 - 1, np.diff(offsets))
    padded = np.full(len(data) + 2 * n, 32, np.uint8)
    padded[at] = _FOLD[data]
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets) + 2)
    space = padded == 32
    twice = space[:-1] & space[1:]
    cells = np.zeros(n * BUCKETS, np.int64)
    code = padded.astype(np.uint32)
    good = np.ones(len(padded), bool)
    for k in range(2, max(ORDERS) + 1):
        code = code[:-1] * np.uint32(0x01000193) + padded[k - 1 :]
        good = good[:-1] & ~twice[k - 2 :]
        if k in ORDERS:
            inside = good & (doc[: len(code)] == doc[k - 1 :])
            cell = ((code[inside] ^ np.uint32(k * 0x9E37)) * np.uint32(0x85EBCA6B)) >> np.uint32(20)
            cells += np.bincount(doc[: len(code)][inside] * BUCKETS + cell, minlength=n * BUCKETS)
    return cells.reshape(n, BUCKETS)


def vectors(data: np.ndarray, offsets: np.ndarray, idf: np.ndarray) -> np.ndarray:
    counts = gram_counts(data, offsets)
    x = np.zeros(counts.shape, np.float32)
    seen = counts > 0
    x[seen] = np.log(counts[seen]) + 1
    x *= idf
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Texts per cell, and texts; summed on the executors to one row per cell."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for lo, hi, data, offsets in byte_slices(batch.column(0), TEXT_BYTES, TEXT_ROWS):
                total += (gram_counts(data, offsets) > 0).sum(axis=0)
                rows += hi - lo
        cell = np.append(np.arange(BUCKETS), -1)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(np.append(total, rows))], ["cell", "n"])

    sums = texts.select("text").mapInArrow(giving_back(count), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    found = {r["cell"]: r["n"] for r in sums.collect()}  # BUCKETS rows and one
    return np.array([found.get(i, 0) for i in range(BUCKETS)], np.int64), found.get(-1, 0)


def cluster(x: np.ndarray, k: int, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from spread-out seeds: centroids, and each row's cosine to its nearest."""
    centres = x[:1]
    near = x @ centres[0]
    while len(centres) < min(k, len(x)):  # the row farthest from all seeds so far
        i = int(np.argmin(near))
        if near[i] > 1 - 1e-6:
            break
        centres = np.vstack([centres, x[i]])
        near = np.maximum(near, x @ x[i])
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        means = np.stack([x[own == c].sum(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        means = (means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)).astype(np.float32)
        if np.allclose(means, centres, atol=1e-6):
            break
        centres = means
    return centres, (x @ centres.T).max(axis=1)


def size_of(x: np.ndarray) -> np.ndarray:
    """Size (below ``SIZES``) of texts by their vectors."""
    return (2 * np.log2(np.maximum((x > 0).sum(axis=1), 1))).astype(np.int64)


def floors_by_size(size: np.ndarray, cosines: np.ndarray) -> np.ndarray:
    """Low quantile of the cosines of each size, without outliers."""
    found = []
    for k in np.unique(size):
        own = cosines[size == k].astype(np.float64)
        middle = np.median(own)
        spread = max(1.4826 * np.median(np.abs(own - middle)), 0.01)
        found.append((k, len(own), np.quantile(own[own >= middle - OUTLIER * spread], LOW)))
    at, n, low = (np.array(c) for c in zip(*found))
    enough = n >= min(SIZE_TEXTS, n.max())
    return np.interp(np.arange(SIZES), at[enough], low[enough])


def beginnings(data: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One beginning of each text, whole characters, of the length in ``BEGINNINGS`` that ``which`` names; nothing below 0."""
    n = np.where(which < 0, 0, np.minimum(np.diff(offsets), np.array(BEGINNINGS)[which]))
    parts = []
    for start, end, k in zip(offsets[:-1], offsets[1:], n):
        while 0 < k < end - start and data[start + k] & 0xC0 == 0x80:
            k -= 1
        parts.append(data[start : start + k])
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


class LanguageModel:
    """Inverse document frequencies, and per centroid its language and vector; floors: by language, low cosine of each size."""

    def __init__(self, idf, languages, owner, centroids, floors):
        self.idf, self.languages, self.owner, self.centroids, self.floors = idf, languages, owner, centroids, floors


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, centroids: int = CENTROIDS) -> LanguageModel:
    """Learns from rows (doc_id, text, lang); those without a text, a letter or a language teach nothing."""
    rows = labelled.filter(has_letter("text") & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    df, n = document_frequencies(rows)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    # Twice the rows wanted pass a threshold of the hash before anything is shuffled; a small language passes whole.
    sizes = rows.groupBy("lang").agg(F.count("*").alias("size"))
    draw = F.xxhash64("doc_id", "text")
    rounds = F.least(F.ceil(F.lit(fit_rows) / F.col("size")), F.lit(len(BEGINNINGS))).cast("int").alias("rounds")
    share = F.pmod(draw, F.lit(1 << 30)) / (1 << 30)
    drawn = rows.join(broadcast_if_small(sizes), "lang").filter(share * F.col("size") <= 2 * fit_rows + 100)
    order = W.partitionBy("lang").orderBy(share, draw)
    sample = drawn.select("lang", "text", F.row_number().over(order).cast("int").alias("k"), rounds).filter(F.col("k") <= fit_rows)

    def to_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(lang: pa.Array, whole: bool, x: np.ndarray) -> pa.RecordBatch:
            v = pa.array([v.tobytes() for v in x.astype(np.float16)], pa.binary())
            return pa.RecordBatch.from_arrays([lang, pa.array(np.full(len(x), whole)), v], ["lang", "whole", "v"])

        for batch in batches:
            for lo, hi, data, offsets in byte_slices(batch.column(1), TEXT_BYTES, TEXT_ROWS):
                lang, k, rounds = (batch.column(c).slice(lo, hi - lo) for c in (0, 2, 3))
                yield rows(lang, True, vectors(data, offsets, idf))
                k, rounds = np.asarray(k), np.asarray(rounds)
                for r in range(rounds.max(initial=0)):
                    which = np.where(r < rounds, (k + r) % len(BEGINNINGS), -1)
                    yield rows(lang, False, vectors(*beginnings(data, offsets, which), idf))

    def to_centroids(group: pa.Table) -> pa.Table:
        x = np.stack([np.frombuffer(v, np.float16) for v in group.column("v").to_pylist()]).astype(np.float32)
        whole = np.asarray(group.column("whole"))
        centres, _ = cluster(x[whole], centroids)
        own = np.bincount((x[whole] @ centres.T).argmax(axis=1), minlength=len(centres))
        centres = centres[own >= LEAST_SHARE * whole.sum()]
        x = x[whole | (x > 0).any(axis=1)]
        floors = floors_by_size(size_of(x), (x @ centres.T).max(axis=1))
        m = len(centres)
        return pa.table(
            {
                "lang": pa.array([group.column("lang")[0].as_py()] * m, pa.string()),
                "floors": pa.array([floors.tolist()] * m, pa.list_(pa.float64())),
                "v": pa.array([c.tobytes() for c in centres], pa.binary()),
            }
        )

    found = sample.mapInArrow(giving_back(to_vectors), "lang string, whole boolean, v binary")
    found = found.groupBy("lang").applyInArrow(to_centroids, "lang string, floors array<double>, v binary")
    found = sorted(found.collect())  # a few rows per language
    languages = sorted({r["lang"] for r in found})
    return LanguageModel(
        idf,
        languages,
        np.array([languages.index(r["lang"]) for r in found], np.int64),
        np.stack([np.frombuffer(r["v"], np.float32) for r in found]) if found else np.empty((0, BUCKETS), np.float32),
        {r["lang"]: np.array(r["floors"]) for r in found},
    )


def predict(docs: DataFrame, model: LanguageModel, radius_share: float = RADIUS_SHARE, drop_text: bool = False) -> DataFrame:
    """Columns of ``docs`` with lang_pred, lang_score (0 to 1), cosine (to the nearest centroid) and rejected.

    ``und``, score 0 and rejected: a null text, one without letters, or no language learned. The score is the best
    language's cosine over the sum of the best two, the cosine itself if there is one language. Ties go to the
    language first in the alphabet. Columns of these four names are replaced. Equal rows stay equal rows.
    """
    names = ["lang_pred", "lang_score", "cosine", "rejected"]
    docs = docs.drop(*names)
    letters = fresh_name(docs, "letters")
    rows = docs.withColumn(letters, has_letter("text"))
    kept = [c for c in docs.columns if not (drop_text and c == "text")]
    schema = T.StructType([*[docs.schema[c] for c in kept], *_PREDICTED])
    parts = model.languages, model.owner, model.idf, model.centroids, model.floors
    carried = docs.sparkSession.sparkContext.broadcast(parts)  # BUCKETS cells per centroid
    text_at, letters_at = rows.columns.index("text"), rows.columns.index(letters)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, owner, idf, centroids, least = carried.value
        known = len(languages)
        floors = np.array([least[x] * radius_share for x in languages])  # by language and size
        for batch in batches:
            for lo, hi, data, offsets in byte_slices(batch.column(text_at), TEXT_BYTES, TEXT_ROWS):
                n = hi - lo
                best, near, share, size = np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
                if known:
                    x = vectors(data, offsets, idf)
                    filled = np.zeros((TEXT_ROWS, BUCKETS), np.float32)  # a product of few lines adds up in another order
                    filled[:n] = x
                    cosine, size = (filled @ centroids.T)[:n], size_of(x)
                    by_language = np.stack([cosine[:, owner == k].max(axis=1) for k in range(known)], axis=1)
                    by_language = np.clip(by_language.astype(np.float64), 0, 1)
                    best, row = by_language.argmax(axis=1), np.arange(n)
                    near = by_language[row, best]
                    by_language[row, best] = 0
                    total = near + by_language.max(axis=1)
                    share = near if known == 1 else np.where(total > 0, near / np.maximum(total, 1e-12), 0)
                judged = np.asarray(batch.column(letters_at).slice(lo, n)) & (known > 0)
                labels = np.array([*languages, "und"], dtype=object)[np.where(judged, best, known)]
                far = ~judged | (near < (floors[best, size] if known else 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(lo, n) for c in kept],
                        pa.array(labels, pa.string()),
                        pa.array(np.where(judged, share, 0.0)),
                        pa.array(np.where(judged, near, 0.0)),
                        pa.array(far),
                    ],
                    [*kept, *names],
                )

    return rows.mapInArrow(giving_back(judge), schema)
