"""URLs by rules and, where none fits, by the ratio of two character models.

One variable-order Markov model is learned from accepted URLs and one from rejected ones. The probability of a byte after
up to ``ORDER - 1`` bytes interpolates all shorter contexts, each weighed against ``PRIOR`` virtual counts of the next
shorter one. A URL passes if the difference of its log-probabilities, per byte, reaches a threshold calibrated on
labelled URLs that were kept out of the counts.

Counts are of all labelled URLs, summed on the executors into ``CELLS`` hashed cells per order and class; so the models
have a fixed size, and n-grams that share a cell share their count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from voxgauge.llm.arrow_text import byte_slices
from voxgauge.llm.shared import fresh_name, remainder

ORDER = 6
CELLS = 1 << 16
PRIOR = 2.0
#: One labelled URL in this many calibrates the threshold and is not counted.
CALIBRATION = 5
#: Scores are calibrated in bins of this width, from -SPAN to SPAN nats per byte.
BIN, SPAN = 0.01, 8.0

#: (action, host and path), such as ("block", "example.org/es/")
Rule = tuple[str, str]


def host(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_that_fits(host_: Column, path_: Column, rules: list[Rule]) -> Column:
    """Struct (action, rule) of the longest rule whose host is the URL's or a parent of it and whose path starts its path.

    Null if none fits. Of equally long rules the one with the longer host wins, then the first in the list.
    """
    split = [(action, r, r.partition("/")[0].lower(), "/" + r.partition("/")[2]) for action, r in rules]
    found = F.lit(None).cast("struct<action: string, rule: string>")
    for action, r, h, p in sorted(reversed(split), key=lambda x: (len(x[1]), len(x[2]))):
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        found = F.when(fits, F.struct(F.lit(action).alias("action"), F.lit(r).alias("rule"))).otherwise(found)
    return found


def _cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every byte and the end of each text: cells of its n-grams and of their contexts by order; and its text."""
    n, pad = len(offsets) - 1, ORDER - 1
    sizes = np.diff(offsets) + ORDER  # start marks before a text and an end mark behind it
    ends = np.cumsum(sizes)
    full = np.full(int(ends[-1]), 256, np.uint64)
    full[ends - 1] = 257
    doc = np.repeat(np.arange(n), sizes - pad)
    inner = np.arange(len(full)) - np.repeat(ends - sizes, sizes) >= pad
    text = inner.copy()
    text[ends - 1] = False
    full[text] = data
    at = np.flatnonzero(inner)
    grams, contexts = np.empty((ORDER, len(at)), np.int64), np.empty((ORDER, len(at)), np.int64)
    gram, context = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    step = np.ones(1, np.uint64)
    hashed = lambda x, k: ((x * np.uint64(0x9E3779B97F4A7C15 + 2 * k)) >> np.uint64(48)).astype(np.int64)
    for k in range(ORDER):
        grams_code = full[at - k] + np.uint64(1)
        gram = gram + grams_code * step
        grams[k] = hashed(gram, k)
        contexts[k] = hashed(context, k)
        context = context + (full[at - k - 1 if k < pad else at - k] + np.uint64(1)) * step
        step = step * np.uint64(0x100000001B3)
    return grams, contexts, doc


def _count(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of n-grams and of contexts, [rejected, accepted] by order and cell, of rows (accepted, text)."""
    size = 2 * 2 * ORDER * CELLS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            accepted = np.asarray(batch.column(0)).astype(np.int64)
            for lo, hi, data, offsets in byte_slices(batch.column(1)):
                grams, contexts, doc = _cells(data, offsets)
                side = accepted[lo:hi][doc] * 2
                for part, cells in enumerate((grams, contexts)):
                    base = ((side + part)[None, :] * ORDER + np.arange(ORDER)[:, None]) * CELLS
                    total += np.bincount((base + cells).ravel(), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["cell", "n"])

    sums = texts.mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(size, np.int64)  # what comes to the driver has at most this many rows
    total[sums.column("cell").to_numpy()] = sums.column("n").to_numpy()
    total = total.reshape(2, 2, ORDER, CELLS)
    return total[:, 0], total[:, 1]


def log_ratio(data: np.ndarray, offsets: np.ndarray, grams: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Per text: (log P accepted - log P rejected) / (bytes + 1), the end included."""
    cells, before, doc = _cells(data, offsets)
    difference = np.zeros(cells.shape[1])
    for side, sign in ((1, 1.0), (0, -1.0)):
        p = np.full(cells.shape[1], 1 / 257)
        for k in range(ORDER):
            p = (grams[side, k][cells[k]] + PRIOR * p) / (contexts[side, k][before[k]] + PRIOR)
        difference += sign * np.log(p)
    return np.bincount(doc, difference, minlength=len(offsets) - 1) / (np.diff(offsets) + 1)


class UrlModel:
    def __init__(self, grams: np.ndarray, contexts: np.ndarray, threshold: float):
        self.grams, self.contexts, self.threshold = grams, contexts, threshold


def _scored(rows: DataFrame, text: str, grams: np.ndarray, contexts: np.ndarray, keep: list[str], name: str) -> DataFrame:
    carried = rows.sparkSession.sparkContext.broadcast((grams.astype(np.float32), contexts.astype(np.float32)))
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField(name, T.DoubleType())])
    at = rows.columns.index(text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, c = carried.value
        for batch in batches:
            found = [log_ratio(data, offsets, g, c) for _, _, data, offsets in byte_slices(batch.column(at))]
            found = pa.array(np.concatenate(found) if found else np.empty(0))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], found], [*keep, name])

    return rows.mapInArrow(score, schema)


def fit(labelled: DataFrame) -> UrlModel:
    """Learns from rows (id, text, accepted), all of them but one in ``CALIBRATION``, which set the threshold.

    The threshold has the best mean of both classes' shares judged right, the middle of equally good ones. Without
    accepted or without rejected rows it is the one that judges all like those there are; without any, all pass.
    """
    rows = labelled.select(F.col("accepted").cast("int").alias("accepted"), "text", remainder("id", CALIBRATION).alias("r"))
    grams, contexts = _count(rows.filter("r <> 0").select("accepted", "text"))
    scored = _scored(rows.filter("r = 0").select("accepted", "text"), "text", grams, contexts, ["accepted"], "score")
    bins = F.floor((F.least(F.greatest("score", F.lit(-SPAN)), F.lit(SPAN)) + SPAN) / BIN).cast("int")
    n = int(2 * SPAN / BIN) + 1
    counts = np.zeros((2, n))
    for accepted, k, c in scored.groupBy("accepted", bins.alias("bin")).count().collect():  # at most 2 n rows
        counts[accepted, k] += c
    sizes = counts.sum(axis=1)
    if not sizes.all():
        return UrlModel(grams, contexts, np.inf if sizes[0] else -np.inf)
    passing = counts[1][::-1].cumsum()[::-1] / sizes[1]
    stopped = (counts[0].cumsum() - counts[0]) / sizes[0]
    best = np.flatnonzero(passing + stopped >= (passing + stopped).max() - 1e-12)
    return UrlModel(grams, contexts, float(best[0] + best[-1]) / 2 * BIN - SPAN)


def judge(pages: DataFrame, rules: list[Rule], model: UrlModel | None = None) -> DataFrame:
    """All columns of ``pages`` with host, path, rule, verdict (allow or block), url_score.

    The rule decides where one fits, else the model, learned from the URLs that rules decide unless one is given. A null
    URL or one without ``://`` has an empty host and path and the score of an empty text. Columns of these five
    names are replaced. Repeated rows are judged alike.
    """
    pages = pages.drop("host", "path", "rule", "verdict", "url_score")
    fits = fresh_name(pages, "fits")
    rows = pages.withColumns({"host": host("url"), "path": path("url")})
    rows = rows.withColumn(fits, rule_that_fits(F.col("host"), F.col("path"), rules))
    text = fresh_name(rows, "text")
    rows = rows.withColumn(text, F.concat("host", "path"))
    if model is None:
        key = F.coalesce(F.col("url"), F.lit("")).alias("id")
        known = rows.filter(F.col(f"{fits}.action").isNotNull())
        model = fit(known.select(key, F.col(text).alias("text"), (F.col(f"{fits}.action") == "allow").alias("accepted")))
    keep = [c for c in rows.columns if c != text]
    scored = _scored(rows, text, model.grams, model.contexts, keep, "url_score")
    by_model = F.when(F.col("url_score") >= F.lit(model.threshold), "allow").otherwise("block")
    return scored.withColumns(
        {"rule": F.col(f"{fits}.rule"), "verdict": F.coalesce(F.col(f"{fits}.action"), by_model)}
    ).select(*pages.columns, "host", "path", "rule", "verdict", "url_score")
