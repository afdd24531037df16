"""Near-duplicate texts: consistent weighted samples of TF-IDF shingles, banded, verified by weighted Jaccard.

A shingle is a run of five words; a shorter text, but not an empty one, is one shingle. Its weight is how often it occurs
in the text times the mean inverse document frequency of its words. Document frequencies cover all texts, in
``CELLS`` hashed cells, so the table has a fixed size; frequent words, which matter, dwarf what shares their cell.

Samples follow improved consistent weighted sampling (Ioffe): of each shingle with weight w, r and c ~ Gamma(2, 1) and
b ~ U(0, 1) are drawn by its hash, t = floor(ln w / r + b), and the sample is the (shingle, t) of least
ln c - r (t - b + 1). Two texts agree in a sample with the probability of their weighted Jaccard similarity. ``BANDS`` bands
of ``ROWS`` samples find a pair of similarity 0.8 with probability 0.9992.

Texts of the same words are one node from the start, so copies cost nothing more. In each bucket all nodes are compared
with one leader, the node whose buckets are the largest, as is the text that the others were copied from; so a large family
falls to one component in one step. Buckets that hold several components go on: ``LEADERS`` of a bucket's nodes, most
alike the others first, are compared with the nodes of other components that they agree with in at least ``AGREED`` of
all samples (of a pair of similarity 0.8 fewer agree with probability 0.0002). Then all nodes outside the bucket's largest
component are compared with all of other components, so no pair of a bucket is passed over unless it is of one component by
then. No pair within a component is compared or emitted. A bucket of more than ``BUCKET_ROWS`` rows or ``BLOCK_BYTES`` of
shingles is dealt into blocks, and in the last round each block of leaders meets each block, so no task holds a bucket without
bound. That round compares many texts that are not similar, as all edits of one text are with one another; so its blocks hold the
shingles of the whole texts, each pair is judged in the first bucket it shares, and only similar pairs leave the task: what
tasks exchange grows with the texts, though the products inside a block still grow with the rows times those outside the largest
component. Similar pairs, verified on the whole texts, are the links; classes are their connected components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from voxgauge.llm.arrow_text import ALNUM, WordHasher, byte_slices, giving_back, mix, shingles, word_bounds
from voxgauge.llm.components import components
from voxgauge.llm.shared import broadcast_if_small, fresh_name, stored

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 3
CELLS = 1 << 16
AGREED = 0.5
#: Rows of a bucket that a block holds; a larger bucket is dealt into several.
BUCKET_ROWS = 2000
#: Bytes of shingles that a block holds in the last round, where each row brings those of its text.
BLOCK_BYTES = 8 << 20
#: Leaders of a block in each round after the first; in the last (None) all lead that are not of the largest component.
LEADERS = (8, None)
#: Texts handled at once, and their bytes; their number fits the bits that keep them apart.
_SLICE_ROWS, _SLICE_BYTES = 1024, 1 << 18


def _gamma_quantiles(n: int) -> np.ndarray:
    """Quantiles of Gamma(2, 1) at (i + 1/2) / n; its distribution function is 1 - (1 + x) exp(-x)."""
    at = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 60.0)
    for _ in range(60):
        x = (low + high) / 2
        below = 1 - (1 + x) * np.exp(-x) < at
        low, high = np.where(below, x, low), np.where(below, high, x)
    return (low + high) / 2


_R = _gamma_quantiles(1 << 12).astype(np.float32)
_LOG_C = np.log(_gamma_quantiles(1 << 16)).astype(np.float32)


def _words(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, bounds = word_bounds(data, offsets, ALNUM)
    return hasher(data, starts, ends), bounds


def _cell(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(48)).astype(np.int64) & (CELLS - 1)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """ln((1 + texts) / (1 + texts with the cell)) + 1 of every cell, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total, texts = WordHasher(), np.zeros(CELLS, np.int64), 0
        for batch in batches:
            for lo, hi, data, offsets in byte_slices(batch.column(0), _SLICE_BYTES):
                words, bounds = _words(data, offsets, hasher)
                doc = np.repeat(np.arange(hi - lo), np.diff(bounds))
                total += np.bincount(np.unique(doc * CELLS + _cell(words)) % CELLS, minlength=CELLS)
                texts += hi - lo
        at = np.flatnonzero(total)
        cells, n = np.append(at, -1).astype(np.int32), np.append(total[at], texts)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n)], ["cell", "n"])

    sums = docs.select("text").mapInArrow(giving_back(count), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells, n = sums.column("cell").to_numpy(), sums.column("n").to_numpy()  # at most CELLS rows and one
    found = np.zeros(CELLS, np.int64)
    found[cells[cells >= 0]] = n[cells >= 0]
    texts = int(n[cells < 0].sum())
    return (np.log((1 + texts) / (1 + found)) + 1).astype(np.float32)


def weighted_shingles(
    data: np.ndarray, offsets: np.ndarray, idf: np.ndarray, hasher: WordHasher, k: int = WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of up to 1,024 texts: keys (text in the top 10 bits, then the hash), weights, the number of
    them before each text; and a 64-bit digest of each text's words in order, 0 without words."""
    words, bounds = _words(data, offsets, hasher)
    hashes, before = shingles(words, bounds, k)
    n = len(offsets) - 1
    runs = np.diff(before)
    doc = np.repeat(np.arange(n), runs)
    sums = np.concatenate([[0], np.cumsum(idf[_cell(words)], dtype=np.float64)])
    first = np.arange(len(hashes)) + np.repeat(bounds[:-1] - before[:-1], runs)
    last = np.minimum(first + k, np.repeat(bounds[1:], runs))
    mean = ((sums[last] - sums[first]) / np.maximum(last - first, 1)).astype(np.float32)
    keys = (doc.astype(np.uint64) << np.uint64(54)) | (hashes >> np.uint64(10))
    unique, at, times = np.unique(keys, return_index=True, return_counts=True)
    digest = np.zeros(n, np.uint64)
    if len(hashes):
        place = np.arange(len(hashes)) - np.repeat(before[:-1], runs)
        full = np.flatnonzero(runs)
        ordered = mix(hashes + mix(place.astype(np.uint64)))
        digest[full] = np.add.reduceat(ordered, before[:-1][full])
    starts = np.searchsorted(unique, np.arange(n + 1, dtype=np.uint64) << np.uint64(54)) if n < 1024 else np.append(
        np.searchsorted(unique, np.arange(n, dtype=np.uint64) << np.uint64(54)), len(unique)
    )
    return unique, times * mean[at], starts, digest


def samples(keys: np.ndarray, weights: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """``count`` consistent weighted samples (32-bit identities) of each text with shingles, in order."""
    mask = np.uint64((1 << 54) - 1)
    shingle, log_w = mix(keys & mask), np.log(weights).astype(np.float32)
    heads = starts[:-1][np.diff(starts) > 0]
    out = np.empty((len(heads), count), np.uint64)
    for k in range(count):
        x = mix(shingle + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        r = _R[(x & np.uint64(0xFFF)).astype(np.intp)]
        log_c = _LOG_C[((x >> np.uint64(12)) & np.uint64(0xFFFF)).astype(np.intp)]
        b = ((x >> np.uint64(28)) & np.uint64(0xFFFFFF)).astype(np.float32) * np.float32(2**-24)
        t = np.floor(log_w / r + b)
        least = log_c - r * (t - b + 1)
        bits = least.view(np.uint32)
        bits = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))  # floats in the order of unsigned integers
        own = ((x >> np.uint64(32)) + t.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
        out[:, k] = np.minimum.reduceat((bits.astype(np.uint64) << np.uint64(32)) | own, heads) & np.uint64(0xFFFFFFFF)
    return out


def signatures(docs: DataFrame, idf: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, tag (hash of the text), digest (of its words; null without words), weight, bands,
    drawn (all samples, 4 bytes each)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for lo, hi, data, offsets in byte_slices(batch.column(2), _SLICE_BYTES, _SLICE_ROWS):
                keys, weights, starts, digest = weighted_shingles(data, offsets, idf, hasher)
                full = np.diff(starts) > 0
                total = np.zeros(hi - lo)
                keys_of = np.zeros((hi - lo, bands), np.uint64)
                all_drawn = np.zeros((hi - lo, bands * rows), np.uint32)
                if len(keys):
                    total[full] = np.add.reduceat(weights.astype(np.float64), starts[:-1][full])
                    drawn = samples(keys, weights, starts, bands * rows).reshape(-1, bands, rows)
                    all_drawn[full] = drawn.reshape(-1, bands * rows)
                    folded = np.zeros(drawn.shape[:2], np.uint64)
                    for k in range(rows):
                        folded = mix(folded + drawn[:, :, k])
                    keys_of[full] = mix(folded + np.arange(bands, dtype=np.uint64))
                flat = pa.array(keys_of.ravel().view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (hi - lo) * bands + 1, bands, dtype=np.int32)), flat)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        pa.array(digest.view(np.int64), mask=~full),
                        pa.array(total),
                        lists,
                        pa.array([x.tobytes() for x in all_drawn], pa.binary()),
                    ],
                    ["doc_id", "tag", "digest", "weight", "bands", "drawn"],
                )

    return source.mapInArrow(giving_back(sign), "doc_id long, tag long, digest long, weight double, bands array<long>, drawn binary")


def verified(spark: SparkSession, pairs: DataFrame, texts: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """``pairs`` (a, b) with ``similar``: whether the weighted Jaccard similarity of their texts is high enough."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for lo, hi, data, offsets in byte_slices(batch.column(2), _SLICE_BYTES, _SLICE_ROWS):
                other = pa.array(batch.column(3).slice(lo, hi - lo))
                keys, weights, starts, _ = weighted_shingles(data, offsets, idf, hasher)
                total, shared = np.zeros(hi - lo), np.zeros(hi - lo)
                full = np.diff(starts) > 0
                total[full] += np.add.reduceat(weights.astype(np.float64), starts[:-1][full]) if len(keys) else 0
                for lo2, hi2, data2, offsets2 in byte_slices(other, _SLICE_BYTES, _SLICE_ROWS):
                    keys2, weights2, starts2, _ = weighted_shingles(data2, offsets2, idf, hasher)
                    keys2 = keys2 + (np.uint64(lo2) << np.uint64(54))
                    full2 = np.diff(starts2) > 0
                    mine = np.zeros(hi2 - lo2)
                    mine[full2] = np.add.reduceat(weights2.astype(np.float64), starts2[:-1][full2]) if len(keys2) else 0
                    total[lo2:hi2] += mine
                    both, i, j = np.intersect1d(keys, keys2, assume_unique=True, return_indices=True)
                    low = np.minimum(weights[i], weights2[j]).astype(np.float64)
                    shared += np.bincount((both >> np.uint64(54)).astype(np.int64), low, minlength=hi - lo)
                similar = shared >= similarity * (total - shared) - 1e-9
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(similar)],
                    ["a", "b", "similar"],
                )

    return rows.mapInArrow(giving_back(compare), "a long, b long, similar boolean")


def shingle_sets(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """Per row of ``texts`` (node, text): node, keys (8 bytes each) and weights (doubles) of its distinct shingles."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, mask = WordHasher(), np.uint64((1 << 54) - 1)
        for batch in batches:
            for lo, hi, data, offsets in byte_slices(batch.column(1), _SLICE_BYTES, _SLICE_ROWS):
                keys, weights, starts, _ = weighted_shingles(data, offsets, idf, hasher)
                at = pa.array((starts * 8).astype(np.int32)).buffers()[1]
                held = ((keys & mask).tobytes(), weights.astype(np.float64).tobytes())
                columns = [pa.Array.from_buffers(pa.binary(), hi - lo, [None, at, pa.py_buffer(x)]) for x in held]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *columns], ["node", "keys", "weights"])

    return texts.select("node", "text").mapInArrow(giving_back(sets), "node long, keys binary, weights binary")


def _led(active: DataFrame, similarity: float) -> DataFrame:
    """Every other node of a bucket with the bucket's leader, where their totals allow similarity: a, b."""
    sizes = active.groupBy("band", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
    shared = active.join(sizes, ["band", "bucket"])
    central = shared.groupBy("node").agg(F.sum(F.log("n")).alias("central"))
    # One row per bucket, combined before the shuffle.
    first = F.max(F.struct("central", F.xxhash64("node").alias("draw"), "node", "weight")).alias("leader")
    ranked = shared.join(central, "node")
    leaders = ranked.groupBy("band", "bucket").agg(first)
    lowest = F.least("weight", "leader.weight") >= (similarity - 1e-9) * F.greatest("weight", "leader.weight")
    led = active.join(leaders, ["band", "bucket"]).filter((F.col("node") != F.col("leader.node")) & lowest)
    return led.select(F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b")).distinct()


def _several(rows: DataFrame) -> DataFrame:
    """Rows (band, bucket, component, ...) of buckets that hold more than one component."""
    ends = rows.groupBy("band", "bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return rows.join(ends.filter("lo <> hi").select("band", "bucket"), ["band", "bucket"])


def _salted(rest: DataFrame) -> DataFrame:
    """With ``part``: rows of a large bucket dealt at random into parts of about ``BUCKET_ROWS``, otherwise in each band."""
    parts = rest.groupBy("band", "bucket").agg(F.ceil(F.count("*") / BUCKET_ROWS).alias("parts"))
    return rest.join(parts, ["band", "bucket"]).withColumn("part", F.pmod(F.xxhash64("node", "band"), "parts")).drop("parts")


def _similar_weight(mine: np.ndarray, others: np.ndarray, similarity: float) -> np.ndarray:
    return np.minimum(mine, others) >= (similarity - 1e-9) * np.maximum(mine, others)


def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    a, b = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 2
    a, b = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else (a, b)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _groups(*keys: np.ndarray) -> list[np.ndarray]:
    """Rows of each combination of keys."""
    order = np.lexsort(keys)
    edge = np.zeros(max(len(order) - 1, 0), bool)
    for key in keys:
        edge |= np.diff(key[order]) != 0
    return np.split(order, np.flatnonzero(edge) + 1)


def _with_leaders(rest: DataFrame, groups: int, leaders: int, similarity: float) -> DataFrame:
    """Pairs (a, b) of the most central nodes of a bucket's part with nodes of other components that they agree with."""

    def pair(group: pa.Table) -> pa.Table:
        band, bucket, part = (group.column(c).to_numpy() for c in ("band", "bucket", "part"))
        node, weight, component = (group.column(c).to_numpy() for c in ("node", "weight", "component"))
        drawn = np.frombuffer(b"".join(group.column("drawn").to_pylist()), np.uint32).reshape(len(node), -1)
        found = []
        for rows in _groups(part, bucket, band):
            # How often a node's samples occur in the bucket: its agreement with all the others.
            shared = np.zeros(len(rows))
            for column in drawn[rows].T:
                _, which, times = np.unique(column, return_inverse=True, return_counts=True)
                shared += times[which]
            rows = rows[np.lexsort((node[rows], -shared))]
            for i in rows[:leaders]:
                others = rows[(component[rows] != component[i]) & _similar_weight(weight[i], weight[rows], similarity)]
                others = others[(drawn[others] == drawn[i]).mean(axis=1) >= AGREED]
                found.append((np.full(len(others), node[i]), node[others]))
        return _pairs(found)

    key = F.pmod(F.xxhash64("band", "bucket", "part"), F.lit(groups))
    return _salted(rest).groupBy(key).applyInArrow(pair, "a long, b long").distinct()


def _values(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a binary column, and where those of each row start and end."""
    lengths = pc.binary_length(column).to_numpy() // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column.to_pylist()), kind), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def _across(spark: SparkSession, rest: DataFrame, nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """All similar pairs (a, b) of nodes of a bucket that are of other components and agree.

    One of two components is not the bucket's largest, so its nodes lead, in blocks that meet every block of the bucket.
    """
    brief = sets.select("node", (2 * F.octet_length("keys")).alias("bytes"))
    rest = rest.join(brief, "node")
    counts = rest.groupBy("band", "bucket", "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    sizes = counts.groupBy("band", "bucket").agg(
        F.max(F.struct("n", "component", "bytes")).alias("main"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes")
    )
    blocks = lambda n, size: F.greatest(F.ceil(n / BUCKET_ROWS), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")
    sizes = sizes.select(
        "band",
        "bucket",
        F.col("main.component").alias("main"),
        blocks(F.col("n") - F.col("main.n"), F.col("bytes") - F.col("main.bytes")).alias("leading"),
        blocks(F.col("n"), F.col("bytes")).alias("all"),
    )
    rows = rest.join(sizes, ["band", "bucket"]).withColumn("leads", F.col("component") != F.col("main"))
    rows = rows.withColumn("own_i", F.pmod(F.xxhash64("node", "band"), "leading").cast("int"))
    rows = rows.withColumn("own_j", F.pmod(F.xxhash64("band", "node"), "all").cast("int"))
    place = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    met = F.transform(F.sequence(F.lit(0), F.col("leading") - 1), lambda i: place(i, F.col("own_j")))
    led = F.transform(F.sequence(F.lit(0), F.col("all") - 1), lambda j: place(F.col("own_i"), j))
    places = F.when(F.col("leads"), F.array_union(met, led)).otherwise(met)
    placed = rows.withColumn("place", F.explode(places)).select(
        "band",
        "bucket",
        "place.i",
        "place.j",
        (F.col("leads") & (F.col("own_i") == F.col("place.i"))).alias("as_leader"),
        (F.col("own_j") == F.col("place.j")).alias("as_member"),
        "leads",
        "node",
        "component",
        "bytes",
    )
    placed = stored(spark, "blocks", placed)
    held = sets.join(nodes.select("node", "weight", "bands", "drawn"), "node")

    def pair(group: pa.Table) -> pa.Table:
        places = [group.column(c).to_numpy() for c in ("j", "i", "bucket", "band")]
        node, weight, component, band = (group.column(c).to_numpy() for c in ("node", "weight", "component", "band"))
        leads, leader, member = (np.asarray(group.column(c)) for c in ("leads", "as_leader", "as_member"))
        drawn = np.frombuffer(b"".join(group.column("drawn").to_pylist()), np.uint32).reshape(len(node), -1)
        bands = pc.list_flatten(group.column("bands")).to_numpy().reshape(len(node), -1)
        weights, ends = _values(group.column("weights"), np.float64)
        distinct, shingle = np.unique(_values(group.column("keys"), np.uint64)[0], return_inverse=True)
        mine = np.zeros(len(distinct))  # the leader's weights by shingle
        found = []
        for rows in _groups(*places):
            members = rows[member[rows]]
            members = members[np.argsort(weight[members], kind="stable")]
            heavy, codes, k = weight[members], drawn[members], band[rows[0]]
            for i in rows[leader[rows]]:
                # A little wider than the exact bound, which follows.
                lo = np.searchsorted(heavy, weight[i] * (similarity - 1e-6))
                hi = np.searchsorted(heavy, weight[i] / (similarity - 1e-6), "right")
                near = members[lo:hi]
                ok = (codes[lo:hi] == drawn[i]).mean(axis=1) >= AGREED
                ok &= (component[near] != component[i]) & _similar_weight(weight[i], weight[near], similarity)
                ok &= ~leads[near] | (node[near] > node[i])  # two that lead meet twice
                near = near[ok]
                near = near[~(bands[near, :k] == bands[i, :k]).any(axis=1)]  # met in an earlier band
                if not len(near):
                    continue
                counts = ends[near + 1] - ends[near]
                heads = np.cumsum(counts) - counts
                at = np.repeat(ends[near] - heads, counts) + np.arange(counts.sum())
                own = slice(ends[i], ends[i + 1])
                mine[shingle[own]] = weights[own]
                shared = np.add.reduceat(np.minimum(mine[shingle[at]], weights[at]), heads)
                mine[shingle[own]] = 0
                near = near[shared >= similarity * (weight[i] + weight[near] - shared) - 1e-9]
                found.append((np.full(len(near), node[i]), node[near]))
        return _pairs(found)

    size = placed.agg(F.sum(F.col("bytes") + 400)).first()[0] or 0
    key = F.pmod(F.xxhash64("band", "bucket", "i", "j"), F.lit(1 + size // (2 * BLOCK_BYTES)))
    rows = placed.drop("bytes").join(held, "node")
    return rows.groupBy(key).applyInArrow(pair, "a long, b long").distinct()


def links(spark: SparkSession, docs: DataFrame, nodes: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """Verified pairs (a, b) of nodes. ``nodes``: node, doc_id, tag, weight, bands, drawn; each stands for a row of ``docs``."""
    active = nodes.select("node", "weight", F.posexplode("bands").alias("band", "bucket"))
    active = stored(spark, "buckets", active)
    alone = active.groupBy("band", "bucket").count().filter("count = 1").select("band", "bucket")
    # Only texts of nodes that share a bucket with another can ever be compared.
    shared = stored(spark, "shared", active.join(alone, ["band", "bucket"], "left_anti"))
    wanted = nodes.join(shared.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "tag")
    wanted = broadcast_if_small(stored(spark, "involved", wanted))
    source = docs.select(F.col("doc_id").cast("long").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    source = source.withColumn("hash", F.xxhash64("text"))
    same = F.col("doc").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("tag"))
    texts = stored(spark, "texts", source.join(wanted, same).select("node", "text")).dropDuplicates(["node"])

    pairs = stored(spark, "pairs", _led(shared, similarity))
    judged = stored(spark, "judged", verified(spark, pairs, texts, idf, similarity))
    rest = labels = None
    for leaders in LEADERS:
        if labels is None:  # or new links have come
            labels = components(spark, judged.filter("similar").select("a", "b"))
            rows = (shared if rest is None else rest.drop("component")).join(labels, "node", "left")
            rows = _several(rows.withColumn("component", F.coalesce("component", "node")))
            if rest is None:
                rows = stored(spark, "rest", rows).join(nodes.select("node", "drawn"), "node")
            rest = stored(spark, "rest", rows)
        n, largest = rest.groupBy("band", "bucket").count().agg(F.sum("count"), F.max("count")).first()
        if not n:
            break
        if leaders is None:
            left = texts.join(rest.select("node").distinct(), "node", "left_semi")
            sets = stored(spark, "sets", shingle_sets(left, idf))
            found = _across(spark, rest.select("band", "bucket", "node", "component"), nodes, sets, similarity)
            judged = judged.unionByName(stored(spark, "judged", found.withColumn("similar", F.lit(True))))
            break
        pairs = _with_leaders(rest, 1 + n // 20_000, leaders, similarity)
        pairs = pairs.join(judged, ["a", "b"], "left_anti")
        fresh = stored(spark, "judged", verified(spark, stored(spark, "pairs", pairs), texts, idf, similarity))
        judged = judged.unionByName(fresh)
        if leaders >= largest and largest <= BUCKET_ROWS:
            break
        if not fresh.filter("similar").isEmpty():
            labels = None
    return judged.filter("similar").select("a", "b")


def classes(spark: SparkSession, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Per row of ``docs``: doc_id, tag, class_id (least doc_id of its class), class_size (rows), n_links, kept.

    Texts without words, null ones too, are alone in their class. ``kept`` marks one row of each class, the first by
    (doc_id, tag); rows equal in id and text share that mark. ``n_links`` counts the verified links of the text that were used
    to join its class, not the texts like it: pairs of one component are not compared. A null id counts as first; a class of null ids only has
    a null class_id. Other columns are not read. No rows give no rows.
    """
    idf = inverse_frequencies(docs)
    signed = stored(spark, "signatures", signatures(docs, idf))
    copies = signed.filter("digest is not null").groupBy("digest").agg(
        F.min(F.struct("doc_id", "tag")).alias("first"),
        *[F.first(c).alias(c) for c in ("weight", "bands", "drawn")],  # alike in all rows of a digest
    )
    nodes = copies.select(
        F.monotonically_increasing_id().alias("node"), "digest", "first.doc_id", "first.tag", "weight", "bands", "drawn"
    )
    nodes = stored(spark, "nodes", nodes)
    found = stored(spark, "links", links(spark, docs, nodes, idf, similarity))
    ends = found.distinct().select(F.explode(F.array("a", "b")).alias("node"))
    degrees = ends.groupBy("node").agg(F.count("*").alias("n_links"))
    joined = nodes.select("node", "digest").join(components(spark, found), "node", "left").join(degrees, "node", "left")
    joined = joined.select("digest", F.coalesce("component", "node").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    rows = signed.select("doc_id", "tag", "digest").join(joined, "digest", "left")
    # Texts without words get a class of their own.
    lone = F.struct(F.lit(-1).cast("long").alias("component"), "doc_id", "tag")
    shared = F.struct("component", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("tag"))
    rows = rows.withColumn("group", F.when(F.col("component").isNull(), lone).otherwise(shared))
    rows = stored(spark, "members", rows.select("group", "doc_id", "tag", F.coalesce("n_links", F.lit(0)).alias("n_links")))
    heads = rows.groupBy("group").agg(F.min(F.struct("doc_id", "tag")).alias("head"), F.count("*").alias("class_size"), F.min("doc_id").alias("class_id"))
    return rows.join(heads, "group").select(
        "doc_id", "tag", "class_id", "class_size", "n_links", (F.struct("doc_id", "tag") == F.col("head")).alias("kept")
    )


def dedup(spark: SparkSession, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay: one of each class, with all its columns. Equal rows count as one."""
    found = stored(spark, "classes", classes(spark, docs, similarity))
    gone = stored(spark, "dropped", found.filter("not kept").select(F.col("doc_id").alias("gone_id"), "tag").distinct())
    key = fresh_name(docs, "tag")
    rows = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    gone = broadcast_if_small(gone.withColumnRenamed("tag", "gone_tag"))
    same = rows["doc_id"].cast("long").eqNullSafe(gone["gone_id"]) & (rows[key] == gone["gone_tag"])
    rows = rows.join(gone, same, "left_anti")
    twice = found.filter("kept").groupBy("doc_id", "tag").count().filter("count > 1")
    if not twice.isEmpty():
        rows = rows.dropDuplicates(["doc_id", key])
    return rows.select(*docs.columns)


def expected_recall(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    """Probability that a pair of this similarity shares a bucket."""
    return 1 - math.pow(1 - similarity**rows, bands)
