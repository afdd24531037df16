"""Passages that other documents hold already, by content-defined chunks and their digests.

A gear hash rolls over the bytes of a text. A chunk begins where the hash is the least within ``RADIUS`` bytes on either
side, among the places where a word begins (among all characters where none does). So whether a place is a cut
depends on the bytes around it alone: an insertion moves no cut beyond its neighbourhood, equal passages are cut
alike wherever they stand, and chunks are at least ``RADIUS`` bytes and mostly about twice that.

Chunks are counted by a 96-bit digest, combined before the shuffle. Of equal chunks the one first by (doc_id, place)
stays. Runs of repeated chunks of at least ``MIN_RUN`` bytes are taken out of the text; shorter ones, such as a licence
line, stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from voxgauge.llm.arrow_text import VISIBLE, byte_slices, giving_back
from voxgauge.llm.shared import fresh_name, stored

RADIUS = 24
#: Bytes that the gear hash looks back on.
GEAR_WINDOW = 16
#: Bytes that a run of repeated chunks must have to be taken out.
MIN_RUN = 100

_GEAR = np.random.default_rng(9).integers(1, 1 << 32, 256, dtype=np.uint32)
_NONE = np.uint32(0xFFFFFFFF)


def chunk_starts(data: np.ndarray, offsets: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Where chunks start, and per text the number of chunks before it (one more entry at the end)."""
    n, pad = len(offsets) - 1, max(radius, GEAR_WINDOW) + 1
    if not len(data):
        return np.empty(0, np.int64), np.zeros(n + 1, np.int64)
    shift = np.repeat(np.arange(1, n + 1) * pad, np.diff(offsets))
    at = np.arange(len(data)) + shift
    size = len(data) + (n + 1) * pad
    gear = np.zeros(size, np.uint32)
    gear[at] = _GEAR[data]
    k = 1
    while k < GEAR_WINDOW:  # the rolling hash (h << 1) + gear of the last GEAR_WINDOW bytes
        gear[k:] += gear[:-k] << np.uint32(k)
        k *= 2
    visible = VISIBLE[data]
    word = np.zeros(len(data), bool)
    word[1:] = visible[1:] & ~visible[:-1]
    character = (data & 0xC0) != 0x80
    score = np.full(size, _NONE)
    score[at] = np.where(character, (gear[at] >> np.uint32(2)) | np.where(word, np.uint32(0), np.uint32(1 << 30)), _NONE)
    least, k = score.copy(), 1  # of score[i : i + radius]
    while k < radius:
        step = min(k, radius - k)
        least[:-step] = np.minimum(least[:-step], least[step:])
        k += step
    own = score[at]
    cut = (own != _NONE) & (least[at - radius] > own) & (least[at + 1] >= own)
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(cut)
    return starts, np.searchsorted(starts, offsets)


def ids_repeat(docs: DataFrame) -> bool:
    """Whether several rows share an id; read from the ids alone."""
    return not docs.groupBy("doc_id").count().filter("count > 1").isEmpty()


def _tag(text: Column, needed: bool) -> Column:
    """31 bits of a text's hash, which tell apart rows of one id; 0 where no id repeats, as random bits take room."""
    return F.xxhash64(text).bitwiseAND(0x7FFFFFFF) if needed else F.lit(0).cast("long")


def chunks(docs: DataFrame, tagged: bool) -> DataFrame:
    """Chunks of ``docs``: digest (d1, d2), doc_id, place (tag of the text in the upper half, first byte in the lower)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    tag = _tag(text, tagged).alias("tag")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tag, text.alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags = batch.column(1).to_numpy()
            for lo, hi, data, offsets in byte_slices(batch.column(2)):
                starts, before = chunk_starts(data, offsets)
                if not len(starts):
                    continue
                whole, ends = data.tobytes(), np.append(starts[1:], len(data))
                digest = hashlib.blake2b
                found = b"".join(
                    [digest(whole[a:b], digest_size=12).digest() for a, b in zip(starts.tolist(), ends.tolist())]
                )
                parts = np.frombuffer(found, [("d1", "<i8"), ("d2", "<i4")])
                doc = np.repeat(np.arange(hi - lo), np.diff(before))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.ascontiguousarray(parts["d1"])),
                        pa.array(np.ascontiguousarray(parts["d2"])),
                        batch.column(0).slice(lo, hi - lo).take(pa.array(doc)),
                        pa.array((tags[lo:hi][doc] << 32) + starts - offsets[doc]),
                    ],
                    ["d1", "d2", "doc_id", "place"],
                )

    return rows.mapInArrow(giving_back(cut), "d1 long, d2 int, doc_id long, place long")


def repeated_chunks(spark: SparkSession, docs: DataFrame, tagged: bool) -> DataFrame:
    """Chunks that are not the first of their digest: doc_id, tag, start, first_doc_id."""
    found = stored(spark, "chunks", chunks(docs, tagged))
    firsts = found.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "place")).alias("first"))
    firsts = firsts.filter("n > 1").select("d1", "d2", "first")
    own = F.struct("doc_id", "place")
    return found.join(firsts, ["d1", "d2"]).filter(own != F.col("first")).select(
        "doc_id",
        F.shiftright("place", 32).alias("tag"),
        F.col("place").bitwiseAND(0xFFFFFFFF).cast("int").alias("start"),
        F.col("first.doc_id").alias("first_doc_id"),
    )


def dedup(spark: SparkSession, docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """Columns of ``docs``, text without repeated passages, and removed_bytes, spans, first_doc_ids.

    ``spans``: start and length in bytes of the UTF-8 text as it was; ``first_doc_ids``: the documents whose chunks stay
    instead, ascending. Null texts stay null and empty ones empty; a null id comes before all others. Rows of one id
    with different texts are documents of their own; rows equal in id and text are one document, and each keeps what
    it keeps. Columns of the three names are replaced, other columns kept.
    """
    names = ["removed_bytes", "spans", "first_doc_ids"]
    docs = docs.drop(*names)
    key, tag, marks = (fresh_name(docs, x) for x in ("key", "tag", "marks"))
    text = F.coalesce(F.col("text"), F.lit(""))
    tagged = ids_repeat(docs)
    left = docs.withColumns({key: F.col("doc_id").cast("long"), tag: _tag(text, tagged)})
    per_text = repeated_chunks(spark, docs, tagged).distinct().groupBy("doc_id", "tag").agg(
        F.sort_array(F.collect_list(F.struct("start", "first_doc_id"))).alias(marks)  # bounded by the text
    )
    right = per_text.select(F.col("doc_id").alias("right_key"), F.col("tag").alias("right_tag"), marks)
    same = left[key].eqNullSafe(right["right_key"]) & (left[tag] == right["right_tag"])
    rows = left.join(right, same, "left").select(*docs.columns, marks)
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())])
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("removed_bytes", T.LongType()),
            T.StructField("spans", T.ArrayType(span)),
            T.StructField("first_doc_ids", T.ArrayType(T.LongType())),
        ]
    )
    columns, text_at = docs.columns, docs.columns.index("text")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from (batch.slice(lo, hi - lo) for lo, hi, _, _ in byte_slices(batch.column(text_at)))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            n = batch.num_rows
            texts, marked = batch.column(text_at), batch.column(len(columns))
            spans: list[list[dict]] = [[] for _ in range(n)]
            origins: list[list[int | None]] = [[] for _ in range(n)]
            new: dict[int, str] = {}
            for i in np.flatnonzero(np.asarray(marked.is_valid())):
                at = marked[int(i)].as_py()
                data = np.frombuffer(texts[int(i)].as_py().encode(), np.uint8)
                starts, _ = chunk_starts(data, np.array([0, len(data)]))
                ends = np.append(starts[1:], len(data))
                k = np.searchsorted(starts, [m["start"] for m in at])
                cut = np.flatnonzero(np.diff(k) != 1) + 1
                whole, kept, last, first = data.tobytes(), [], 0, set()
                for run in np.split(np.arange(len(k)), cut):
                    a, b = int(starts[k[run[0]]]), int(ends[k[run[-1]]])
                    if b - a >= min_run:
                        spans[i].append({"start": a, "length": b - a})
                        first |= {at[j]["first_doc_id"] for j in run}
                        kept.append(whole[last:a])
                        last = b
                if spans[i]:
                    new[int(i)] = b"".join([*kept, whole[last:]]).decode()
                    origins[i] = sorted(first, key=lambda x: (x is not None, x or 0))
            out = [batch.column(c) for c in range(len(columns))]
            if new:
                old = texts.to_pylist()
                out[text_at] = pa.array([new.get(i, t) for i, t in enumerate(old)], texts.type)
            removed = [sum(s["length"] for s in x) for x in spans]
            kinds = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])), pa.list_(pa.int64())
            more = [pa.array(removed, pa.int64()), pa.array(spans, kinds[0]), pa.array(origins, kinds[1])]
            yield pa.RecordBatch.from_arrays([*out, *more], [*columns, *names])

    return rows.mapInArrow(giving_back(remove), schema)
