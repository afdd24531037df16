"""Token files: ids of all texts in document order, in blocks of a patched frame of reference.

A file row is a segment: whole documents in ascending id order, their ids one after the other, cut into blocks. Of a
block the minimum is subtracted; the rest is packed at the width that a given share of its values needs, and the
values that need more are listed as exceptions with their place. The header indexes where each block starts, so one
block can be read without the others.

Segment, little-endian: ``PFR1``, ids (u32), block size (u32), block starts (u32 each, one more at the end), blocks. A
block: minimum (u32), width (u8), exceptions (u16), packed bits, exception places (u16), exception residuals (u32).

The segments are the ``payload`` column of Parquet files, so Spark writes and reads them in any store it knows, and
a lost executor's task is simply repeated. Rows are range-partitioned by document id; ``shard`` is the number of
the partition and ascends with the ids.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from voxgauge.llm.arrow_text import byte_slices
from voxgauge.llm.token_ids import default_tokenizer, worker_encoder

BLOCK = 512
#: Share of a block's values that the packed width must hold.
PERCENTILE = 0.9
#: A segment is closed once it holds this many ids.
SEGMENT_IDS = 1 << 18

FILE_SCHEMA = (
    "shard int, segment int, first_id long, n_ids long, doc_ids array<long>, doc_tokens array<int>, payload binary"
)


def _width(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def encode_segment(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    n = len(ids)
    count = -(-n // block)
    filled = np.zeros(count * block, np.uint32)
    filled[:n] = ids
    if n:
        filled[n:] = ids[-1]
    grid = filled.reshape(count, block)
    low = grid.min(axis=1) if count else np.empty(0, np.uint32)
    rest = grid - low[:, None]
    rank = min(block - 1, int(np.ceil(percentile * block)) - 1)
    width = _width(np.partition(rest, rank, axis=1)[:, rank]) if count else np.empty(0, np.int64)
    bodies: list[bytes] = [b""] * count
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        bits = ((rest[rows][:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)
        packed = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
        over = rest[rows] >= np.uint32(1 << w) if w < 32 else np.zeros(rest[rows].shape, bool)
        for i, row in enumerate(rows):
            at = np.flatnonzero(over[i])
            head = struct.pack("<IBH", low[row], w, len(at))
            bodies[row] = head + packed[i].tobytes() + at.astype("<u2").tobytes() + rest[row][at].astype("<u4").tobytes()
    index = np.cumsum([0, *map(len, bodies)]).astype("<u4")
    return struct.pack("<4sII", b"PFR1", n, block) + index.tobytes() + b"".join(bodies)


def decode_block(payload: bytes, k: int) -> np.ndarray:
    """Ids of block ``k`` alone, found by the index."""
    magic, n, block = struct.unpack_from("<4sII", payload)
    if magic != b"PFR1":
        raise ValueError("not a token segment")
    count = -(-n // block)
    begin = struct.unpack_from("<I", payload, 12 + 4 * k)[0] + 12 + 4 * (count + 1)
    low, w, exceptions = struct.unpack_from("<IBH", payload, begin)
    begin += 7
    size = (block * w + 7) // 8
    bits = np.unpackbits(np.frombuffer(payload, np.uint8, size, begin), count=block * w, bitorder="little")
    values = bits.reshape(block, w).astype(np.uint32) @ (np.uint32(1) << np.arange(w, dtype=np.uint32))
    values = values.astype(np.uint32)
    begin += size
    at = np.frombuffer(payload, "<u2", exceptions, begin)
    values[at] = np.frombuffer(payload, "<u4", exceptions, begin + 2 * exceptions)
    return (values + np.uint32(low))[: min(block, n - k * block)]


def decode_segment(payload: bytes) -> np.ndarray:
    """All ids of a segment; blocks of equal width are unpacked together."""
    _, n, block = struct.unpack_from("<4sII", payload)
    count = -(-n // block)
    if not count:
        return np.empty(0, np.uint32)
    data = np.frombuffer(payload, np.uint8)
    begin = np.frombuffer(payload, "<u4", count, 12).astype(np.int64) + 12 + 4 * (count + 1)
    heads = data[begin[:, None] + np.arange(7)]
    low = np.ascontiguousarray(heads[:, :4]).view("<u4")[:, 0]
    width = heads[:, 4].astype(np.int64)
    exceptions = np.ascontiguousarray(heads[:, 5:7]).view("<u2")[:, 0].astype(np.int64)
    out = np.empty((count, block), np.uint32)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        size = (block * w + 7) // 8
        packed = data[begin[rows][:, None] + 7 + np.arange(size)]
        bits = np.unpackbits(packed, axis=1, count=block * w, bitorder="little").reshape(len(rows), block, w)
        values = np.zeros((len(rows), block), np.uint32)
        for b in range(w):
            values |= bits[:, :, b].astype(np.uint32) << np.uint32(b)
        out[rows] = values
    for row in np.flatnonzero(exceptions):
        k, p = int(exceptions[row]), int(begin[row] + 7 + (block * width[row] + 7) // 8)
        out[row, np.frombuffer(payload, "<u2", k, p)] = np.frombuffer(payload, "<u4", k, p + 2 * k)
    return (out + low[:, None]).reshape(-1)[:n]


def token_segments(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Segments of the ids of ``docs`` (doc_id, text; other columns are ignored), each text followed by ``end_id``.

    A null text counts as empty; a null id comes first; equal ids are ordered by a hash of their texts. An empty table
    gives no segments. A text longer than a segment is one segment.
    """
    path = tokenizer or default_tokenizer()
    text = F.coalesce("text", F.lit(""))
    ordered = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = worker_encoder(path), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        number = first = held = 0
        doc_ids: list[int | None] = []
        sizes: list[int] = []
        parts: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            row = [[shard], [number], [first], [held], [doc_ids], [sizes], [encode_segment(np.concatenate(parts))]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            names = [c.split()[0] for c in FILE_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for lo, hi, data, offsets in byte_slices(batch.column(1)):
                ids, bounds = encoder.encode(data, offsets)
                for i in range(lo, hi):
                    parts += [ids[bounds[i - lo] : bounds[i - lo + 1]], end]
                    doc_ids.append(keys[i])
                    sizes.append(int(bounds[i - lo + 1] - bounds[i - lo]) + 1)
                    held += sizes[-1]
                    if held >= SEGMENT_IDS:
                        yield close()
                        number, first, held = number + 1, first + held, 0
                        doc_ids, sizes, parts = [], [], []
        if doc_ids:
            yield close()

    return ordered.mapInArrow(segments, FILE_SCHEMA)


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0) -> None:
    token_segments(docs, tokenizer, end_id).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before it), ids (little-endian u32), n_tokens."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row per shard, far fewer than documents
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = files.join(F.broadcast(bases), "shard").select(
        (F.col("base") + F.col("first_id")).alias("start"), "doc_ids", "doc_tokens", "payload"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                start, doc_ids, sizes = (batch.column(c)[k].as_py() for c in range(3))
                data = decode_segment(batch.column(3)[k].as_py()).astype("<u4").tobytes()
                ends = np.cumsum(sizes)
                begins = ends - sizes
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(start + begins, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([data[4 * a : 4 * b] for a, b in zip(begins, ends)], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return rows.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
