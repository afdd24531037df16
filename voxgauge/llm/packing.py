"""Best-fit packing of token pieces into sequences of bounded length, after a dominance reduction.

Only the length of a piece matters, and there are at most ``capacity`` lengths. So the instance is the number of pieces
of each length, however many pieces there are: it is counted on the executors, solved once for all pieces, and the
solution, a list of patterns with how often each is used, is applied to the pieces by their rank within their length.

Reduction (Martello and Toth): for a piece ``j``, a set with ``j`` that no other set with ``j`` can beat is fixed, since
an optimal packing with it exists:

- ``j`` alone, if nothing fits beside it;
- ``j`` and the largest ``p`` that fits, if they fill a sequence, or if no two pieces fit beside ``j``, or if no three
  do and no pair that fits is longer than ``p``.

It repeats until nothing more can be fixed. What is left goes by best fit, longest first.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from voxgauge.llm.arrow_text import byte_slices, giving_back
from voxgauge.llm.shared import broadcast_if_small, stored
from voxgauge.llm.token_ids import default_tokenizer, worker_encoder

CAPACITY = 1024
#: Bytes of text that are encoded at once, and pieces that are placed at once.
TEXT_BYTES, PLACED_ROWS = 1 << 18, 1000

PIECE_SCHEMA = "part int, rank long, doc_id long, piece int, start long, length int, ids binary"

#: A pattern: (length, how many of it) in order of place; and the number of sequences that follow it.
Pattern = tuple[tuple[tuple[int, int], ...], int]


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Sets fixed by dominance, and the counts that remain."""
    left = {n: c for n, c in counts.items() if c > 0}
    fixed: list[Pattern] = []
    lengths = sorted(left)

    def take(use: dict[int, int], times: int) -> None:
        fixed.append((tuple(sorted(use.items(), reverse=True)), times))
        for n, k in use.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
                lengths.remove(n)

    def smallest(n_items: int, without: int) -> int | None:
        """Sum of the ``n_items`` shortest pieces, one of length ``without`` put aside; None if there are too few."""
        total = 0
        for n in lengths:
            k = min(n_items, left[n] - (n == without))
            total += n * k
            n_items -= k
            if not n_items:
                return total
        return None

    def longest_pair(room: int, without: int) -> int:
        there = [n for n in lengths if left[n] > (n == without)]
        i, k, best = 0, len(there) - 1, 0
        while i <= k:
            a, b = there[i], there[k]
            if a + b > room:
                k -= 1
                continue
            if i < k or left[a] - (a == without) > 1:
                best = max(best, a + b)
            i += 1
        return best

    changed = True
    while changed:
        changed = False
        for j in sorted(left, reverse=True):
            while left.get(j):
                room = capacity - j
                at = bisect_right(lengths, room) - 1
                if at >= 0 and lengths[at] == j and left[j] == 1:
                    at -= 1
                if at < 0:
                    take({j: 1}, left[j])
                    changed = True
                    break
                p = lengths[at]
                two, three = smallest(2, j), smallest(3, j)
                sure = p == room or two is None or two > room
                if not sure and (three is None or three > room):
                    sure = longest_pair(room, j) <= p
                if not sure:
                    break
                changed = True
                if p == j:
                    take({j: 2}, left[j] // 2)
                else:
                    # A pair that fills up, or beside which nothing fits, stays the best choice as pieces go.
                    times = min(left[j], left[p]) if p == room or two is None or two > room else 1
                    take({j: 1, p: 1}, times)
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit, longest first, on groups of equal sequences; the same result as piece by piece."""
    rooms: list[int] = []  # free lengths that occur, ascending
    groups: dict[int, list[Pattern]] = {}

    def put(pattern: tuple, times: int, room: int) -> None:
        if room not in groups:
            groups[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        groups[room].append((pattern, times))

    for n in sorted(counts, reverse=True):
        todo = counts[n]
        while todo > 0:
            at = bisect_left(rooms, n)
            if at < len(rooms):
                room = rooms[at]
                pattern, times = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, pattern, times = capacity, (), todo
            each = room // n
            full = min(times, todo // each)
            todo -= full * each
            if full:
                put((*pattern, (n, each)), full, room - each * n)
            if todo and full < times and todo < each:
                put((*pattern, (n, todo)), 1, room - todo * n)
                full, todo = full + 1, 0
            if full < times and pattern:
                put(pattern, times - full, room)
    return [p for g in groups.values() for p in g]


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    fixed, left = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(left, capacity)


def places(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length, in order of rank: first rank, first sequence, how many in one sequence, place of the first."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for n, k in pattern:
            rows.setdefault(n, []).append((ranks.get(n, 0), sequence, k, offset))
            ranks[n] = ranks.get(n, 0) + k * times
            offset += n * k
        sequence += times
    return {n: tuple(np.array(c, np.int64) for c in zip(*r)) for n, r in rows.items()}


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Pieces of at most ``capacity`` ids; of a longer document the first piece takes what the full ones leave.

    ``part`` and ``rank`` number the pieces of one length within a task, so the result must be written before use. A null
    text counts as empty and is one piece, the end id. Equal rows are documents of their own.
    """
    path = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = worker_encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for lo, hi, data, offsets in byte_slices(batch.column(1), TEXT_BYTES):
                ids, bounds = encoder.encode(data, offsets)
                flat = np.insert(ids, bounds[1:], end_id).astype("<u4")
                size = np.diff(bounds) + 1
                n = -(-size // capacity)
                doc = np.repeat(np.arange(hi - lo), n)
                piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                first = size - (n - 1) * capacity
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[doc], capacity)
                order = np.argsort(length, kind="stable")
                sorted_ = length[order]
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order)) - np.searchsorted(sorted_, sorted_) + seen[sorted_]
                seen += np.bincount(length, minlength=capacity + 1)
                ends = np.concatenate([[0], np.cumsum(length) * 4]).astype(np.int32)
                payload = pa.Array.from_buffers(
                    pa.binary(), len(length), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(flat.tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(doc), part, np.int32)),
                        pa.array(rank),
                        batch.column(0).slice(lo, hi - lo).take(pa.array(doc)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length.astype(np.int32)),
                        payload,
                    ],
                    [c.split()[0] for c in PIECE_SCHEMA.split(", ")],
                )

    return docs.select("doc_id", "text").mapInArrow(giving_back(cut, keeps=True), PIECE_SCHEMA)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to written pieces; columns part, rank and length say which they are.

    No piece is lost and no sequence exceeds ``capacity``. Of an empty table nothing comes. Which of several equal
    lengths goes where is by part and rank.
    """
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = counts.groupBy("length").agg(F.sum("n"))  # at most ``capacity`` rows
    solution = places(plan({n: c for n, c in histogram.collect()}, capacity))
    joined = pieces.join(broadcast_if_small(bases), ["part", "length"])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(lo, PLACED_ROWS) for b in batches for lo in range(0, b.num_rows, PLACED_ROWS)):
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() + batch.column("base").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length):
                mine = np.flatnonzero(length == n)
                first, begin, each, at = solution[int(n)]
                k = np.searchsorted(first, rank[mine], "right") - 1
                bin_, slot = np.divmod(rank[mine] - first[k], each[k])
                sequence[mine], offset[mine] = begin[k] + bin_, at[k] + slot * n
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"],
            )

    return joined.mapInArrow(
        giving_back(assign), "doc_id long, piece int, start long, length int, ids binary, sequence_id long, offset long"
    )


def pack(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Placed pieces of ``docs`` (doc_id, text; other columns are ignored)."""
    return place(stored(spark, "pieces", token_pieces(docs, capacity, tokenizer)), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """One row per sequence: its ids, little-endian, and its documents in order of place."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    joined = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), ""))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        joined.alias("ids"),
        F.transform("parts", lambda p: p.dropFields("ids")).alias("documents"),
    )
