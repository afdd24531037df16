"""Texts of Arrow batches as byte arrays, cut into slices of bounded size, and vectorised words and shingles.

Words are runs of bytes of a given class. Bytes of 0x80 and more, the parts of non-ASCII characters, are either all in
the class or none, so runs of bytes are runs of characters.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: Name under which a worker process keeps things from task to task (functions that travel by value lose globals).
WORKER_STORE = "voxgauge_worker_store"


def _table(separators: list[int]) -> np.ndarray:
    t = np.ones(256, bool)
    t[separators] = False
    return t


#: Word bytes: digits, lower-cased letters and all that is not ASCII. (Upper case counts once it is lower-cased.)
ALNUM = _table([b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)])
#: Word bytes: all but the space, tab and line ends of ASCII.
VISIBLE = _table([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


BatchMap = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Hands the memory that this process has freed but still holds back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library than glibc
        pass


def giving_back(run: BatchMap, keeps: bool = False) -> BatchMap:
    """``run``, which ends a task by giving back what it freed: Spark keeps its Python workers from stage to stage.

    What another operator's tasks have kept in the worker goes before it begins, unless ``run`` ``keeps`` it for its own use.
    """

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps and sys.modules.pop(WORKER_STORE, None):
            give_back()
        yield from run(batches)
        give_back()

    return mapped


def byte_slices(
    column: pa.Array, limit: int = SLICE_BYTES, rows: int = 1 << 30
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """At most ``rows`` rows ``lo`` to ``hi``, their UTF-8 bytes and offsets (from 0); a null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    if column.null_count:  # bytes below a null are not text
        lengths = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
        if lengths.sum() != offsets[-1] - offsets[0]:
            data = np.concatenate([data[a : a + k] for a, k in zip(offsets[:-1], lengths)])
            offsets = np.concatenate([[0], np.cumsum(lengths)])
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n, lo + rows)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_bounds(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and per text the number of words before it (one more entry at the end)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class WordHasher:
    """64-bit hashes of words: a polynomial over random byte values modulo 2**64, from prefix sums, then mixed."""

    BASE = 0x9E3779B97F4A7C15
    #: Powers are kept for the longest slice so far, rounded up to so many bytes.
    STEP = 1 << 16

    def __init__(self, seed: int = 1, lower: bool = True):
        values = np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._values = values[LOWER] if lower else values
        self._grow(1)

    def _grow(self, n: int) -> None:
        n = -(-n // self.STEP) * self.STEP
        self._up = _powers(self.BASE, n)
        self._down = _powers(pow(self.BASE, -1, 1 << 64), n)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) + 1 > len(self._up):
            self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._values[data] * self._up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self._down[starts] + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``k`` words per text and the number of them before each text.

    A text of fewer words, but not none, is one shorter run.
    """
    counts = np.diff(bounds)
    runs = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    before = np.concatenate([[0], np.cumsum(runs)])
    if not before[-1]:
        return np.empty(0, np.uint64), before
    at = np.arange(before[-1]) + np.repeat(bounds[:-1] - before[:-1], runs)
    left = np.repeat(bounds[1:], runs) - at
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    total = np.zeros(len(at), np.uint64)
    for j in range(k):
        total = total * np.uint64(0xD6E8FEB86659FD93) + np.where(j < left, padded[at + j], np.uint64(0))
    return mix(total), before


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places ``begin``, ``begin + 1`` and so on, ``size`` of them, one group after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)
