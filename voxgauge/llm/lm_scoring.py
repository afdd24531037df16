"""Log-probability of texts under a smoothed word bigram model, run as a weighted automaton with failure arcs.

States are the words of the training texts, the start of a text, and the empty context. From state h an arc on word w exists
if "h w" occurs in training; it weighs log10((c(h w) + m p(w)) / (c(h) + m)). Otherwise the failure arc, log10(m /
(c(h) + m)), leads to the empty context, where w weighs log10 p(w), p being the add-0.1 unigram model, unknown words
included. So all words sum to one in every state. A text is read once, left to right, its end included; the state
is the last word, or the empty context where that word is no state. ``m`` is the one of ``PRIORS`` under which the
training texts, each bigram left out of its own count, are most probable.

The automaton grows with the corpus, so no task holds it whole. Texts are taken in blocks; a block sends its distinct
words and bigrams, with their counts in its training texts, to the tasks that add them up by range of hash, and gets the
totals back in the order it sent them: exactly the arcs and states its own texts visit. A frequent word or bigram is one
entry per block however often it occurs. Words are told apart by 64-bit hashes, bigrams by 56 bits, as what is sent grows with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from voxgauge.llm.arrow_text import VISIBLE, WordHasher, byte_slices, mix, word_bounds
from voxgauge.llm.shared import stored

#: Bytes of text in a block.
BLOCK_BYTES = 8 << 20
#: Bytes of text for each task that adds up counts.
RANGE_BYTES = 16 << 20
#: Added to every count of the unigram model.
ADDED = 0.1
PRIORS = (1.0, 10.0, 100.0, 1000.0)

_END, _START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)

BLOCK_SCHEMA = (
    "block long, kind int, range int, keys binary, counts binary, "
    "doc_ids array<long>, sizes array<int>, train array<boolean>, words binary, sequence binary"
)
_BLOCK_TYPES = [
    pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(),
    pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.binary(), pa.binary(),
]


def _press(x: np.ndarray) -> bytes:
    """Bytes of the numbers plane by plane, compressed; planes of zeros take no room."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpress(data: bytes, kind: type) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(flat.reshape(size, -1).T).view(kind).ravel()


def _press_sorted(x: np.ndarray) -> bytes:
    return _press(np.diff(x, prepend=np.uint64(0)))


def _unpress_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpress(data, np.uint64), dtype=np.uint64)


def _tokens(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, with the end after each text; and tokens per text."""
    starts, ends, bounds = word_bounds(data, offsets, VISIBLE)
    return np.insert(hasher(data, starts, ends), bounds[1:], _END), np.diff(bounds) + 1


def _bigrams(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.concatenate([[_START], tokens[:-1]])
    before[(np.cumsum(sizes) - sizes)] = _START
    return mix(before * np.uint64(0xD1342543DE82EF95) + tokens) >> np.uint64(8)


def blocks(docs: DataFrame, ranges: int) -> DataFrame:
    """Per block a row of kind 0 with its texts as places in the list of its words, most frequent first; and rows of its
    words (kind 1) and bigrams (kind 2): keys of one range of hashes, ascending, with their counts in training."""
    names = [c.strip().split()[0] for c in BLOCK_SCHEMA.split(", ")]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("train", F.lit(False)).alias("train"), text.alias("text"))
    edges = {k: (np.arange(1, ranges, dtype=object) * (1 << bits) // ranges).astype(np.uint64) for k, bits in ((1, 64), (2, 56))}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, number = WordHasher(seed=3), TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0

        def block() -> pa.RecordBatch:
            tokens, sizes, train = (np.concatenate(c) for c in zip(*parts))
            learned = np.repeat(train, sizes)
            out: list[list] = [[] for _ in names]

            def row(*values) -> None:
                for column, value in zip(out, values):
                    column.append(value)

            def add(kind: int, keys: np.ndarray, counts: np.ndarray) -> None:
                cuts = np.searchsorted(keys, edges[kind])
                for k, (x, n) in enumerate(zip(np.split(keys, cuts), np.split(counts, cuts))):
                    if len(x):
                        row(number, kind, k, _press_sorted(x), _press(n.astype(np.uint32)), *[None] * 5)

            words, which = np.unique(tokens, return_inverse=True)
            add(1, words, np.bincount(which[learned], minlength=len(words)))
            order = np.argsort(-np.bincount(which), kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            texts = _press(words[order]), _press(place[which])
            pairs, which = np.unique(_bigrams(tokens, sizes), return_inverse=True)
            add(2, pairs, np.bincount(which[learned], minlength=len(pairs)))
            row(number, 0, -1, None, None, ids, sizes.tolist(), train.tolist(), *texts)
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, _BLOCK_TYPES)], names)

        for batch in batches:
            train = np.asarray(batch.column(1))
            for lo, hi, data, offsets in byte_slices(batch.column(2)):
                parts.append((*_tokens(data, offsets, hasher), train[lo:hi]))
                ids += batch.column(0).slice(lo, hi - lo).to_pylist()
                held += len(data)
                if held >= BLOCK_BYTES:
                    yield block()
                    number, held, ids, parts = number + 1, 0, [], []
        if ids:
            yield block()

    return rows.mapInArrow(send, BLOCK_SCHEMA)


def totals(sent: DataFrame) -> DataFrame:
    """Each row's keys' counts over all blocks, in the row's order (reply). Rows with block -1: kinds and tokens of a range."""

    def add_up(group: pa.Table) -> pa.Table:
        block, kind, range_ = (group.column(c).to_pylist() for c in ("block", "kind", "range"))
        keys = [_unpress_sorted(x) for x in group.column("keys").to_pylist()]
        counts = [_unpress(x, np.uint32) for x in group.column("counts").to_pylist()]
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(which.max() + 1, np.int64)
        np.add.at(total, which, np.concatenate(counts))
        replies = [_press(x) for x in np.split(total[which], np.cumsum([len(k) for k in keys])[:-1])]
        m = len(block)
        return pa.table(
            {
                "block": pa.array([*block, -1], pa.int64()),
                "kind": pa.array([*kind, kind[0]], pa.int32()),
                "range": pa.array([*range_, range_[0]], pa.int32()),
                "reply": pa.array([*replies, None], pa.binary()),
                "kinds": pa.array([*[None] * m, int((total > 0).sum())], pa.int64()),
                "tokens": pa.array([*[None] * m, int(total.sum())], pa.int64()),
            }
        )

    rows = sent.filter("kind > 0").select("block", "kind", "range", "keys", "counts")
    return rows.groupBy("kind", "range").applyInArrow(
        add_up, "block long, kind int, range int, reply binary, kinds long, tokens long"
    )


def weights(
    sizes: np.ndarray, unigram: np.ndarray, bigram: np.ndarray, n: int, v: int, texts: int, prior: float, left_out: bool
) -> np.ndarray:
    """Log10 weight of the path from each token's state over the token; ``left_out``: each token out of its own counts.

    ``unigram``, ``bigram``: training counts of each token and of it with the one before; ``texts``: training texts.
    """
    context = np.concatenate([[0], unigram[:-1]]).astype(np.float64)
    context[np.cumsum(sizes) - sizes] = texts
    if left_out:
        unigram, bigram, context = (np.maximum(x - 1, 0) for x in (unigram, bigram, context))
    p = (unigram + ADDED) / (n + ADDED * (v + 1))
    return np.log10((bigram + prior * p) / (context + prior))


def scores(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, train): doc_id, train, n_tokens, n_known, train_tokens, base_score, score.

    A null text is empty: its only token is the end. A null ``train`` counts as false. Without training texts every token
    is unknown and both scores are 0 plus the number of tokens times log10 of 1. Rows may repeat; other columns are not read.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    sent = stored(spark, "lm-blocks", blocks(docs, 1 + size // RANGE_BYTES))
    answers = stored(spark, "lm-totals", totals(sent))
    known = answers.filter("block = -1 and kind = 1").agg(F.sum("kinds"), F.sum("tokens")).first()
    v, n = known[0] or 0, known[1] or 0
    train_docs = sent.filter("kind = 0").select(F.explode("train").alias("t")).filter("t").count()

    texts = sent.filter("kind = 0").select(
        "block", "kind", "range", F.lit(None).cast("binary").alias("reply"), "doc_ids", "sizes", "train", "words", "sequence"
    )
    replies = answers.filter("block >= 0").select("block", "kind", "range", "reply")
    both = texts.unionByName(replies, allowMissingColumns=True)

    def score(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["kind"], r["range"]))
        own = rows[0]
        by_kind = [np.concatenate([_unpress(r["reply"], np.int64) for r in rows if r["kind"] == k]) for k in (1, 2)]
        words, sequence = _unpress(own["words"], np.uint64), _unpress(own["sequence"], np.uint32)
        sizes = np.array(own["sizes"])
        unigram = by_kind[0][np.argsort(np.argsort(words))][sequence]  # replies are in the order of the hashes
        _, which = np.unique(_bigrams(words[sequence], sizes), return_inverse=True)
        bigram, starts = by_kind[1][which], np.cumsum(sizes) - sizes
        of_text = lambda x: np.add.reduceat(x, starts)

        def by_prior(left_out: bool) -> pa.Array:
            found = [of_text(weights(sizes, unigram, bigram, n, v, train_docs, m, left_out)) for m in PRIORS]
            return pa.array(np.stack(found).T.tolist(), pa.list_(pa.float64()))

        return pa.table(
            {
                "doc_id": pa.array(own["doc_ids"], pa.int64()),
                "train": pa.array(own["train"], pa.bool_()),
                "n_tokens": pa.array(sizes.astype(np.int64)),
                "n_known": pa.array(of_text((unigram > 0).astype(np.int64))),
                "base_score": pa.array(of_text(np.log10((unigram + ADDED) / (n + ADDED * (v + 1))))),
                "by_prior": by_prior(False),
                "left_out": by_prior(True),
            }
        )

    found = both.groupBy("block").applyInArrow(
        score,
        "doc_id long, train boolean, n_tokens long, n_known long, base_score double, "
        "by_prior array<double>, left_out array<double>",
    )
    found = stored(spark, "lm-scores", found)
    sums = [F.sum(F.when(F.col("train"), F.col("left_out")[k])) for k in range(len(PRIORS))]
    fit = [x if x is not None else 0.0 for x in found.agg(*sums).first()]
    best = int(np.argmax(fit))
    return found.select(
        "doc_id",
        "train",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        F.col("by_prior")[best].alias("score"),
    )
