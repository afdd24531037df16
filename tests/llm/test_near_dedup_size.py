"""Near copies of one text that are not near one another: what the search for links exchanges grows with the texts."""

import random

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("voxgauge.llm.near_dedup")

from voxgauge.llm import near_dedup
from voxgauge.llm.arrow_text import WordHasher, byte_slices

N = 240


def texts() -> list[str]:
    """Edits of one text in four words each: similar pairs among them are rare; every sixth is an edit of the one before it."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(4000)}" for _ in range(200)]
    out = []
    for i in range(N):
        words = out[-1].split() if i % 6 == 5 else list(base)
        for at in rng.sample(range(200), 1 if i % 6 == 5 else 4):
            words[at] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_edits_of_one_text_are_not_paired_by_rows(spark, monkeypatch):
    said = texts()
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    counted, verified = [], near_dedup.verified

    def counting(spark, pairs, *rest):
        counted.append(pairs.count())
        return verified(spark, pairs, *rest)

    monkeypatch.setattr(near_dedup, "verified", counting)
    got = {r.doc_id: r for r in near_dedup.classes(spark, docs).collect()}

    idf = near_dedup.inverse_frequencies(docs)
    _, _, data, offsets = next(iter(byte_slices(pa.array(said))))
    keys, weights, starts, _ = near_dedup.weighted_shingles(data, offsets, idf, WordHasher())
    keys = keys & np.uint64((1 << 54) - 1)
    own = [dict(zip(keys[a:b].tolist(), weights[a:b].tolist())) for a, b in zip(starts, starts[1:])]
    total = [sum(x.values()) for x in own]
    like, close = set(), 0
    for i in range(N):
        for j in range(i):
            shared = sum(min(w, own[j][s]) for s, w in own[i].items() if s in own[j])
            close += shared >= 0.5 * (total[i] + total[j] - shared)
            if shared >= near_dedup.SIMILARITY * (total[i] + total[j] - shared):
                like.add((j, i))
    assert close > N * N / 8 and N / 6 <= len(like) < 2 * N  # a quadratic number of pairs is close, few are similar
    group = list(range(N))
    for j, i in sorted(like) * 8:
        group[i] = group[j] = min(group[i], group[j])
    assert {i: r.class_id for i, r in got.items()} == dict(enumerate(group))
    assert sum(counted) < 30 * N


def test_blocks_of_few_bytes_find_the_same_links(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(texts()[:60])), "doc_id long, text string")
    rows = lambda: sorted(map(tuple, near_dedup.classes(spark, docs).drop("tag").collect()))
    whole = rows()
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 20_000)
    assert rows() == whole
