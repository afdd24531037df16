"""Words, shingles, token ids, token files and packing against plain Python."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from voxgauge.llm import packing, queries, token_files
from voxgauge.llm.arrow_text import ALNUM, LOWER, VISIBLE, WordHasher, byte_slices, shingles, word_bounds
from voxgauge.llm.token_ids import WordEncoder, default_tokenizer

SF = "/root/testdata/sf0.001"
ODD_TEXTS = [
    "", None, " a", "a  b", "a\nb", "a \n b", "x\n\ny", "don't stop, now.", "\0a b", "日本 語,\tx", "a'S 's ,. .,",
    "<|endoftext|> hi", " a b  c", "a  b c, d", "3,5. x²,", "a.", ",", ".", "a ,", "», a», é, b", " ", "\n",
    "a   b,,", "été,\nété. ", "x" * 3000, "word " * 4000,
]


def random_text(rng, n):
    return "".join(rng.choice(["a", "B", "é", " ", " ", "\n", ".", ",", "7", "'s", "zw", "\t", "界"]) for _ in range(n))


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def table(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("limit", [1, 40, 1 << 20])
def test_slices_hold_every_text(limit):
    texts = ["ab", None, "", "é" * 30, "c", None]
    for column in (pa.array(texts, pa.string()), pa.array(["x", *texts, "y"], pa.large_string()).slice(1, len(texts))):
        got = {}
        for lo, hi, data, offsets in byte_slices(column, limit):
            for i in range(lo, hi):
                got[i] = data[offsets[i - lo] : offsets[i - lo + 1]].tobytes().decode()
        assert got == {i: t or "" for i, t in enumerate(texts)}
    assert list(byte_slices(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("table_, pattern", [(ALNUM, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), (VISIBLE, r"[^\x20\x09-\x0D]+")])
def test_words_and_shingles(table_, pattern):
    rng = random.Random(1)
    texts = [random_text(rng, rng.randint(0, 60)) for _ in range(60)]
    hasher, seen = WordHasher(), {}
    for _, _, data, offsets in byte_slices(pa.array(texts)):
        starts, ends, bounds = word_bounds(data, offsets, table_)
        hashes = hasher(data, starts, ends)
        runs, before = shingles(hashes, bounds, 3)
        for i, t in enumerate(texts):
            words = re.findall(pattern, t)
            assert bounds[i + 1] - bounds[i] == len(words)
            for w, h in zip(words, hashes[bounds[i] : bounds[i + 1]]):
                low = bytes(LOWER[np.frombuffer(w.encode(), np.uint8)])
                assert seen.setdefault(low, h) == h
            expected = max(len(words) - 2, min(len(words), 1))
            assert before[i + 1] - before[i] == expected
            for k, r in enumerate(runs[before[i] : before[i + 1]]):
                assert seen.setdefault(tuple(bytes(LOWER[np.frombuffer(w.encode(), np.uint8)]) for w in words[k : k + 3]), r) == r
    assert len(set(seen.values())) == len(seen)


def test_ids_equal_the_tokenizers(reference):
    rng = random.Random(2)
    texts = ODD_TEXTS + [random_text(rng, rng.randint(0, 80)) for _ in range(400)]
    encoder = WordEncoder(default_tokenizer())
    for _ in range(2):  # the second time from the kept pieces
        for lo, hi, data, offsets in byte_slices(pa.array(texts), 5000):
            ids, bounds = encoder.encode(data, offsets)
            for i in range(lo, hi):
                assert ids[bounds[i - lo] : bounds[i - lo + 1]].tolist() == reference(texts[i]), texts[i]


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_segments_round_trip(n):
    rng = np.random.default_rng(n)
    for top in (1, 2, 50_257, 2**32 - 1):
        ids = rng.integers(0, top, n, dtype=np.uint32)
        ids[::97] = top - 1  # outliers
        payload = token_files.encode_segment(ids)
        assert (token_files.decode_segment(payload) == ids).all()
        for k in range(-(-n // 512)):
            assert (token_files.decode_block(payload, k) == ids[k * 512 : (k + 1) * 512]).all()


def test_token_files(spark, reference, tmp_path):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id"), (3, "again three"), (3, "again three")]
    random.Random(3).shuffle(rows)
    path = str(tmp_path / "tokens")
    token_files.write_token_files(table(spark, rows).withColumn("shard", F.lit("clash")), path)
    got = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    start = 0
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert r["start"] == start and r["n_tokens"] == len(ids)
        assert ids in [[*reference(t), 0] for d, t in rows if d == r["doc_id"]]
        start += len(ids)
    empty = str(tmp_path / "none")
    token_files.write_token_files(table(spark, []), empty)
    assert token_files.read_token_files(spark, empty).count() == 0


def test_token_files_query(spark, reference):
    start = 0
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    for r in sorted(queries.QUERIES["op3_token_files"](spark, SF).collect()):
        ids = np.array([*reference(texts[r["doc_id"]]), 0], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def plain_best_fit(counts, capacity):
    rooms = []
    for n in sorted(counts, reverse=True):
        for _ in range(counts[n]):
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else capacity) - n)
    return len(rooms)


def fewest(lengths, capacity):
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i] and rooms[k] not in rooms[:k]:
                go(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, capacity - lengths[i]])

    go(0, [])
    return best


def test_plan_against_piece_by_piece():
    for seed in range(120):
        rng = random.Random(seed)
        capacity, counts = rng.choice([10, 20, 50, 100]), {}
        for _ in range(rng.randint(1, 60)):
            n = rng.randint(1, capacity)
            counts[n] = counts.get(n, 0) + 1
        assert sum(t for _, t in packing.best_fit(dict(counts), capacity)) == plain_best_fit(counts, capacity)
        used = {}
        for pattern, times in packing.plan(counts, capacity):
            assert sum(n * k for n, k in pattern) <= capacity
            for n, k in pattern:
                used[n] = used.get(n, 0) + k * times
        assert used == counts


def test_reduction_keeps_the_optimum():
    for seed in range(60):
        rng = random.Random(seed)
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = {n: lengths.count(n) for n in lengths}
        fixed, left = packing.reduce_by_dominance(counts, 20)
        rest = sorted((n for n, c in left.items() for _ in range(c)), reverse=True)
        assert sum(t for _, t in fixed) + fewest(rest, 20) == fewest(lengths, 20)


def held(placed, texts, reference, capacity):
    by_sequence, by_doc = {}, {}
    for r in placed:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, rows in by_doc.items():
        ids, start = [*reference(texts[doc]), 2], 0
        for k, r in enumerate(sorted(rows, key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, start)
            assert k == 0 or r["length"] == capacity
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids[start : start + r["length"]]
            start += r["length"]
        assert start == len(ids)
    return len(by_sequence)


def test_pack(spark, reference):
    texts = dict(enumerate(ODD_TEXTS))
    docs = table(spark, list(texts.items())).withColumn("part", F.lit("clash"))
    placed = packing.pack(spark, docs, capacity=64)
    rows = placed.collect()
    n = held(rows, texts, reference, 64)
    assert n <= math.ceil(sum(r["length"] for r in rows) / 64) + 1
    for s in packing.sequences(placed).collect():
        parts = sorted((r["offset"], bytes(r["ids"])) for r in rows if r["sequence_id"] == s["sequence_id"])
        assert bytes(s["ids"]) == b"".join(p for _, p in parts)
    twice = packing.pack(spark, table(spark, [(1, "same"), (1, "same"), (None, None)])).collect()
    assert len(twice) == 3 and len({(r["sequence_id"], r["offset"]) for r in twice}) == 3
    assert packing.pack(spark, table(spark, [])).count() == 0


def test_packing_query(spark, reference):
    rows = queries.QUERIES["op2_best_fit_packing"](spark, SF).collect()
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    sizes = {}
    for r in rows:
        ids = np.array([*reference(texts[r["doc_id"]]), 2], "<u4")
        part = ids[r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        sizes[r["sequence_id"]] = sizes.get(r["sequence_id"], 0) + r["length"]
    assert max(sizes.values()) <= 1024
    assert len(sizes) <= math.ceil(sum(sizes.values()) / 1024) * 1.02 + 1
