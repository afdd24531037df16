"""Python workers live on from stage to stage: what a stage holds or keeps there is bounded, whatever Spark's batches are."""

import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("voxgauge.llm.substring_dedup")

from voxgauge.llm import substring_dedup
from voxgauge.llm.arrow_text import SLICE_BYTES, giving_back


def held_mb() -> float:
    return int(re.search(r"Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


def test_freed_memory_goes_back_at_the_end_of_a_task():
    pins = []

    def run(batches):
        for batch in batches:
            parts = [np.ones(8_000) for _ in range(3_000)]  # 190 MB in parts that an allocator keeps
            pins.append(np.ones(8_000))
            yield batch
            del parts

    before = held_mb()
    assert len(list(giving_back(run)(iter([pa.record_batch({"x": [1]})])))) == 1
    assert held_mb() - before < 60


def test_passages_are_removed_in_pieces(spark, monkeypatch):
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"{i} begins here. {passage} and number {i} ends " + f"filler{i} " * 3_000, "x") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    sizes, real = [], type(docs).mapInArrow

    def spying(df, fn, schema):
        if "removed_bytes" not in str(schema):
            return real(df, fn, schema)
        sizes.extend(b.nbytes for b in fn(iter(df.toArrow().combine_chunks().to_batches())))
        return real(df, fn, schema)

    monkeypatch.setattr(type(docs), "mapInArrow", spying)
    got = {r.doc_id: r for r in substring_dedup.dedup(spark, docs).collect()}
    assert sum(sizes) > 3 * SLICE_BYTES and max(sizes) < 1.5 * SLICE_BYTES
    assert len(got) == 120 and got[0].removed_bytes == 0 and passage in got[0].text
    assert all(passage not in r.text and r.removed_bytes > 0 and r.first_doc_ids for i, r in got.items() if i)
