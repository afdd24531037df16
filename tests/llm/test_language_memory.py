"""Language identification takes a line of numbers per text, so texts are handled by their number too; workers carry nothing over."""

import sys
import tracemalloc
import types

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("voxgauge.llm.language_id")

from voxgauge.llm import language_id
from voxgauge.llm.arrow_text import WORKER_STORE, WordHasher, giving_back


def spied(monkeypatch, kind, n):
    """Peak MB and rows of each piece that a function given to mapInArrow makes of ``n`` short texts in one batch."""
    seen, real = [], kind.mapInArrow

    def spying(df, fn, schema):
        columns = {"doc_id": range(n), "text": ["the word " + str(i) for i in range(n)], "lang": ["en"] * n, "letters": [True] * n}
        columns |= {"k": pa.array(range(n), pa.int32()), "rounds": pa.array([1] * n, pa.int32())}
        tracemalloc.start()
        rows = [b.num_rows for b in fn(iter([pa.record_batch({c: columns[c] for c in df.columns})]))]
        seen.append((tracemalloc.get_traced_memory()[1] / 1e6, rows))
        tracemalloc.stop()
        return real(df, fn, schema)

    monkeypatch.setattr(kind, "mapInArrow", spying)
    return seen


def test_many_short_texts_take_little(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a few words and {i}", "en") for i in range(40)], "doc_id long, text string, lang string")
    seen = spied(monkeypatch, type(docs), 4000)
    model = language_id.fit(docs)
    rows = language_id.predict(docs, model).collect()
    assert [r.lang_pred for r in rows] == ["en"] * 40
    (_, counted), (_, fitted), (_, judged) = seen
    assert counted == [language_id.BUCKETS + 1] and sum(fitted) == 8000 and sum(judged) == 4000
    assert max(*fitted, *judged) <= language_id.TEXT_ROWS
    assert max(mb for mb, _ in seen) < 60  # a line for every text at once takes 130 MB and more


def test_slices_change_no_vector():
    texts = [f"text {i} of some words".encode() * (1 + i % 7) for i in range(300)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    idf = np.ones(language_id.BUCKETS, np.float32)
    whole = language_id.vectors(data, offsets, idf)
    for lo, hi in ((0, 1), (1, 129), (129, 300)):
        part = language_id.vectors(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], idf)
        assert (part == whole[lo:hi]).all()


def test_a_text_is_judged_alike_in_any_company(spark):
    texts = [(i, " ".join(f"word{(i * 7 + j) % 50}" for j in range(5 + i % 30)), "en" if i % 2 else "fr") for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").coalesce(1)
    judged = language_id.predict(docs, language_id.fit(docs))
    many = sorted(judged.collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        assert sorted(judged.select("*").collect()) == many
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_kept_things_go_when_another_operator_begins(monkeypatch):
    monkeypatch.setitem(sys.modules, WORKER_STORE, types.ModuleType(WORKER_STORE))
    assert list(giving_back(iter, keeps=True)(iter([1, 2]))) == [1, 2] and WORKER_STORE in sys.modules
    assert list(giving_back(iter)(iter([1, 2]))) == [1, 2] and WORKER_STORE not in sys.modules


def test_a_hasher_is_as_large_as_its_slices():
    hasher, starts, ends = WordHasher(), np.array([0, 40]), np.array([30, 70])
    data = np.frombuffer(b"words and more words, " * 20_000, np.uint8)
    few = hasher(data[:100], starts, ends)
    assert len(hasher._up) <= WordHasher.STEP
    hasher(data, np.array([0]), np.array([len(data)]))
    assert len(data) < len(hasher._up) <= len(data) + WordHasher.STEP
    assert (hasher(data[:100], starts, ends) == few).all() and (WordHasher()(data, starts, ends) == few).all()


def test_pipeline_sends_few_texts_at_once_and_resets_the_session(spark, monkeypatch):
    import corpus_pipeline as pipeline

    seen = []

    def stage(spark, docs, sf_dir):
        sizes = docs.mapInArrow(lambda batches: (pa.record_batch({"n": [b.num_rows]}) for b in batches), "n long")
        seen.append(max(r.n for r in sizes.collect()))
        return docs

    docs = spark.range(3000).selectExpr("id as doc_id", "'a text' as text").coalesce(1)
    monkeypatch.setattr(pipeline, "documents", lambda spark, sf_dir: docs)
    monkeypatch.setattr(pipeline, "STAGES", [(name, pipeline.small_batches(stage)) for name, _ in pipeline.STAGES[:2]])
    before = spark.conf.get(pipeline.BATCH_ROWS)
    assert pipeline.run(spark, "").count() == 3000
    assert seen == [int(pipeline.TEXT_ROWS)] * 2 and spark.conf.get(pipeline.BATCH_ROWS) == before
