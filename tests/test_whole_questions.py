"""Searches ask every row: ids that a rule on them would leave out ask like all others."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from voxgauge.catalog import QUERIES, SQL

N = 30
IDS = [100 * i + 1 + i % 99 for i in range(N)]  # none is divisible by 100


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """A table folder of few rows: vectors around two directions, documents of shared and own words, some labels."""
    root = tmp_path_factory.mktemp("whole")
    vectors = [[1.0, i / N, (i % 7) / 9] if i % 2 else [i / N, 1.0, (i % 5) / 9] for i in range(N)]
    texts = [f"word{i % 3} word{i % 5} word{i % 7} rare{i // 2}" for i in range(N)]
    tables = {
        "embeddings": {
            "vec_id": pa.array(IDS, pa.int64()),
            "embedding": pa.array(vectors, pa.list_(pa.float32())),
            "label": pa.array([i % 10 for i in range(N)], pa.int32()),
        },
        "documents": {
            "doc_id": pa.array(IDS, pa.int64()),
            "text": pa.array(texts),
            "lang": pa.array(["en" if i % 2 else "de" for i in range(N)]),
            "source": pa.array([f"src{i % 20}" for i in range(N)]),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        },
        "labels": {
            "doc_id": pa.array(IDS[::2], pa.int64()),
            "quality": pa.array([i % 2 for i in range(len(IDS[::2]))], pa.int32()),
            "toxic": pa.array([i % 3 == 0 for i in range(len(IDS[::2]))]).cast(pa.int32()),
        },
    }
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), root / f"{name}.parquet")
    return str(root)


@pytest.mark.parametrize("name", ["tfidf_neighbours", "tfidf_topk", "knn_top5", "relevance_gate", "knn_squared_distance", "knn_filtered", "knn_ivf", "grounded_answers"])
def test_every_row_asks(spark, tables, name):
    assert {r.question_id for r in QUERIES[name](spark, tables).select("question_id").collect()} == set(IDS)
    assert "% 100" not in SQL.get(name, "")


def test_summaries_count_every_question(spark, tables):
    swept = QUERIES["threshold_sweep"](spark, tables).orderBy("threshold").collect()
    ranges = QUERIES["distance_ranges"](spark, tables).collect()
    assert swept[-1].kept_on_topic + swept[-1].kept_off_topic == N  # 0.75 keeps all of these
    assert sum(r.n for r in ranges) == N
    assert not any("% 100" in SQL[name] for name in ("threshold_sweep", "distance_ranges"))


def test_every_row_asks_the_approximate_search(spark, tables, tmp_path):
    table = pq.read_table(f"{tables}/embeddings.parquet")
    ids = [25 * i + 25 * (i % 4 == 3) for i in range(1, N + 1)]  # its cells are around ids divisible by 25; some ids come twice
    pq.write_table(table.set_column(0, "vec_id", pa.array(ids, pa.int64())), tmp_path / "embeddings.parquet")
    found = {r.question_id for r in QUERIES["knn_approximate"](spark, str(tmp_path)).collect()}
    assert any(i % 100 for i in found) and "% 100" not in SQL["knn_approximate"]


def test_every_case_is_scored(spark, tables):
    """Blank questions (label 9) are cases too, those without an annotation (label 7) are not."""
    cases = {i for n, i in enumerate(IDS) if n % 10 != 7}
    assert {r.question_id for r in QUERIES["precision_mrr"](spark, tables).collect()} == cases
    for name in ("eval_by_category", "evaluation_run"):
        assert [r.n for r in QUERIES[name](spark, tables).collect() if r.overall] == [len(cases)]
    assert QUERIES["no_answer_accuracy"](spark, tables).first().n == sum(n % 10 in (0, 9) for n in range(N))


def test_prompts_of_every_answer(spark, tables):
    answered = QUERIES["grounded_answers"](spark, tables).where("status = 'success'")
    told = {r.question_id for r in answered.collect()}
    assert told and {r.question_id for r in QUERIES["prompts"](spark, tables).collect()} == told
    assert QUERIES["judge_messages"](spark, tables).count() > 0


def test_no_sql_has_a_query_set():
    assert not [name for name, sql in SQL.items() if "_id % 100 = 0" in sql]
