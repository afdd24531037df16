"""Toxicity by weak supervision: the label model on simulated voters, the operator on odd rows and the query."""

import numpy as np

from voxgauge.llm import toxicity
from voxgauge.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def simulate(accuracies, prior=0.3, n=20000, copy_of=None, seed=1):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < prior).astype(int)
    votes = []
    for a in accuracies:
        right = rng.random(n) < a
        vote = np.where(right, y, 1 - y) + 1  # 1: votes 0, 2: votes 1
        votes.append(np.where(rng.random(n) < 0.3, 0, vote))  # abstains three times in ten
    if copy_of is not None:
        votes.append(votes[copy_of].copy())
    votes = np.array(votes).T
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    return y, votes, patterns, counts.astype(float)


def test_label_model_recovers_accuracies_without_labels():
    accuracies = [0.9, 0.8, 0.7, 0.85]
    _, _, patterns, counts = simulate(accuracies)
    model = toxicity.fit_label_model(patterns, np.full(len(patterns), -1), counts, list("abcd"))
    assert abs(model.prior - 0.3) < 0.03
    for j, a in enumerate(accuracies):
        assert abs(model.accuracy(j) - a) < 0.03
    assert model.groups == [[0], [1], [2], [3]]


def test_copied_voter_is_grouped_and_not_counted_twice():
    y, votes, patterns, counts = simulate([0.9, 0.65, 0.8], copy_of=1)
    model = toxicity.fit_label_model(patterns, np.full(len(patterns), -1), counts, list("abcd"))
    assert [1, 3] in model.groups
    posterior = model.posterior(votes)
    assert ((posterior > 0.5) == y).mean() > 0.85


def test_gold_labels_fix_their_rows():
    _, _, patterns, counts = simulate([0.9, 0.8])
    gold = np.where(np.arange(len(patterns)) % 2 == 0, 1, -1)
    model = toxicity.fit_label_model(patterns, gold, counts, list("ab"))
    assert 0 < model.prior < 1


def test_odd_rows(spark):
    long = "calm words here " * 60000
    rows = [
        (1, "you are an idiot, a worthless clown!!!"), (2, "Thank you for the lovely afternoon by the river."),
        (3, None), (4, ""), (5, long), (5, long), (6, "idiot moron idiot"), (7, "IDIOT MORON STUPID LOSER YOU ARE!!!"),
        (8, "please take a seat, the meeting starts soon"), (9, "¿eres un idiota y un payaso?"), (None, "no id here"),
    ] + [(100 + i, f"a quiet line number {i} about gardens and trees and rivers") for i in range(40)]
    rows += [(200 + i, f"you idiot, worthless trash number {i}") for i in range(15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", toxicity.F.lit("clash")).withColumn("weight", toxicity.F.lit(3))
    labels = spark.createDataFrame([(i, 1) for i in range(200, 215)] + [(100 + i, 0) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.fit(docs.filter("doc_id is null or doc_id != 1"), labels)
    got = toxicity.score(docs, model, drop_text=True).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "label", "weight", "toxicity_score"}
    score = {}
    for r in got:
        assert 0 <= r.toxicity_score <= 1 and r.label == "clash" and r.weight == 3
        score.setdefault(r.doc_id, set()).add(round(r.toxicity_score, 12))
    assert len(score[5]) == 1 and score[3] == score[4]  # repeated rows alike; a null text is an empty one
    assert min(score[1]) > 0.5 and min(score[6]) > 0.5 and max(score[2]) < 0.5 and max(score[8]) < 0.5


def test_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    model = toxicity.fit(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.toxicity_score for r in toxicity.score(docs, model).collect()] == [0.5]
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_registered_query(spark):
    got = QUERIES["op11_toxicity"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    assert got.score.between(0, 1).all() and set(got.predicted) <= {0, 1}
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().merge(got, on="doc_id")
    train = labels[~labels.held_out]
    assert (train.predicted == train.toxic).mean() > 0.8


def test_features_written_once_serve_learning_and_scoring(spark):
    rows = [(i, ["you idiot, shut up!!!", "thanks, the lamp is fine", "STOP SHOUTING AT ALL OF US NOW", "", None][i % 5], "x") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _pattern string")  # a column of that name is carried along
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(0, 40, 2)], "doc_id long, toxic int")
    texts = docs.drop("_pattern")
    ready = toxicity.with_features(texts)
    assert "text" not in ready.columns
    want = toxicity.score(docs, toxicity.fit(texts, labels)).select("doc_id", "toxicity_score", "_pattern").orderBy("doc_id").collect()
    got = toxicity.score(ready, toxicity.fit(ready, labels)).orderBy("doc_id").collect()
    assert [(r[0], r[1]) for r in want] == [tuple(r) for r in got] and {r[2] for r in want} == {"x"}
