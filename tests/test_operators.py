import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import voxgauge.operators.knn as knn
from voxgauge.operators import brands as br, embed as em, engines as en, language as lg, sentiment as st
from voxgauge.plans import answer as qa, enrich, evaluate as ev

DOCS = "/root/testdata/sf0.001/documents.parquet"


# --- Nearest neighbours ---------------------------------------------------------------------------


def brute(q, c, ids, k, metric, wish=None, tags=None, skip=None):
    q, c = np.asarray(q, float), np.asarray(c, float)
    if metric == "cosine":
        unit = lambda m: np.divide(m, np.linalg.norm(m, axis=1, keepdims=True), out=np.zeros_like(m), where=np.linalg.norm(m, axis=1, keepdims=True) > 0)
        q, c = unit(q), unit(c)
    d = ((q[:, None] - c[None]) ** 2).sum(2) if metric == "l2sq" else 1 - q @ c.T
    d = np.round(d, 9)
    out = {}
    for i in range(len(q)):
        ok = [
            j for j in range(len(c))
            if (wish is None or wish[i] == 0 or wish[i] & tags[j]) and (skip is None or skip[i] != ids[j])
        ]
        out[i] = [ids[j] for j in sorted(ok, key=lambda j: (d[i, j], ids[j]))[:k]]
    return out


def frames(spark, q, c, ids, wish=None, tags=None, skip=None, kind="float"):
    qp = pd.DataFrame({"question_id": range(len(q)), "embedding": [list(map(float, v)) for v in q]})
    cp = pd.DataFrame({"review_id": ids, "embedding": [list(map(float, v)) for v in c]})
    qs, cs = f"question_id long, embedding array<{kind}>", f"review_id {'string' if isinstance(ids[0], str) else 'long'}, embedding array<{kind}>"
    if wish is not None:
        qp["wish"], cp["tags"] = wish, tags
        qs, cs = qs + ", wish int", cs + ", tags int"
    if skip is not None:
        qp["skip"] = skip
        qs += f", skip {'string' if isinstance(ids[0], str) else 'long'}"
    return spark.createDataFrame(qp, qs).repartition(2), spark.createDataFrame(cp, cs).repartition(3)


def result(df):
    out = {}
    for r in df.orderBy("question_id", "rank").collect():
        out.setdefault(r.question_id, []).append(r.review_id)
    return out


def clustered(rng, n, dim, centres):
    return (centres[rng.integers(0, len(centres), n)] + rng.normal(0, 0.05, (n, dim))).astype(np.float32)


@pytest.mark.parametrize("metric", ["cosine", "l2sq", "dot"])
@pytest.mark.parametrize("route", ["broadcast", "shuffle"])
def test_nearest_equals_brute_force(spark, monkeypatch, metric, route):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    q, c = clustered(rng, 40, 8, centres), clustered(rng, 500, 8, centres)
    c[100:280] = c[7]  # a third of the corpus is one vector
    c[3], q[5] = 0, 0
    ids = [f"r{i:03d}" for i in rng.permutation(len(c))]
    tags = rng.choice([1, 2, 4, 8], len(c)).tolist()
    wish = rng.choice([0, 1, 4], len(q)).tolist()
    skip = [ids[7] if i % 2 else None for i in range(len(q))]
    if route == "shuffle":
        monkeypatch.setattr(knn, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(knn, "KEY_ROWS", 20)
    qd, cd = frames(spark, q, c, ids, wish, tags, skip)
    got = knn.nearest(qd, cd, k=5, metric=metric, cells=12)
    assert result(got) == brute(q, c, ids, 5, metric, wish, tags, skip)


def test_nearest_prunes_cells_without_loss(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 6)) * 5
    q, c = clustered(rng, 30, 6, centres), clustered(rng, 1500, 6, centres)
    qd, cd = frames(spark, q, c, list(range(len(c))))
    held = cd.select(F.col("review_id").alias("id"), F.col("embedding").alias("vec"), F.lit(0).alias("tags"))
    grid = knn._grid(held, len(c), "l2sq", 40)
    visit = knn._visits(q.astype(float), np.zeros(len(q), int), [None] * len(q), grid, 5, None)
    assert visit.mean() < 0.5
    assert result(knn.nearest(qd, cd, metric="l2sq", cells=40)) == brute(q, c, list(range(len(c))), 5, "l2sq")


def test_many_equal_vectors_stay_bounded():
    rng = np.random.default_rng(6)
    q, c = rng.normal(size=(50, 4)), np.repeat(rng.normal(size=(3, 4)), 400, axis=0)
    for metric in ("cosine", "l2sq", "dot"):
        if metric == "cosine":
            q, c = knn._scale(q, metric), knn._scale(c, metric)
        rows, cols, dist = knn._near(q, c, None, 5, metric)
        assert len(rows) <= 2 * 5 * len(q)
        got = knn._best(rows, cols, dist, 5)
        want = brute(q, c, list(range(len(c))), 5, metric)
        assert got[1].reshape(50, 5).tolist() == [want[i] for i in range(50)]


def test_large_norms_fall_back_to_double_precision():
    rng = np.random.default_rng(7)
    q, c = 1e4 + rng.normal(size=(20, 8)), 1e4 + rng.normal(size=(900, 8))
    got = knn._best(*knn._near(q, c, None, 5, "l2sq"), 5)
    want = brute(q, c, list(range(len(c))), 5, "l2sq")
    assert got[1].reshape(20, 5).tolist() == [want[i] for i in range(20)]


def test_nearest_small_and_empty_corpus(spark):
    q, c = np.eye(3)[:2], np.eye(3)
    qd, cd = frames(spark, q, c, [1, 2, 3], kind="double")
    assert {k: len(v) for k, v in result(knn.nearest(qd, cd, k=5)).items()} == {0: 3, 1: 3}
    assert knn.nearest(qd, cd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        knn.nearest(qd, cd, metric="hamming")


def test_sample_of_a_large_corpus_is_bounded(spark):
    big = spark.range(60_000).select("id", F.array(F.rand(1).cast("float"), F.rand(2).cast("float")).alias("vec"), F.lit(0).alias("tags"))
    assert len(knn._grid(big, 60_000, "l2sq", None).vectors) == knn.SAMPLE


def test_approximate_search_recall(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(10, 16))
    q, c = clustered(rng, 60, 16, centres), clustered(rng, 2000, 16, centres)
    qd, cd = frames(spark, q, c, list(range(len(c))))
    exact, near = result(knn.nearest(qd, cd, cells=30)), result(knn.nearest(qd, cd, cells=30, probes=6))
    recall = np.mean([len(set(exact[i]) & set(near[i])) / 5 for i in exact])
    assert recall > 0.9
    assert knn._grid(cd.select(F.col("review_id").alias("id"), F.col("embedding").alias("vec"), F.lit(0).alias("tags")), 2000, "cosine", 1500).cells == 1500
    with pytest.raises(ValueError):
        knn.nearest(qd, cd, probes=2)


def test_tfidf_search_equals_brute_force(spark):
    docs = spark.read.parquet(DOCS).select(F.col("doc_id").alias("review_id"), "text").where("review_id < 60")
    vectors = em.embed_tfidf(docs, dim=64).orderBy("review_id")
    rows = vectors.collect()
    m, ids = np.asarray([r.embedding for r in rows]), [r.review_id for r in rows]
    asked = vectors.select(F.col("review_id").alias("question_id"), "embedding")
    got = result(knn.nearest(asked, vectors, k=3))
    want = brute(m, m, ids, 3, "cosine")
    assert got == {ids[i]: v for i, v in want.items()}


# --- Trained operators ----------------------------------------------------------------------------


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train, rest = docs.where("doc_id % 5 <> 0"), docs.where("doc_id % 5 = 0")
    profiles = lg.build_profiles(train)
    got = lg.detect_language(rest, profiles, "text").where(F.length("text") >= 20)
    assert got.agg(F.avg((F.col("language") == F.col("lang")).cast("int"))).first()[0] > 0.97
    text = "This spray is really nice. It smells really good and works great every time."
    probe = spark.createDataFrame([(text,), ("Love it",), (None,)], "text_clean string")
    found = {r.text_clean: r.language for r in lg.detect_language(probe, profiles).collect()}
    assert found == {text: "en", "Love it": None, None: None}


def test_trigrams(values):
    assert values(lg.trigrams, ["Abcd", "ab", "a😀bc"]) == [["abc", "bcd"], [], ["a😀b", "😀bc"]]


def test_sentiment_bands(spark):
    labelled = spark.createDataFrame([("good fine", 1), ("good nice", 1), ("bad poor", 0), ("bad awful", 0)], "text string, quality int")
    weights = st.learn_weights(labelled)
    w = {r.token: r.weight for r in weights.collect()}
    assert w["good"] == pytest.approx(np.log(3 / 4) - np.log(1 / 4)) and w["bad"] == -w["good"]
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(["good", "bad", "good bad", "unknown", "fine"])], "id int, text string")
    scores = st.score_texts(texts, weights, ["id"])
    starred = {r.id: r.stars for r in st.with_stars(scores, st.learn_cuts(scores)).collect()}
    assert starred[3] is None and starred[1] == 1 and starred[1] < starred[2] < starred[4] < starred[0] == 5 or starred[0] >= 4


def test_brands(spark):
    texts = spark.createDataFrame(
        [(1, "I like Sally Hansen and NYX. NYX!"), (2, "sally hansen"), (3, "Sally  Hansen"), (4, "x" * 512 + " NYX")],
        "review_id int, text string",
    )
    phrases = spark.createDataFrame([("Sally Hansen",), ("NYX",), ("NYX",)], "phrase string")
    head = {r.review_id: r.brands for r in br.find_brands(texts, phrases).collect()}
    assert head == {1: ["NYX", "Sally Hansen"]}
    assert set(r.review_id for r in br.find_brands(texts, phrases, max_chars=None).collect()) == {1, 4}
    assert br.naming(texts, ["Sally Hansen", "a.b"]).count() == 1


def test_engines_and_board(spark):
    rows = spark.createDataFrame([("a", "abc"), ("b", ""), ("c", "boom")], "filename string, truth string")

    def fails(x):
        if x == "boom":
            raise RuntimeError("no")
        return x

    ran = en.run_engines(rows, {"same": fails, "upper": str.upper}, "filename", "truth")
    got = {(r.filename, r.engine): (r.output, r.failed) for r in ran.collect()}
    assert got[("c", "same")] == ("[ERROR: no]", True) and got[("c", "upper")] == ("BOOM", False)
    board = {r.engine: r for r in en.leaderboard(en.score_against_truth(ran, rows), "score").collect()}
    assert board["same"].n == 3 and board["same"].n_failed == 1
    assert board["upper"].avg_score == pytest.approx((1 + 1 + 1) / 3)
    assert board["same"].total_time >= 0


# --- Enrichment -----------------------------------------------------------------------------------


def reviews(spark, rows):
    return spark.createDataFrame(rows, "review_id string, product_id string, source string, text_raw string, rating double")


ROWS = [
    ("a", "P1", "json", "Great <b>price</b> &amp; fast delivery. Bad seller.", 5.0),
    ("b", "P2", "csv", "nothing here AB1234", None),
    ("c", "P3", "csv", "<br>", 3.0),
]


def test_enrich_and_index(spark):
    def scorer(batches):
        for b in batches:
            yield b.map(lambda t: 1 if "Bad" in t else 5, na_action="ignore").astype("Int32")

    done = enrich.preprocess(reviews(spark, ROWS))
    done = enrich.analyse_aspects(done, st.scorer_udf(scorer))
    done = enrich.extract_entities(done, spark.createDataFrame([("Great",)], "phrase string"))
    got = {r.review_id: r for r in done.collect()}
    assert got["a"].text_raw == ROWS[0][3] and got["a"].text_clean == "Great price & fast delivery. Bad seller."
    assert got["a"].aspects == {"product": None, "shipping": "positive", "service": "negative", "price": "positive"}
    assert got["b"].aspects["product"] == "positive" and got["b"].entities.skus == ["AB1234"] and got["b"].entities.brands == []
    assert got["a"].entities.brands == ["Great"]
    index = enrich.index_rows(done)
    # "<br>" cleans to nothing, and the raw text takes its place.
    assert {r.review_id: r.document for r in index.collect()}["c"] == "<br>"
    filled = {r.review_id: r for r in enrich.filled(index).collect()}
    assert filled["b"].rating == -1 and filled["b"].aspect_price == "none"
    assert tuple(enrich.aspect_coverage(done).first()) == (3, 3)


def test_enrich_with_a_user_finder(spark):
    def finder(batches):
        for b in batches:
            yield b.map(lambda t: [" NYX ", "Acme", "NYX"] if "price" in t else [])

    def scorer(batches):
        for b in batches:
            yield b.map(lambda t: 3, na_action="ignore").astype("Int32")

    done = enrich.enrich(reviews(spark, ROWS), scorer=st.scorer_udf(scorer), finder=br.finder_udf(finder))
    got = {r.review_id: r for r in done.collect()}
    assert got["a"].entities.brands == ["Acme", "NYX"] and got["b"].entities.brands == []
    assert got["a"].aspects["price"] == "neutral"


def test_aspects_by_learned_weights(spark):
    labelled = spark.createDataFrame([("great fast", 1), ("bad late", 0)], "text string, quality int")
    weights = st.learn_weights(labelled)
    cuts = spark.createDataFrame([(-0.5, -0.1, 0.1, 0.5)], "c1 double, c2 double, c3 double, c4 double")
    got = {r.review_id: r.aspects for r in enrich.analyse_aspects_by_weights(enrich.preprocess(reviews(spark, ROWS)), weights, cuts).collect()}
    assert got["a"]["price"] == "positive" and got["a"]["service"] == "negative" and got["a"]["product"] is None
    assert got["b"]["product"] is None and set(got) == {"a", "b", "c"}


# --- Answers --------------------------------------------------------------------------------------


def index_frame(spark):
    rows = [
        ("r1", "love this blender", "P1", "json", 5.0, "positive", [1.0, 0.0]),
        ("r2", "broke fast", "P2", "csv", 1.0, "negative", [0.9, 0.1]),
        ("r3", "fine", "P1", "csv", None, None, [0.8, 0.2]),
    ]
    df = spark.createDataFrame(rows, "review_id string, document string, product_id string, source string, rating double, aspect_product string, embedding array<float>")
    none = F.lit(None).cast("string")
    return df.withColumns({"text_raw": F.upper("document"), "aspect_shipping": none, "aspect_service": none, "aspect_price": none})


def question_frame(spark):
    rows = [
        (1, "What do customers complain about?", [1.0, 0.0]),
        (2, "What do customers mention?", [1.0, 0.0]),
        (3, "  ", [1.0, 0.0]),
        (4, "What do customers love in France?", [-1.0, 0.0]),
    ]
    return spark.createDataFrame(rows, "question_id long, question string, embedding array<float>")


def test_answers(spark):
    got = {r.question_id: r for r in qa.answer(question_frame(spark), index_frame(spark), k=2).collect()}
    assert {k: v.status for k, v in got.items()} == {1: "success", 2: "success", 3: "blank", 4: "irrelevant"}
    assert [s.product_id for s in got[1].sources] == ["P2"] and got[1].sources[0].text_raw == "BROKE FAST"
    assert got[2].context == "[Product P1, rating 5.0/5] love this blender\n\n[Product P2, rating 1/5] broke fast"
    assert got[2].prompt == "Context:\n" + got[2].context + "\n\nQuestion: What do customers mention?"
    assert got[4].message == qa.NO_RESULTS_MESSAGE and got[4].sources is None and got[3].message is None


def test_sentinel_rating_and_empty_filter(spark):
    index = index_frame(spark)
    only = index.where("review_id = 'r3'")
    got = {r.question_id: r for r in qa.answer(question_frame(spark), only).collect()}
    assert got[1].status == "empty_after_filter" and got[1].message == qa.NO_RESULTS_MESSAGE
    assert got[2].context == "[Product P1, rating -1/5] fine"


def test_gate_ignores_the_filter(spark):
    index = index_frame(spark)
    asked = question_frame(spark).where("question_id in (1, 2)")
    gates = {r.question_id: r.mean_distance for r in qa.relevance(qa.retrieve(asked, index, k=2)).collect()}
    assert gates[1] == gates[2]
    answers = {r.question_id: r.mean_distance for r in qa.answer(asked, index, k=2).collect()}
    assert answers == gates


def test_gate_uses_the_mean(spark):
    hits = spark.createDataFrame(
        [(1, False, 0.69), (1, False, 0.69), (2, False, 0.2), (2, False, 1.3), (2, True, 0.0)],
        "question_id int, filtered boolean, distance double",
    )
    assert {r.question_id: r.relevant for r in qa.relevance(hits).collect()} == {1: True, 2: False}


def test_no_hits_is_off_topic(spark):
    empty = index_frame(spark).limit(0)
    got = {r.status for r in qa.answer(question_frame(spark).where("question_id = 2"), empty).collect()}
    assert got == {"irrelevant"}


# --- Evaluation -----------------------------------------------------------------------------------


def test_retrieval_scores(spark):
    cases = spark.createDataFrame(
        [(1, ["A"]), (2, ["A"]), (3, ["C"]), (4, None), (5, ["A"])], "question_id int, relevant_reviews array<string>"
    )
    hits = spark.createDataFrame(
        [(1, 1, "A"), (1, 2, "A"), (1, 3, "B"), (2, 1, "B"), (2, 2, "A"), (3, 1, "B"), (3, 2, "A"), (4, 1, "A")],
        "question_id int, rank int, product_id string",
    )
    got = {r.question_id: (r.precision, r.mrr) for r in ev.retrieval_scores(cases, hits).collect()}
    assert got == {1: (pytest.approx(2 / 3), 1.0), 2: (0.5, 0.5), 3: (0.0, 0.0), 5: (0.0, 0.0)}


def test_score_cases(spark):
    rows = [(1, "Which one?", ["A"]), (2, "Which one?", ["A"]), (3, "Which one?", None), (4, "What do people love here?", ["A"]),
            (5, "What do people love here?", ["A"])]
    cases = spark.createDataFrame(rows, "question_id int, question string, relevant_reviews array<string>")
    hits = [(1, False, 1, "B", 0.7), (1, False, 2, "A", 0.9), (3, False, 1, "A", 0.1)]
    hits += [(4, False, 1, "A", 0.1), (4, True, 1, "B", 0.2), (4, True, 2, "A", 0.9), (5, False, 1, "A", 0.1)]
    hits = spark.createDataFrame(hits, "question_id int, filtered boolean, rank int, product_id string, distance double")
    got = {r.question_id: (r.precision, r.mrr, r.refused) for r in ev.score_cases(cases, hits).collect()}
    # 4 is scored on what its wish leaves, 5 is refused as the wish leaves nothing.
    assert got == {1: (0.5, 0.5, True), 2: (0.0, 0.0, True), 4: (0.5, 0.5, False), 5: (0.0, 0.0, True)}


def test_judge_bodies(spark):
    df = spark.createDataFrame([("c", "q", "a")], "context string, question string, answer string")
    row = df.select(ev.faithfulness_body(), ev.relevance_body()).first()
    assert tuple(row) == ("CONTEXT:\nc\n\nANSWER:\na", "QUESTION:\nq\n\nANSWER:\na")


def test_summary(spark):
    rows = [
        ("a", True, 0.5, 1.0, 1.0, True, False, False),
        ("a", True, 1.0, 0.5, 3.0, True, True, False),
        ("n", False, 0.0, 0.0, 2.0, False, False, True),
        ("n", False, 0.0, 0.0, 2.0, False, False, False),
    ]
    df = spark.createDataFrame(rows, "category string, expects_answer boolean, precision double, mrr double, latency double, faithful boolean, on_topic boolean, refused boolean")
    got = {r.category: r for r in ev.summary(df).collect()}
    assert got["a"].avg_precision == 0.75 and got["a"].answer_relevance == 0.5 and got["a"].no_answer_accuracy is None
    assert got["n"].avg_precision is None and got["n"].no_answer_accuracy == 0.5
    assert got[None].n == 4 and got[None].avg_latency == 2.0 and got[None].overall
    named = ev.summary(df.withColumn("category", F.when(F.col("category") == "a", "a"))).where("category is null").collect()
    assert sorted((r.overall, r.n) for r in named) == [(False, 2), (True, 4)]


def test_annotations(spark):
    cases = spark.createDataFrame([(1, ["x"]), (2, None), (3, None)], "question_id int, relevant_reviews array<string>")
    decisions = spark.createDataFrame([(1, ["y"]), (2, [])], "question_id int, relevant_reviews array<string>")
    got = {r.question_id: r.relevant_reviews for r in ev.merge_annotations(cases, decisions).collect()}
    assert got == {1: ["x"], 2: [], 3: None}
    assert ev.annotated(cases).count() == 1 and ev.unannotated(cases).count() == 2
    same = ev.merge_annotations(cases, decisions.union(decisions))
    assert same.count() == 3
    with pytest.raises(Exception, match="two decisions"):
        ev.merge_annotations(cases, decisions.union(spark.createDataFrame([(2, ["z"])], decisions.schema))).collect()


def test_thresholds_and_verdicts(spark, values):
    gates = spark.createDataFrame([(0.6, True), (0.65, False), (0.8, False)], "mean_distance double, on_topic boolean")
    got = {r.threshold: (r.kept_on_topic, r.kept_off_topic, r.accuracy) for r in ev.threshold_sweep(gates, [0.62, 0.7]).collect()}
    assert got == {0.62: (1, 0, 1.0), 0.7: (1, 1, pytest.approx(2 / 3))}
    assert values(ev.passed, ["VERDICT: PASS\nREASON: x", "VERDICT: FAIL", None]) == [True, False, None]
