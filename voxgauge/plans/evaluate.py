"""Retrieval and answer quality as grouped queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from voxgauge.functions.intent import wanted_sentiment
from voxgauge.plans.answer import DISTANCE_THRESHOLD, TOP_K, answer, retrieve

# Fixed value: the line a judge's text must hold.
PASS_MARK = "VERDICT: PASS"


def annotated(cases: DataFrame) -> DataFrame:
    return cases.where(F.col("relevant_reviews").isNotNull())


def unannotated(cases: DataFrame) -> DataFrame:
    return cases.where(F.col("relevant_reviews").isNull())


def merge_annotations(cases: DataFrame, decisions: DataFrame, key: str = "question_id") -> DataFrame:
    """Decisions fill the cases that have none; annotated cases stay as they are.

    Two different decisions for one case raise when the rows are read; the same one twice counts once.
    """
    clash = F.raise_error(F.concat(F.lit("two decisions for case "), F.col(key).cast("string")))
    decided = decisions.groupBy(key).agg(
        F.min("relevant_reviews").alias("_decided"), F.max("relevant_reviews").alias("_other")
    )
    one = F.when(F.col("_decided").eqNullSafe(F.col("_other")), F.col("_decided")).otherwise(clash.cast("array<string>"))
    decided = decided.select(key, one.alias("_decided"))
    merged = cases.join(decided, key, "left")
    return merged.withColumn("relevant_reviews", F.coalesce("relevant_reviews", "_decided")).drop("_decided")


def retrieval_scores(cases: DataFrame, hits: DataFrame) -> DataFrame:
    """Per annotated case: precision over what was retrieved and reciprocal rank; both 0 without hits.

    ``hits`` has question_id, rank, product_id; a product retrieved twice counts twice.
    """
    judged = annotated(cases).select("question_id", "relevant_reviews").join(hits, "question_id", "left")
    good = F.array_contains("relevant_reviews", F.col("product_id")) & F.col("rank").isNotNull()
    return judged.groupBy("question_id").agg(
        F.avg(F.when(good, 1.0).otherwise(0.0)).alias("precision"),
        F.coalesce(1.0 / F.min(F.when(good, F.col("rank"))), F.lit(0.0)).alias("mrr"),
    )


def in_effect(cases: DataFrame, hits: DataFrame) -> DataFrame:
    """Of both kinds of hits (``answer.retrieve``) those that a case is answered from: the filtered ones if it has a wish."""
    wants = cases.select("question_id", wanted_sentiment("question").isNotNull().alias("_wants"))
    return hits.join(wants, "question_id").where(F.col("filtered") == F.col("_wants")).drop("_wants")


def score_cases(cases: DataFrame, hits: DataFrame, threshold: float = DISTANCE_THRESHOLD) -> DataFrame:
    """Annotated cases with precision, mrr and ``refused``, from one pass over each case's hits.

    ``cases``: question_id, question, relevant_reviews and what else is to stay. ``hits``: question_id, filtered, rank, distance
    (``answer.retrieve``) and product_id. Precision and rank are those of the hits in effect, the gate reads the unfiltered
    ones. A case is refused if the gate is shut or the filter leaves nothing; without hits it scores 0 and is refused.
    """
    asked = annotated(cases).withColumn("_wants", wanted_sentiment("question").isNotNull())
    counts = F.col("filtered") == F.col("_wants")
    good = counts & F.array_contains("relevant_reviews", F.col("product_id"))
    gate = F.avg(F.when(~F.col("filtered"), F.col("distance")))
    scores = (
        hits.join(asked.select("question_id", "relevant_reviews", "_wants"), "question_id")
        .groupBy("question_id")
        .agg(
            F.avg(F.when(counts, F.when(good, 1.0).otherwise(0.0))).alias("precision"),
            F.coalesce(1.0 / F.min(F.when(good, F.col("rank"))), F.lit(0.0)).alias("mrr"),
            (F.coalesce(gate > threshold, F.lit(True)) | (F.count_if(counts) == 0)).alias("refused"),
        )
    )
    joined = asked.drop("_wants").join(scores, "question_id", "left")
    return joined.na.fill({"precision": 0.0, "mrr": 0.0, "refused": True})


def evaluation_run(
    cases: DataFrame,
    index: DataFrame,
    k: int = TOP_K,
    threshold: float = DISTANCE_THRESHOLD,
    system: str | None = None,
    **search,
) -> tuple[DataFrame, DataFrame]:
    """From cases and an index to the summary, and to what a model and its judges read.

    ``cases``: question_id, question, embedding, category, expects_answer, relevant_reviews, and the judges' latency,
    faithful and on_topic, null while there are none. Unannotated cases are left out. The second table has the
    answers' columns (status, message, context, messages) and the bodies for the judges, once an answer is put in.
    """
    asked = annotated(cases)
    hits = retrieve(asked, index, k, **search)
    products = index.select("review_id", "product_id")
    told = answer(asked, index, k, threshold, system, **search)
    return summary(score_cases(asked, hits.join(products, "review_id"), threshold)), told


def faithfulness_body(context: str = "context", answer: str = "answer") -> Column:
    """What a judge of faithfulness reads; calling the judge is the user's."""
    return F.concat(F.lit("CONTEXT:\n"), F.col(context), F.lit("\n\nANSWER:\n"), F.col(answer))


def relevance_body(question: str = "question", answer: str = "answer") -> Column:
    return F.concat(F.lit("QUESTION:\n"), F.col(question), F.lit("\n\nANSWER:\n"), F.col(answer))


def passed(verdict: Column | str) -> Column:
    return (F.col(verdict) if isinstance(verdict, str) else verdict).contains(PASS_MARK)


def _rate(flag: str) -> Column:
    return F.avg(F.col(flag).cast("int"))


def summary(scored: DataFrame) -> DataFrame:
    """Per category, and over all (``overall``, with a null category): counts, means and rates in one pass.

    ``scored`` has category, expects_answer, precision, mrr, latency, faithful, on_topic and refused. The
    means run over cases that expect an answer, the refusal accuracy over the others.
    """
    wants = F.col("expects_answer")
    cols = {c: F.when(wants, F.col(c)) for c in ("precision", "mrr", "faithful", "on_topic")}
    rows = scored.withColumns(cols).withColumn("refused_well", F.when(~wants, F.col("refused")))
    return rows.rollup("category").agg(
        (F.grouping_id() == 1).alias("overall"),
        F.count(F.lit(1)).alias("n"),
        F.avg("precision").alias("avg_precision"),
        F.avg("mrr").alias("avg_mrr"),
        _rate("faithful").alias("faithfulness"),
        _rate("on_topic").alias("answer_relevance"),
        _rate("refused_well").alias("no_answer_accuracy"),
        F.avg("latency").alias("avg_latency"),
    )


def distance_ranges(gates: DataFrame, label: str) -> DataFrame:
    """Spread of the mean distance per kind of question."""
    d = F.col("mean_distance")
    return gates.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), F.min(d).alias("lowest"), F.avg(d).alias("mean"), F.max(d).alias("highest")
    )


def threshold_sweep(gates: DataFrame, thresholds: list[float], on_topic: str = "on_topic") -> DataFrame:
    """Accuracy of the gate at each threshold, all in one aggregation over the questions."""
    d, truth = F.col("mean_distance"), F.col(on_topic)
    cells = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.count_if((d <= t) & truth).alias("kept_on_topic"),
                F.count_if((d <= t) & ~truth).alias("kept_off_topic"),
                F.avg(F.when((d <= t) == truth, 1.0).otherwise(0.0)).alias("accuracy"),
            )
            for t in thresholds
        ]
    )
    return gates.agg(cells.alias("cells")).select(F.explode("cells").alias("c")).select("c.*")
