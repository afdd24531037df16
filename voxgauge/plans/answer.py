"""Batches of questions to grounded answers: gate, filtered retrieval, context, sources, prompt.

One nearest-neighbour search serves both the gate and the retrieval. Each question enters once without a
filter and, when it asks for a sentiment, once more with it; the gate reads the unfiltered hits only, so a
filter cannot change its verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from voxgauge.functions.intent import is_blank, wanted_sentiment
from voxgauge.operators.joins import BROADCAST_BYTES
from voxgauge.operators.knn import label_bits, nearest, wish_bits
from voxgauge.plans.enrich import NO_RATING, filled
from voxgauge.schema import ASPECTS, SOURCE_JSON

# Neighbours per question, and the mean distance up to which a question is on topic.
TOP_K = 5
DISTANCE_THRESHOLD = 0.69
NO_RESULTS_MESSAGE = "I couldn't find any reviews relevant to this question in the dataset."


def searchable(index: DataFrame) -> DataFrame:
    """Search columns of an index: id, vector, and the bits of its aspect labels."""
    bits = label_bits(*[F.col(f"aspect_{a}") for a in ASPECTS])
    return index.select("review_id", "embedding", bits.alias("tags"))


def retrieve(questions: DataFrame, index: DataFrame, k: int = TOP_K, **search) -> DataFrame:
    """``(question_id, filtered, rank, review_id, distance)``.

    ``questions``: question_id, question, embedding, optionally ``skip``. Blank questions are not searched.
    """
    key_type = questions.schema["question_id"].dataType
    skip = ["skip"] if "skip" in questions.columns else []
    wishes = F.array_distinct(F.array(F.lit(0), wish_bits(wanted_sentiment("question"))))
    probes = questions.where(~is_blank("question")).select(
        "question_id", "embedding", *skip, F.explode(wishes).alias("wish")
    )
    kind = F.when(F.col("wish") == 0, "0").otherwise("1")
    probes = probes.withColumn("question_id", F.concat(kind, F.col("question_id").cast("string")))
    hits = nearest(probes, searchable(index), k=k, **search)
    return hits.select(
        F.substring("question_id", 2, 1 << 30).cast(key_type).alias("question_id"),
        F.col("question_id").startswith("1").alias("filtered"),
        "rank",
        "review_id",
        "distance",
    )


def relevance(hits: DataFrame, threshold: float = DISTANCE_THRESHOLD) -> DataFrame:
    """``(question_id, mean_distance, relevant)`` of the questions that have hits."""
    mean = F.avg("distance")
    return (
        hits.where(~F.col("filtered"))
        .groupBy("question_id")
        .agg(mean.alias("mean_distance"), (mean <= threshold).alias("relevant"))
    )


def answer(
    questions: DataFrame,
    index: DataFrame,
    k: int = TOP_K,
    threshold: float = DISTANCE_THRESHOLD,
    system: str | None = None,
    **search,
) -> DataFrame:
    """One row per question: status, message, context, prompt, messages and cited sources.

    Status is blank, irrelevant, empty_after_filter or success. Generation is the user's: the prompt is a column, and
    ``messages`` has the instruction ``system`` (a default without one) before it; ``message`` is set where the answer is a
    refusal.
    """
    asked = questions.select(
        "question_id",
        "question",
        is_blank("question").alias("blank"),
        wanted_sentiment("question").isNotNull().alias("wants"),
    )
    hits = retrieve(questions, index, k, **search)
    # At most 2k rows per question from here on; only hits on topic fetch their review.
    mean = F.avg(F.when(~F.col("filtered"), F.col("distance")))
    verdicts = hits.groupBy("question_id").agg(
        mean.alias("mean_distance"),
        (mean <= threshold).alias("relevant"),
        F.sort_array(F.collect_list(F.struct("filtered", "rank", "review_id"))).alias("hits"),
    )
    judged = asked.join(verdicts, "question_id", "left").withColumn(
        "hits", F.when(F.col("relevant"), F.filter("hits", lambda h: h["filtered"] == F.col("wants")))
    )
    payload = filled(index).select("review_id", "document", "product_id", "source", "rating", "text_raw")
    wanted = judged.select("question_id", F.explode("hits").alias("h")).select("question_id", "h.rank", "h.review_id")
    # The questions bound the hits, of two ids and a rank each: while these are few, the reviews are read in place. Else only
    # the reviews that some hit names are shuffled; a filter of the ids meets the index in its scan.
    asked_for = questions.agg(F.count(F.lit(1)), F.max(F.length(F.col("question_id").cast("string")))).first()
    few = asked_for[0] * k * (2 * (asked_for[1] or 0) + 128) <= BROADCAST_BYTES
    if not few:
        payload = payload.join(wanted.select("review_id").distinct(), "review_id", "left_semi")
    cited = (
        payload.join(F.broadcast(wanted) if few else wanted, "review_id")
        .groupBy("question_id")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("rank", "product_id", "rating", "text_raw", "document", "source"))
            ).alias("cited")
        )
    )
    status = (
        F.when(F.col("blank"), "blank")
        .when(~F.coalesce("relevant", F.lit(False)), "irrelevant")
        .when(F.size(F.coalesce("hits", F.array())) == 0, "empty_after_filter")
        .otherwise("success")
    )

    def line(c: Column) -> Column:
        stars = rating_text(c["rating"], c["source"])
        return F.format_string("[Product %s, rating %s/5] %s", c["product_id"], stars, c["document"])

    return (
        judged.withColumn("status", status)
        .join(cited, "question_id", "left")
        .select(
            "question_id",
            "question",
            "status",
            "mean_distance",
            F.when(F.col("status").isin("irrelevant", "empty_after_filter"), F.lit(NO_RESULTS_MESSAGE)).alias(
                "message"
            ),
            F.array_join(F.transform("cited", line), "\n\n").alias("context"),
            F.transform(
                "cited",
                lambda c: F.struct(
                    c["product_id"].alias("product_id"), c["rating"].alias("rating"), c["text_raw"].alias("text_raw")
                ),
            ).alias("sources"),
        )
        .withColumn("prompt", prompt())
        .withColumn("messages", messages(system))
    )


def rating_text(rating: Column, source: Column) -> Column:
    """Ratings of JSON reviews keep their decimal point, as loaded; others and the sentinel are whole."""
    as_loaded = (source == SOURCE_JSON) & (rating != NO_RATING)
    return F.when(as_loaded, rating.cast("string")).otherwise(rating.cast("long").cast("string"))


#: What a model is told about its task unless the caller has words of their own.
INSTRUCTION = "Answer from the customer reviews in the context only, name products by their ids, and say so if they do not tell."


def messages(system: str | None = None) -> Column:
    """Role and content of each message, as a chat model takes them; null without a prompt."""
    pair = F.array(
        *[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in
          (("system", F.lit(system or INSTRUCTION)), ("user", F.col("prompt")))]
    )
    return F.when(F.col("prompt").isNotNull(), pair)


def prompt() -> Column:
    return F.concat(F.lit("Context:\n"), F.col("context"), F.lit("\n\nQuestion: "), F.col("question"))
