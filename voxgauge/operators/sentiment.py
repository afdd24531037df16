"""Sentiment stars from token weights learned by aggregation.

A token's weight is the log odds of the label among documents that hold it, with add-one smoothing; a
text's score is the mean weight of its distinct tokens; five bands cut at the quintiles of the training
scores stand for one to five stars. This takes the place of a pretrained model: it has the same shape of
result, not the same values. A user's model plugs in as a batch function (``scorer_udf``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from voxgauge.functions.batch import BatchFunction, batch_udf
from voxgauge.functions.text import col
from voxgauge.operators.joins import sized

SCORE_DIGITS = 3  # training scores are binned to this resolution before the quintiles are read


def tokens(c: Column | str) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(F.regexp_extract_all(F.lower(col(c)), F.lit(r"[\p{L}\p{N}]+"), 0))


def learn_weights(labelled: DataFrame, text: str = "text", label: str = "quality") -> DataFrame:
    """``(token, weight)`` from texts with a 0/1 label. Partial sums bound the cost of frequent tokens."""
    is_pos = F.col(label).cast("long")
    seen = labelled.select(is_pos.alias("pos"), F.explode(tokens(text)).alias("token"))
    counts = seen.groupBy("token").agg(F.sum("pos").alias("n_pos"), F.sum(1 - F.col("pos")).alias("n_neg"))
    totals = labelled.agg(F.sum(is_pos).alias("all_pos"), F.sum(1 - is_pos).alias("all_neg"))
    both = counts.withColumn("sizes", totals.select(F.struct("all_pos", "all_neg")).scalar())

    def share(n: str, total: str) -> Column:
        return F.log((F.col(n) + 1) / (F.col(f"sizes.{total}") + 2))

    return both.select("token", (share("n_pos", "all_pos") - share("n_neg", "all_neg")).alias("weight"))


def score_texts(texts: DataFrame, weights: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row per ``keys`` with ``score``: mean weight of the distinct known tokens, null when none is known.

    The texts are read once and their means shuffled once. Store the weights first (``shared_path``): their size is
    counted before the join is planned.
    """
    words = texts.select(*keys, F.explode_outer(tokens(text)).alias("token"))
    return words.join(sized(weights), "token", "left").groupBy(*keys).agg(F.avg("weight").alias("score"))


def learn_cuts(scores: DataFrame, score: str = "score") -> DataFrame:
    """One row ``(c1..c4)``: upper ends of the first four quintile bands.

    Exact on scores binned to three decimals: rows are counted per bin first, so the running total runs
    over as many rows as there are bins, however many texts there are.
    """
    bins = (
        scores.where(F.col(score).isNotNull())
        .groupBy(F.round(score, SCORE_DIGITS).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    one = Window.partitionBy(F.lit(1))
    upto = F.sum("n").over(one.orderBy("bin")) / F.sum("n").over(one)
    return bins.withColumn("upto", upto).agg(
        *[F.min(F.when(F.col("upto") >= i / 5, F.col("bin"))).alias(f"c{i}") for i in range(1, 5)]
    )


def with_stars(scores: DataFrame, cuts: DataFrame, score: str = "score") -> DataFrame:
    """Adds ``stars`` 1..5 by the band the binned score falls in."""
    b = F.round(score, SCORE_DIGITS)
    star = F.lit(1)
    for c in cuts.columns:
        star = star + F.when(b > F.col(f"_cuts.{c}"), 1).otherwise(0)
    banded = scores.withColumn("_cuts", cuts.select(F.struct(*cuts.columns)).scalar())
    return banded.withColumn("stars", F.when(b.isNotNull(), star)).drop("_cuts")


def scorer_udf(scorer: BatchFunction):
    """A user's scorer as a column function: batches of texts to star counts."""
    return batch_udf(scorer, "int")
