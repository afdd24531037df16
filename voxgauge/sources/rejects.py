"""Accepted and rejected rows of a staged source.

A staged source holds the review columns and ``reject_reason`` (null = accepted), so one scan
serves both the reviews and the reject counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from voxgauge.schema import conform


def first_reason(*checks: tuple[str, Column]) -> Column:
    """Name of the first check that holds, else null. A check that is null does not hold."""
    return F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in checks])


def accepted(staged: DataFrame) -> DataFrame:
    return conform(staged.where(F.col("reject_reason").isNull()))


def reject_counts(*staged: DataFrame) -> DataFrame:
    """Rejected rows per source and reason."""
    slim = [s.where(F.col("reject_reason").isNotNull()).select("source", "reject_reason") for s in staged]
    rows = reduce(DataFrame.unionByName, slim)
    return rows.groupBy("source", "reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def union_sources(*sources: DataFrame) -> DataFrame:
    """All sources under the one schema. The source is part of the id, so equal texts stay apart."""
    return reduce(DataFrame.unionByName, [conform(s) for s in sources])


def source_counts(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))
