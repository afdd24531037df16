"""Competing engines on the same rows, their scores and their times."""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from voxgauge.functions.text import edit_distance


def run_engines(rows: DataFrame, engines: dict[str, Callable[[str], str]], key: str, value: str) -> DataFrame:
    """One row per input row and engine: ``(key, engine, output, elapsed, failed)``.

    Every engine sees a row while its batch is in memory, so the input is read once. An engine that raises
    gives a row with the error, and the others go on.
    """

    def attempt(fn: Callable[[str], str], x: str) -> tuple[str | None, float, bool]:
        start = time.perf_counter()
        try:
            out, failed = fn(x), False
        except Exception as e:
            out, failed = f"[ERROR: {e}]", True
        return out, time.perf_counter() - start, failed

    def run(batches):
        for batch in batches:
            for name, fn in engines.items():
                done = [attempt(fn, x) for x in batch[value]]
                yield pd.DataFrame(
                    {
                        key: batch[key],
                        "engine": name,
                        "output": [d[0] for d in done],
                        "elapsed": [d[1] for d in done],
                        "failed": [d[2] for d in done],
                    }
                )

    out_schema = T.StructType(
        [
            rows.schema[key],
            T.StructField("engine", T.StringType()),
            T.StructField("output", T.StringType()),
            T.StructField("elapsed", T.DoubleType()),
            T.StructField("failed", T.BooleanType()),
        ]
    )
    return rows.select(key, value).mapInPandas(run, out_schema)


def score_against_truth(predicted: DataFrame, truth: DataFrame, key: str = "filename") -> DataFrame:
    """Normalised edit distance of each prediction; ``truth`` has ``key`` and ``truth``."""
    return predicted.join(truth, key).withColumn("score", edit_distance("output", "truth"))


def leaderboard(results: DataFrame, *scores: str) -> DataFrame:
    """Per engine: rows, failures, mean of each score, total and mean time."""
    return results.groupBy("engine").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("failed").alias("n_failed"),
        *[F.avg(s).alias(f"avg_{s}") for s in scores],
        F.sum("elapsed").alias("total_time"),
        F.avg("elapsed").alias("avg_time"),
    )
