"""A corpus from raw documents to packed sequences: the stages in order, each on what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from voxgauge.llm import decontaminate, language_id, near_dedup, packing, substring_dedup
from voxgauge.llm.shared import documents, table
from voxgauge.session import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Spark's setting for the rows that cross to Python at once, its own value, and ours: rows are whole texts, and ten thousand of
#: them are tens of megabytes in the JVM and again in Python, in every task.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SPARKS_ROWS, TEXT_ROWS = "10000", "500"


def small_batches(stage: Stage) -> Stage:
    """``stage`` with ``TEXT_ROWS`` rows a batch, where the session has Spark's own value. The setting stays, as the result is lazy."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_ROWS) == SPARKS_ROWS:
            spark.conf.set(BATCH_ROWS, TEXT_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the table names: those far from every centroid go, and those without a letter."""
    return language_id.predict(docs, language_id.fit(docs)).filter("not rejected").select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dedup.dedup(spark, docs)


def own_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stay in another document; a document of which nothing is left goes."""
    found = substring_dedup.dedup(spark, docs).filter("removed_bytes = 0 or trim(text) <> ''")
    n_chars = F.when(F.col("removed_bytes") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 1,024 tokens."""
    placed = packing.pack(spark, docs)
    return placed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", small_batches(known_language)),
    ("near_dedup", small_batches(one_of_near_copies)),
    ("substring_dedup", small_batches(own_passages)),
    ("decontamination", small_batches(without_benchmark)),
    ("best_fit_packing", small_batches(packed)),
]

#: Learned and hashed stages have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, rows = documents(spark, sf_dir), spark.conf.get(BATCH_ROWS)
    try:
        for name, stage in STAGES:
            docs = stored(spark, name, stage(spark, docs, sf_dir))
    finally:
        spark.conf.set(BATCH_ROWS, rows)
    return docs
