"""Named queries and, where SQL can say the same, the statement that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function name."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


# Tables whose queries spend their time on long texts.
TEXT_TABLES = {"documents", "pages", "conversations"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; a text table too small to keep the cores busy is spread over them."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def spread(df: DataFrame) -> DataFrame:
    """Shuffles rows only where the scan has fewer splits than there are cores, as for one small file.

    A large table has more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
