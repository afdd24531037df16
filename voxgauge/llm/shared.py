"""Helpers of the operators: written intermediates and broadcasts behind a size check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from voxgauge.session import stored

__all__ = ["BROADCAST_BYTES", "broadcast_if_small", "documents", "fresh_name", "remainder", "stored", "table"]

#: A join side is broadcast only if its counted rows and strings stay below this many bytes.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))) % modulus


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with a number if a column of ``df`` has it already."""
    taken, n, out = {c.lower() for c in df.columns}, 0, name
    while out.lower() in taken:
        n += 1
        out = f"{name}{n}"
    return out


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if one aggregate over it shows that it is small, else left to a shuffled join.

    ``df`` should be cheap to read twice, such as a written table.
    """
    width = F.lit(0)
    for name, kind in df.dtypes:
        width = width + (F.coalesce(F.octet_length(name), F.lit(0)) + 16 if kind in ("string", "binary") else F.lit(16))
    size = df.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(df) if size <= limit else df
