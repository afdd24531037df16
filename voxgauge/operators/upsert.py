"""Keyed insert-or-replace into a Parquet index.

``upsert`` merges a batch into an index DataFrame. For repeated loads, ``write_batch`` adds a batch as a folder of its own
under its writer's name and ``read_index`` keeps each id's row of the latest load, so that a small batch never rewrites a
large index, a replayed batch overwrites only itself, and no writer touches what another one wrote. The order of loads is
noted once per batch, before its rows, and a replay keeps its place. ``compact`` folds the batches.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

BATCH = "batch"


def one_per_id(df: DataFrame, *order: Column, key: str = "review_id") -> DataFrame:
    """First row of each id in the given order; surplus rows go before the shuffle."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def distinct_batch(batch: DataFrame, key: str = "review_id") -> DataFrame:
    """One row per id, chosen by content so that a replay chooses alike."""

    def hashable(f: T.StructField) -> Column:
        plain = "map" not in f.dataType.simpleString()
        return F.col(f.name) if plain else F.to_json(F.struct(f.name))

    content = F.xxhash64(F.lit(0), *[hashable(f) for f in batch.schema.fields if f.name != key])
    return one_per_id(batch, content, key=key)


def upsert(index: DataFrame, batch: DataFrame, key: str = "review_id") -> DataFrame:
    """The index with the batch's rows in place of those with the same id."""
    fresh = distinct_batch(batch, key)
    kept = index.join(fresh.select(key), key, "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


LOADS = "_loads"  # beside the rows; readers of Parquet pass over names that start with an underscore
LOAD_SCHEMA = "writer string, batch long, load long"


def loads(spark: SparkSession, root: str) -> DataFrame:
    """``(writer, batch, load)``: which batches there are, and their place in the order of loads."""
    try:
        return spark.read.schema(LOAD_SCHEMA).json(f"{root}/{LOADS}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOAD_SCHEMA)


def write_batch(batch: DataFrame, root: str, number: int, writer: str = "bulk", key: str = "review_id") -> None:
    """Batch ``number`` of ``writer``, a name that no other load into this index uses. The first note of a batch counts,
    so a replay takes the place it had; of two writers at the same time the later name wins."""
    if not re.fullmatch(r"[\w.-]+", writer):
        raise ValueError("a writer's name is letters, digits, dots and dashes")
    spark = batch.sparkSession
    known = loads(spark, root)
    if known.where((F.col("writer") == writer) & (F.col("batch") == number)).isEmpty():
        place = (known.agg(F.max("load")).first()[0] or 0) + 1
        note = spark.range(1).select(F.lit(writer).alias("writer"), F.lit(number).alias("batch"), F.lit(place).alias("load"))
        note.write.mode("append").json(f"{root}/{LOADS}")
    distinct_batch(batch, key).write.mode("overwrite").parquet(f"{root}/writer={writer}/{BATCH}={number}")


def read_index(spark: SparkSession, root: str, key: str = "review_id", schema: T.StructType | None = None) -> DataFrame:
    """Current rows. The first load, as a rule the bulk, is only rid of replaced ids; later ones are ranked.

    With ``schema`` (``enrich.INDEX`` for index rows) no file decides which columns there are; without it the columns of all
    files are put together.
    """
    rows = spark.read
    if schema is None:
        rows = rows.option("mergeSchema", True)
    else:
        places = [T.StructField("writer", T.StringType()), T.StructField(BATCH, T.LongType())]
        rows = rows.schema(T.StructType([*schema.fields, *places]))
    rows = rows.parquet(root).withColumn("writer", F.col("writer").cast("string")).withColumn(BATCH, F.col(BATCH).cast("long"))
    order = loads(spark, root).groupBy("writer", BATCH).agg(F.min("load").alias("_load"))  # one row per batch
    rows = rows.join(F.broadcast(order), ["writer", BATCH])
    first = order.agg(F.min(F.struct("_load", "writer"))).first()[0]
    is_base = (F.col("_load") == first[0]) & (F.col("writer") == first[1])
    own = [c for c in rows.columns if c not in ("writer", BATCH, "_load")]
    base = rows.where(is_base).select(own)
    later = one_per_id(rows.where(~is_base), F.desc("_load"), F.desc("writer"), key=key).select(own)
    return base.join(later.select(key), key, "left_anti").unionByName(later)


def compact(spark: SparkSession, root: str, target: str, key: str = "review_id", schema: T.StructType | None = None) -> None:
    """Writes the current state as one batch under a new root; the old one is left as it is.

    Worth doing when ranking the later loads costs more than rewriting them: as a rule once they hold a tenth of the rows.
    """
    write_batch(read_index(spark, root, key, schema), target, 0, "compact", key)
