"""Small-schema sources: product URLs, evaluation cases, ground truth, and head samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

CASE = T.StructType(
    [
        T.StructField("question", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("relevant_reviews", T.ArrayType(T.StringType())),
        T.StructField("expects_answer", T.BooleanType()),
    ]
)


def read_product_urls(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("product_url string").json(path).select("product_url")


def read_cases(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Evaluation cases: a JSON array per file, or with ``multi_line=False`` one object per line."""
    return spark.read.schema(CASE).option("multiLine", multi_line).json(path)


def read_truth(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """``(filename, truth)`` from a JSON object per file, or per line with ``whole_file=False``."""
    docs = spark.read.text(path, wholetext=whole_file)
    entries = F.from_json("value", "map<string,string>")
    return docs.select(F.explode(entries).alias("filename", "truth"))


def head_sample(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First n rows; without an order Spark stops reading once it has them."""
    return (df.orderBy(*order) if order else df).limit(n)
