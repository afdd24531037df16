"""The review record shared by every source, and its deterministic id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Source labels, part of every review id.
SOURCE_JSON = "json"
SOURCE_CSV = "csv"
SOURCE_REPORT = "pdf"
SOURCE_IMAGE = "ocr"
SOURCE_PAGE = "jumia_scraping"

# Aspect names in vocabulary order.
ASPECTS = ("product", "shipping", "service", "price")

METADATA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("verified_purchase", T.BooleanType()),
        T.StructField("helpful_vote", T.LongType()),
        T.StructField("author", T.StringType()),
    ]
)

REVIEW = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("text_raw", T.StringType()),
        T.StructField("text_clean", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("review_date", T.DateType()),
        T.StructField("language", T.StringType()),
        T.StructField("metadata", METADATA),
    ]
)


def review_id(source: Column | str, original: Column) -> Column:
    """sha1 of ``source:original``; ``original`` must not be null."""
    label = F.lit(source) if isinstance(source, str) else source
    return F.sha1(F.concat(label, F.lit(":"), original))


def metadata(**fields: Column) -> Column:
    """Metadata struct with the given fields; the others are null."""
    return F.struct(
        *[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in METADATA.fields]
    )


def conform(df: DataFrame, *extra: str) -> DataFrame:
    """Select the review columns in order and type; columns the source lacks become null."""
    have = {f.name: f.dataType for f in df.schema.fields}
    if df.columns == [*REVIEW.names, *extra] and all(have[f.name] == f.dataType for f in REVIEW.fields):
        return df
    cols = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in REVIEW.fields
    ]
    return df.select(*cols, *extra)


def iso_dict(df: DataFrame) -> DataFrame:
    """Serialised form: the date as ISO text, everything else unchanged."""
    return df.withColumn("review_date", F.date_format("review_date", "yyyy-MM-dd"))
