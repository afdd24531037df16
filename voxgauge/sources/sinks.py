"""Writers. Each writes a new path; none collects rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from voxgauge.functions import text as tx
from voxgauge.schema import iso_dict


def write_reviews_json(reviews: DataFrame, path: str) -> None:
    """JSON Lines with ISO dates, nulls and non-ASCII letters kept."""
    iso_dict(reviews).write.option("ignoreNullFields", False).json(path)


def export_csv(raw: DataFrame, path: str) -> None:
    """Retailer export of raw JSON reviews: derived id, product and ISO date, with a header. Time 0 is a day like others."""
    rows = raw.select(
        F.concat(F.col("user_id"), F.col("timestamp").cast("string")).alias("review_id"),
        tx.first_non_empty("parent_asin", "asin").alias("product_id"),
        F.col("text").alias("review_text"),
        F.col("rating").alias("star_rating"),
        F.date_format(tx.epoch_s_date(F.floor(F.col("timestamp") / 1000)), "yyyy-MM-dd").alias("review_date"),
    )
    (
        rows.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_truth(texts: DataFrame, path: str, filename: str = "filename", text: str = "text") -> None:
    """Ground truth, one ``{filename: text}`` object per line, so that no task holds all of it."""
    body = tx.strip(text)
    texts.where(body != "").select(
        F.to_json(F.create_map(F.col(filename), tx.cut(body, tx.TRUTH_CHARS))).alias("value")
    ).write.text(path)
