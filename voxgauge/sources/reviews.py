"""Review sources. Each ``stage_*`` takes rows, each ``read_*`` takes a path; both keep reject reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from voxgauge import schema
from voxgauge.functions import text as tx
from voxgauge.functions.batch import BatchFunction, batch_udf
from voxgauge.session import stored
from voxgauge.sources.rejects import first_reason

# Logical name and column of the retailer export.
CSV_COLUMNS = {
    "review_id": "review_id",
    "product_id": "product_id",
    "text": "review_text",
    "rating": "star_rating",
    "date": "review_date",
}

# Texts that stand for a missing cell.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

REPORT_HEADER = "Product ID"

# A line's fields for the parser that reads what the first one refuses.
JSON_FIELDS = (
    "text string, parent_asin string, asin string, user_id string, timestamp string, rating double, title string, "
    "verified_purchase string, helpful_vote string, _broken string"
)


# --- JSON Lines -----------------------------------------------------------------------------------


def stage_json(lines: DataFrame, line: str = "value") -> DataFrame:
    """Reviews from one JSON object per row.

    Each line is parsed once, into a variant. The fields leave through a generator, as a filter on the
    reject reason would otherwise be pushed below the parse and repeat it.
    """

    def fields(x: Column) -> Column:
        v, again, raw = x["v"], x["again"], x["raw"]
        read = F.when(v.isNull() & again["_broken"].isNull(), again)  # what the first parse refuses and the second reads

        def field(name: str, kind: str = "string") -> Column:
            return F.coalesce(F.try_variant_get(v, f"$.{name}", kind), read[name].try_cast(kind))

        def as_text(name: str, missing: str = "") -> Column:
            """Text as the id takes it: an explicit null is ``None``, a number is as it was written."""
            at = F.try_variant_get(v, f"$.{name}", "variant")
            whole = F.when(F.schema_of_variant(at).isin("BIGINT", "STRING"), F.try_variant_get(v, f"$.{name}", "string"))
            written = tx.non_empty(F.regexp_extract(raw, rf'(?s)^.*"{name}"\s*:\s*([-+.0-9eE]+)', 1))  # a fraction keeps its digits
            return F.when(F.is_variant_null(at), "None").otherwise(
                F.coalesce(whole, F.when(at.isNotNull(), written), read[name], F.lit(missing))
            )

        return F.struct(
            (v.isNull() & read.isNull()).alias("broken"),
            field("text").alias("text"),
            tx.first_non_empty(field("parent_asin"), field("asin")).alias("product_id"),
            field("user_id").alias("user_id"),
            as_text("timestamp").alias("stamp"),
            field("timestamp", "double").cast("long").alias("ms"),
            field("rating", "double").alias("rating"),
            schema.metadata(
                title=field("title"),
                verified_purchase=field("verified_purchase", "boolean"),
                helpful_vote=field("helpful_vote", "long"),
            ).alias("metadata"),
        )

    filled = lines.where(F.length(tx.strip(line)) > 0)
    parsed = F.try_parse_json(line)
    # Lines that hold NaN or a name twice: a second parser reads them as the original does, the last of a name counting.
    again = F.when(parsed.isNull(), F.from_json(line, JSON_FIELDS, {"columnNameOfCorruptRecord": "_broken"}))
    both = F.struct(parsed.alias("v"), again.alias("again"), F.col(line).alias("raw"))
    rows = filled.select(F.inline(F.transform(F.array(both), fields)))
    original = F.concat(F.coalesce("user_id", F.lit("")), "stamp")
    return schema.conform(
        rows.select(
            schema.review_id(schema.SOURCE_JSON, original).alias("review_id"),
            "product_id",
            F.lit(schema.SOURCE_JSON).alias("source"),
            F.col("text").alias("text_raw"),
            "rating",
            tx.epoch_ms_date("ms").alias("review_date"),
            "metadata",
            first_reason(
                ("broken_line", F.col("broken")),
                ("no_text", tx.non_empty("text").isNull()),
                ("no_product", F.col("product_id").isNull()),
            ).alias("reject_reason"),
        ),
        "reject_reason",
    )


def read_json(spark: SparkSession, path: str) -> DataFrame:
    return stage_json(spark.read.text(path))


# --- CSV ------------------------------------------------------------------------------------------


def stage_csv(rows: DataFrame, columns: dict[str, str] = CSV_COLUMNS) -> DataFrame:
    """Reviews from string cells under the export's own column names; absent columns count as null."""

    def cell(name: str) -> Column:
        if columns[name] not in rows.columns:
            return F.lit(None).cast("string").alias(name)
        c = F.col(columns[name])
        return F.when(~c.isin(NULL_TOKENS), c).alias(name)

    cells = rows.select(*[cell(name) for name in columns])
    rating = tx.truncated_number("rating")
    return schema.conform(
        cells.select(
            schema.review_id(schema.SOURCE_CSV, F.col("review_id")).alias("review_id"),
            "product_id",
            F.lit(schema.SOURCE_CSV).alias("source"),
            F.col("text").alias("text_raw"),
            rating.alias("rating"),
            tx.free_date("date").alias("review_date"),
            first_reason(
                ("no_text", F.col("text").isNull()),
                ("no_product", F.col("product_id").isNull()),
                ("no_id", F.col("review_id").isNull()),
                ("bad_rating", F.col("rating").isNotNull() & rating.isNull()),
            ).alias("reject_reason"),
        ),
        "reject_reason",
    )


def read_csv(
    spark: SparkSession, path: str, columns: dict[str, str] = CSV_COLUMNS, multi_line: bool = True
) -> DataFrame:
    """All files must have one header: one with other columns, or in another order, fails.

    With ``multi_line`` a file is one task; without it Spark splits big files. Use that when no cell holds a line break.
    """
    rows = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .csv(path)
    )
    return stage_csv(rows, columns)


# --- Report tables --------------------------------------------------------------------------------


def stage_report(rows: DataFrame, cells: str = "cells") -> DataFrame:
    """Reviews from rows of an extracted table: product, rating, text, date. Short rows count as null."""

    def cell(i: int) -> Column:
        return F.get(cells, i)

    body = rows.where(F.coalesce(cell(0), F.lit(REPORT_HEADER)) != REPORT_HEADER).select(
        cell(0).alias("product"), cell(1).alias("stars"), cell(2).alias("text"), cell(3).alias("date")
    )
    missing = F.lit("None")
    original = F.concat_ws(
        ":",
        F.coalesce("product", missing),
        F.coalesce("date", missing),
        tx.cut(F.coalesce("text", missing), tx.ID_TEXT_CHARS),
    )
    return schema.conform(
        body.select(
            schema.review_id(schema.SOURCE_REPORT, original).alias("review_id"),
            tx.strip("product").alias("product_id"),
            F.lit(schema.SOURCE_REPORT).alias("source"),
            tx.strip("text").alias("text_raw"),
            tx.leading_digit("stars").alias("rating"),
            tx.year_month_day("date").alias("review_date"),
            first_reason(
                ("no_text", tx.non_empty("text").isNull()), ("no_product", tx.non_empty("product").isNull())
            ).alias("reject_reason"),
        ),
        "reject_reason",
    )


# --- Image texts ----------------------------------------------------------------------------------


def stage_image_texts(rows: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """Reviews from recognised texts. The product is unknown, so the file stem stands for it."""
    # Out through a generator: a filter on the reject reason would otherwise repeat a recogniser below it.
    rows = rows.select(F.inline(F.array(F.struct(F.col(path).alias(path), F.col(text).alias(text)))))
    return schema.conform(
        rows.where(F.col(path).rlike(r"\.(jpg|png)$")).select(
            schema.review_id(schema.SOURCE_IMAGE, tx.file_name(path)).alias("review_id"),
            tx.file_stem(path).alias("product_id"),
            F.lit(schema.SOURCE_IMAGE).alias("source"),
            tx.strip(text).alias("text_raw"),
            first_reason(("no_text", F.coalesce(tx.strip(text), F.lit("")) == "")).alias("reject_reason"),
        ),
        "reject_reason",
    )


def listing_order(path: str = "path") -> list[Column]:
    """Sort key of an image listing: all jpg by name, then all png."""
    return [F.regexp_extract(path, r"\.([^.]+)$", 1), F.col(path)]


def read_images(spark: SparkSession, directory: str, extract: BatchFunction) -> DataFrame:
    """Images of one directory through a user's recogniser, which maps batches of bytes to texts."""
    recognise = batch_udf(extract, "string")
    images = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.{jpg,png}")
        .load(directory)
        .select("path", recognise("content").alias("text"))
    )
    return stage_image_texts(images)


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """Rows with ``place``, from 1 in the given order.

    They are sorted by range and written once; a row's place is its place in its range plus the sizes of the ranges
    before, of which there are few. No task sees all rows.
    """
    spark = df.sparkSession
    ranged = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    ranged = stored(spark, "numbered", ranged)
    part, within = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return placed.select(*df.columns, (F.col("_before") + within + 1).alias("place"))
