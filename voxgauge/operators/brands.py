"""Brand names by dictionary: capitalised words and word pairs joined to a table of phrases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from voxgauge.functions.batch import BatchFunction, batch_udf
from voxgauge.functions.entities import names_brand, sorted_set
from voxgauge.functions.text import MODEL_CHARS, col, cut
from voxgauge.operators.joins import sized

CAPITALISED = r"\b\p{Lu}[\p{L}\p{N}]*"


def candidates(c: Column | str, max_chars: int | None = MODEL_CHARS) -> Column:
    """Distinct capitalised words, and pairs of them with one space between, in the text's head."""
    c = col(c) if max_chars is None else cut(c, max_chars)
    single = F.regexp_extract_all(c, F.lit(f"(?U){CAPITALISED}"), 0)
    pairs = F.regexp_extract_all(c, F.lit(rf"(?U){CAPITALISED}(?=( {CAPITALISED}))"), 0)
    second = F.regexp_extract_all(c, F.lit(rf"(?U){CAPITALISED}(?=( {CAPITALISED}))"), 1)
    return F.array_distinct(F.concat(single, F.zip_with(pairs, second, lambda a, b: F.concat(a, b))))


def find_brands(
    texts: DataFrame, phrases: DataFrame, key: str = "review_id", text: str = "text", max_chars: int | None = MODEL_CHARS
) -> DataFrame:
    """``(key, brands)`` for texts that name a phrase of the dictionary, brands sorted.

    The dictionary may be of any size: it is counted before the join is planned. Repeats in a text are
    dropped inside its row.
    """
    found = texts.select(key, F.explode(candidates(text, max_chars)).alias("phrase"))
    found = found.join(sized(phrases.select("phrase").distinct()), "phrase")
    return found.groupBy(key).agg(sorted_set(F.collect_set("phrase")).alias("brands"))


def naming(texts: DataFrame, brands: list[str], text: str = "text") -> DataFrame:
    """Texts that hold any of a short list of brands, case kept."""
    return texts.where(names_brand(text, brands))


def brand_counts(found: DataFrame) -> DataFrame:
    return (
        found.select(F.explode("brands").alias("brand"))
        .groupBy("brand")
        .agg(F.count(F.lit(1)).alias("n_reviews"))
    )


def finder_udf(finder: BatchFunction):
    """A user's name finder as a column function: batches of texts to arrays of names."""
    return batch_udf(finder, "array<string>")
