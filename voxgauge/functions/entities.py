"""Product codes and brand names in text."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from voxgauge.functions.text import col

# Fixed value: one to three capitals, four or more digits, then capitals or digits.
SKU_PATTERN = r"(?U)\b[A-Z]{1,3}\d{4,}[A-Z0-9]*\b"


def sorted_set(values: Column | str) -> Column:
    return F.array_sort(F.array_distinct(col(values)))


def extract_skus(c: Column | str) -> Column:
    return sorted_set(F.regexp_extract_all(col(c), F.lit(SKU_PATTERN), 0))


def names_brand(c: Column | str, brands: list[str]) -> Column:
    """Case-sensitive substring test against a short list of brands."""
    return col(c).rlike("|".join(re.escape(b) for b in brands))
