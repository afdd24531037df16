"""Sentiment a question asks for."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from voxgauge.functions.text import col, strip

# Substrings of the lower-cased question; the negative list is tried first.
NEGATIVE_INTENT = [
    "complain", "problem", "issue", "wrong", "worst", "disappoint",
    "défaut", "problème", "plainte", "pire",
]
POSITIVE_INTENT = [
    "love", "best", "great", "recommend",
    "aime", "meilleur", "recommand",
]


def wanted_sentiment(question: Column | str) -> Column:
    low = F.lower(col(question))
    return F.when(low.rlike("|".join(NEGATIVE_INTENT)), "negative").when(
        low.rlike("|".join(POSITIVE_INTENT)), "positive"
    )


def is_blank(question: Column | str) -> Column:
    return F.coalesce(F.length(strip(question)), F.lit(0)) == 0
