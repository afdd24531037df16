"""Aspects of a review by keyword, and the sentences that speak of each. No shuffle: arrays per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from voxgauge.functions.text import MODEL_CHARS, col, cut, split_sentences
from voxgauge.schema import ASPECTS

# Keywords per aspect, matched as substrings of the lower-cased sentence.
ASPECT_KEYWORDS = {
    "product": ["product", "quality", "produit", "qualité", "material", "matière"],
    "shipping": ["shipping", "delivery", "livraison", "shipped", "arrived", "package", "colis", "livré"],
    "service": ["service", "support", "customer service", "seller", "vendeur", "service client"],
    "price": ["price", "prix", "expensive", "cher", "cheap", "value", "worth", "coûte"],
}


def mentions(lowered: Column, keywords: list[str]) -> Column:
    return reduce(lambda x, y: x | y, [lowered.contains(k) for k in keywords])


def detect_aspects(sentence: Column | str) -> Column:
    """Aspects a sentence mentions, in vocabulary order."""
    low = F.lower(col(sentence))
    return F.array_compact(
        F.array(*[F.when(mentions(low, ASPECT_KEYWORDS[a]), F.lit(a)) for a in ASPECTS])
    )


def with_aspect_sentences(df: DataFrame, text: Column, out: str = "aspect_sentences") -> DataFrame:
    """Struct with, per aspect, the array of its sentences in order.

    The whole text is tested first: only texts that hold a keyword are split, and only for its aspects.
    """
    df = df.withColumn("_text", text).withColumn("_low", F.lower("_text"))
    df = df.withColumns({f"_has_{a}": mentions(F.col("_low"), ASPECT_KEYWORDS[a]) for a in ASPECTS})
    any_aspect = reduce(lambda x, y: x | y, [F.col(f"_has_{a}") for a in ASPECTS])
    pairs = F.transform(split_sentences("_text"), lambda s: F.struct(s.alias("s"), F.lower(s).alias("low")))
    df = df.withColumn("_sentences", F.when(any_aspect, pairs))

    def spoken(aspect: str) -> Column:
        found = F.filter("_sentences", lambda x: mentions(x["low"], ASPECT_KEYWORDS[aspect]))
        said = F.transform(found, lambda x: x["s"])
        none = F.array().cast("array<string>")
        return F.when(F.col(f"_has_{aspect}"), said).otherwise(none).alias(aspect)

    spare = ["_text", "_low", "_sentences", *[f"_has_{a}" for a in ASPECTS]]
    return df.withColumn(out, F.struct(*[spoken(a) for a in ASPECTS])).drop(*spare)


def is_silent(sentences: str = "aspect_sentences") -> Column:
    """No aspect at all is mentioned."""
    return reduce(lambda x, y: x & y, [F.size(f"{sentences}.{a}") == 0 for a in ASPECTS])


def with_aspect_texts(df: DataFrame, text: Column, out: str = "aspect_texts") -> DataFrame:
    """Struct with, per aspect, its sentences joined by one space; null where unmentioned.

    A review that mentions no aspect is about the product, with its whole text.
    """
    df = with_aspect_sentences(df.withColumn("_whole", text), F.col("_whole"), "_spoken")
    joined = []
    for a in ASPECTS:
        found = F.when(F.size(f"_spoken.{a}") > 0, F.array_join(f"_spoken.{a}", " "))
        whole = F.when(is_silent("_spoken"), F.col("_whole")).otherwise(found)
        joined.append((whole if a == "product" else found).alias(a))
    return df.withColumn(out, F.struct(*joined)).drop("_whole", "_spoken")


def scored_text(c: Column | str) -> Column:
    """The part of an aspect's text a scorer reads."""
    return cut(c, MODEL_CHARS)


def star_label(star_count: Column | str) -> Column:
    """One to five stars to negative, neutral, positive."""
    s = col(star_count)
    return F.when(s <= 2, "negative").when(s == 3, "neutral").when(s > 3, "positive")


def present_aspects(aspects: Column | str) -> Column:
    """Map entries that have a value."""
    return F.map_filter(col(aspects), lambda _, v: v.isNotNull())
