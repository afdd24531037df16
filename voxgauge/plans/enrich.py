"""Reviews through cleaning, language, aspects and entities to index rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from voxgauge.functions import aspects as asp, text as tx
from voxgauge.functions.entities import extract_skus, sorted_set
from voxgauge.operators.brands import find_brands
from voxgauge.operators.language import detect_language
from voxgauge.operators.sentiment import score_texts, with_stars
from voxgauge.schema import ASPECTS

#: Columns of an index, the same whatever a load has found; the vector column may be left out of a reading.
_TEXT = T.StringType()
_NAMES = T.ArrayType(_TEXT)
INDEX = T.StructType(
    [T.StructField(c, _TEXT) for c in ("review_id", "document", "product_id", "source")]
    + [T.StructField("rating", T.DoubleType()), T.StructField("text_raw", _TEXT)]
    + [T.StructField(c, _TEXT) for c in (*[f"aspect_{a}" for a in ASPECTS], "language")]
    + [
        T.StructField("review_date", T.DateType()),
        T.StructField("entities", T.StructType([T.StructField("brands", _NAMES), T.StructField("skus", _NAMES)])),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

NO_RATING = -1.0
NO_ASPECT = "none"


def preprocess(reviews: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """Sets ``text_clean``, and ``language`` when profiles are given; ``text_raw`` stays as it is."""
    cleaned = reviews.withColumn("text_clean", tx.clean_text("text_raw"))
    return cleaned if profiles is None else detect_language(cleaned, profiles)


def _with_label_map(df: DataFrame, label) -> DataFrame:
    entries = [x for a in ASPECTS for x in (F.lit(a), label(a))]
    return df.withColumn("aspects", F.create_map(*entries))


def analyse_aspects(reviews: DataFrame, scorer) -> DataFrame:
    """Sets ``aspects`` (map of the four names to a label or null) with a batch scorer of stars."""
    spoken = asp.with_aspect_texts(reviews, tx.analysed_text())

    def label(a: str) -> Column:
        part = asp.scored_text(f"aspect_texts.{a}")
        return F.when(part.isNotNull(), asp.star_label(scorer(part)))

    return _with_label_map(spoken, label).drop("aspect_texts")


def analyse_aspects_by_weights(reviews: DataFrame, weights: DataFrame, cuts: DataFrame) -> DataFrame:
    """The same with learned token weights: aspect texts are exploded, scored by join and folded back."""
    spoken = asp.with_aspect_texts(reviews, tx.analysed_text())
    parts = F.array(
        *[F.struct(F.lit(a).alias("aspect"), asp.scored_text(f"aspect_texts.{a}").alias("text")) for a in ASPECTS]
    )
    rows = spoken.select("review_id", F.explode(F.filter(parts, lambda p: p["text"].isNotNull())).alias("p"))
    starred = with_stars(score_texts(rows.select("review_id", "p.*"), weights, ["review_id", "aspect"]), cuts)
    labels = starred.groupBy("review_id").agg(
        *[F.max(F.when(F.col("aspect") == a, asp.star_label("stars"))).alias(f"_{a}") for a in ASPECTS]
    )
    joined = spoken.drop("aspect_texts").join(labels, "review_id", "left")
    return _with_label_map(joined, lambda a: F.col(f"_{a}")).drop(*[f"_{a}" for a in ASPECTS])


def extract_entities(reviews: DataFrame, phrases: DataFrame | None = None, finder=None) -> DataFrame:
    """Sets ``entities`` (brands, skus).

    Brands come from a user's batch finder, which reads the head of the text and needs no shuffle, or from
    a dictionary by join; with neither they are empty.
    """
    empty = F.array().cast("array<string>")
    text = tx.analysed_text()
    if phrases is not None:
        named = find_brands(reviews.select("review_id", text.alias("text")), phrases)
        reviews = reviews.join(named, "review_id", "left")
        brands = F.coalesce("brands", empty)
    elif finder is not None:
        brands = sorted_set(F.transform(finder(tx.cut(text, tx.MODEL_CHARS)), lambda b: tx.strip(b)))
    else:
        brands = empty
    entities = F.struct(brands.alias("brands"), extract_skus(text).alias("skus"))
    return reviews.withColumn("entities", entities).drop("brands")


def enrich(
    reviews: DataFrame, profiles: DataFrame | None = None, scorer=None, phrases: DataFrame | None = None, finder=None
) -> DataFrame:
    """Cleaning, language, aspects and entities in turn; what has no model or dictionary stays unset."""
    done = preprocess(reviews, profiles)
    if scorer is not None:
        done = analyse_aspects(done, scorer)
    return extract_entities(done, phrases, finder)


def index_rows(reviews: DataFrame) -> DataFrame:
    """One row per review with text, in the columns and types of ``INDEX``; what a load lacks is null.

    An id that is no string, as of a numbered table, keeps its type.
    """
    has = set(reviews.columns)
    made = {"document": tx.analysed_text()}
    for a in ASPECTS:
        made[f"aspect_{a}"] = F.col("aspects")[a] if "aspects" in has else F.lit(None)

    def column(f: T.StructField) -> Column:
        value = made.get(f.name, F.col(f.name) if f.name in has else F.lit(None))
        return (value if f.name == "review_id" else value.cast(f.dataType)).alias(f.name)

    rows = reviews.select(*[column(f) for f in INDEX.fields])
    return rows.where(F.length("document") > 0)


def filled(index: DataFrame) -> DataFrame:
    """The index with sentinels for nulls, as a store without nulls shows it."""
    return index.withColumns(
        {
            "rating": F.coalesce("rating", F.lit(NO_RATING)),
            **{f"aspect_{a}": F.coalesce(tx.non_empty(f"aspect_{a}"), F.lit(NO_ASPECT)) for a in ASPECTS},
        }
    )


def aspect_coverage(reviews: DataFrame) -> DataFrame:
    """Reviews, and those with at least one aspect label."""
    return reviews.agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.count_if(F.size(asp.present_aspects("aspects")) > 0).alias("n_detected"),
    )
