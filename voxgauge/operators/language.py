"""Language of a text from character trigrams.

Profiles are built by aggregation and may be of any number of languages. If they are small by count of their bytes they
are broadcast, and a text's grams are looked up where the text is read; else its grams meet them by join. Either way each
text's sums are combined before the shuffle, so about one row per text and language moves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from voxgauge.functions.batch import text_pieces
from voxgauge.functions.text import col, long_enough
from voxgauge.operators.joins import BROADCAST_BYTES, counted_bytes

PROFILE_SIZE = 300

# Overlapping trigrams in one pass; a gram never starts inside a surrogate pair.
TRIGRAM = r"(?s)(?![\uDC00-\uDFFF])(?=(.{3}))"


def trigrams(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(col(c)), F.lit(TRIGRAM), 1)


def build_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE_SIZE) -> DataFrame:
    """``(lang, gram, weight)``: the most frequent grams of each language.

    The weight is the log share less a floor common to all profiles, so that a match always adds.
    """
    counts = (
        docs.where(F.col(lang).isNotNull())
        .select(F.col(lang).alias("lang"), F.explode(trigrams(text)).alias("gram"))
        .groupBy("lang", "gram")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("place", F.row_number().over(by_count)).where(F.col("place") <= size)
    share = F.log(F.col("n") / F.sum("n").over(Window.partitionBy("lang")))
    # At most `size` rows per language reach this one-partition window.
    floor = F.min("share").over(Window.partitionBy(F.lit(1))) - 1.0
    return top.withColumn("share", share).select("lang", "gram", (F.col("share") - floor).alias("weight"))


def _gram_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping trigrams of the texts as numbers, 21 bits per character, and the place of each one's text."""
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    chars = np.frombuffer("".join(pc.fill_null(texts, "").to_pylist()).encode("utf-32-le"), "<u4").astype(np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    inside = text[:-2] == text[2:]
    return ((chars[:-2] << 42) | (chars[1:-1] << 21) | chars[2:])[inside], text[:-2][inside]


#: Sums of text and language, and weights looked up, that a task holds at once.
HELD_SUMS, HELD_WEIGHTS = 1 << 20, 1 << 22


def _sums_in_place(profiles: DataFrame, text: Column) -> Column | None:
    """Language and weight of the grams of each text, added up; None if the profiles, which must be small, have null weights."""
    rows = profiles.where("lang is not null").select("lang", "gram", "weight").toArrow().combine_chunks()
    rows = rows.filter(pc.fill_null(pc.equal(pc.utf8_length(rows["gram"]), 3), False)).combine_chunks()
    if not rows.num_rows or rows["weight"].null_count:
        return None
    languages = rows["lang"].combine_chunks().unique()
    codes = _gram_codes(rows["gram"].combine_chunks())[0]
    order = np.argsort(codes, kind="stable")
    grams, begin, width = np.unique(codes[order], return_index=True, return_counts=True)
    language = pc.index_in(rows["lang"].combine_chunks(), languages).to_numpy(zero_copy_only=False)[order]
    weight = rows["weight"].to_numpy()[order].astype(np.float64)
    shared = profiles.sparkSession.sparkContext.broadcast((languages, grams, begin, width, language, weight))

    def added(texts: pa.Array) -> pa.Array:
        languages, grams, begin, width, language, weight = shared.value
        n = len(languages)
        sums, times = np.zeros(len(texts) * n), np.zeros(len(texts) * n, np.int64)
        code, text = _gram_codes(texts)
        at = np.minimum(np.searchsorted(grams, code), len(grams) - 1)
        hit = grams[at] == code
        at, text = at[hit], text[hit]
        ends = np.cumsum(width[at])
        for part in np.split(np.arange(len(at)), np.searchsorted(ends, np.arange(HELD_WEIGHTS, ends[-1] if len(ends) else 0, HELD_WEIGHTS))):
            k = width[at[part]]
            entry = np.repeat(begin[at[part]] - np.cumsum(k) + k, k) + np.arange(k.sum())
            cell = np.repeat(text[part], k) * n + language[entry]
            sums += np.bincount(cell, weight[entry], minlength=len(sums))
            times += np.bincount(cell, minlength=len(sums))
        found = np.flatnonzero(times)
        edges = np.searchsorted(found, np.arange(len(texts) + 1) * n).astype(np.int32)
        pairs = pa.StructArray.from_arrays([languages.take(pa.array(found % n)), pa.array(sums[found])], ["lang", "weight"])
        return pa.ListArray.from_arrays(pa.array(edges), pairs)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        most = max(1, HELD_SUMS // len(shared.value[0]))  # texts
        for batch in batches:
            yield pa.concat_arrays(
                [added(p.slice(i, most)) for p in text_pieces(batch) for i in range(0, max(len(p), 1), most)]
            )

    pair = T.StructType([T.StructField("lang", profiles.schema["lang"].dataType), T.StructField("weight", T.DoubleType())])
    return F.arrow_udf(run, T.ArrayType(pair))(F.lower(text))


def language_scores(df: DataFrame, profiles: DataFrame, keys: list[str], text: str = "text_clean") -> DataFrame:
    """``keys``, ``language`` and ``score``: each key's best language, the sum of count times weight over its grams.

    Equal sums (to six digits) go to the lower code. A text without a gram of any profile has neither.
    """
    small = counted_bytes(profiles) <= BROADCAST_BYTES
    in_place = _sums_in_place(profiles, col(text)) if small else None
    if in_place is not None:
        found = df.select(*keys, F.explode_outer(in_place).alias("w"))
    else:
        # A language's weights of one gram side by side, so that a gram of the text stays one row.
        weights = profiles.groupBy("gram").agg(F.collect_list(F.struct("lang", "weight")).alias("weights"))
        grams = df.select(*keys, F.explode_outer(trigrams(text)).alias("gram"))
        found = grams.join(F.broadcast(weights) if small else weights, "gram", "left").select(*keys, F.explode_outer("weights").alias("w"))
    sums = found.groupBy(*keys, F.col("w.lang").alias("lang")).agg(F.sum("w.weight").alias("s"))
    order = F.struct((-F.round("s", 6)).alias("place"), "lang", "s")
    best = sums.groupBy(*keys).agg(F.min(F.when(F.col("lang").isNotNull(), order)).alias("best"))
    return best.select(*keys, F.col("best.lang").alias("language"), F.col("best.s").alias("score"))


def detect_language(df: DataFrame, profiles: DataFrame, text: str = "text_clean") -> DataFrame:
    """Sets ``language``; short texts stay undecided. Texts are told apart by their digest, so ids may repeat."""
    keyed = df.drop("language").withColumn("_key", F.md5(F.coalesce(F.col(text), F.lit(""))))
    distinct = keyed.where(long_enough(text)).select("_key", text).dropDuplicates(["_key"])
    found = language_scores(distinct, profiles, ["_key"], text).select("_key", "language")
    return keyed.join(found, "_key", "left").drop("_key")
