"""Benchmark passages in training texts by a positional inverted index; DataFrame operations only.

The index holds a posting (text, place, term) for every training word that occurs in the benchmark. The benchmark's windows
of ten words are looked up from their rarest terms: the lists of a window's rarest terms, each moved back by the term's
place in the item, are intersected, which gives the texts and alignments where the window can be. There all
terms of the item are aligned the same way, and every run of matched places at least a window long is an occurrence.

Nothing grows by the square of a group: a posting meets the few places of its term among the rarest of the items, and full
lists are read only in texts where the rarest terms agree. A short item, of fewer words than a window, is a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from voxgauge.llm.shared import broadcast_if_small, fresh_name, stored

#: Words of a window.
WINDOW = 10
#: Rarest terms of a window whose lists are intersected before whole items are aligned.
RAREST = 3

# The word rule.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    """Words of a text, A-Z lower-cased; none of a null."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def item_rows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Items with words: item (digest of the words), item_id, n (words), w (words of a window), ws."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words("text").alias("ws"))
    return rows.filter(F.size("ws") > 0).select(
        F.md5(F.array_join("ws", " ")).alias("item"),
        "item_id",
        F.size("ws").alias("n"),
        F.least(F.size("ws"), F.lit(window)).alias("w"),
        "ws",
    )


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: row, place and term of every word that is a term; and one line per text with its number of words.

    That line has term -1, the number of words as its place, the document's id and the hash of its text (tag); the others
    carry neither. Write the result before use: ``row`` numbers the rows of this scan, so that equal ids stay apart.
    """
    closed = F.concat(words("text"), F.array(F.lit("")))  # the last place of a text stands for its length
    placed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"),
        F.monotonically_increasing_id().alias("row"),
        closed.alias("ws"),
    ).select("doc_id", "tag", "row", F.posexplode("ws").alias("place", "word"))
    last = F.col("term") == -1
    return placed.join(terms, "word").select(
        "row", "place", "term", F.when(last, F.col("doc_id")).alias("doc_id"), F.when(last, F.col("tag")).alias("tag")
    )


def matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Occurrences (row, item_id, first, last: places of the first and the last word), and texts (row, doc_id, tag,
    n_words).

    An occurrence is a whole run: windows that follow one another at one alignment are one occurrence.
    """
    rows = stored(spark, "items", item_rows(benchmark, window))
    ids = rows.select("item", "item_id").distinct()
    items = rows.dropDuplicates(["item"]).select("item", "n", "w", F.posexplode("ws").alias("at", "word"))
    numbered = items.select("word").distinct().select("word", F.xxhash64("word").bitwiseAND(2**63 - 1).alias("term"))
    end = spark.range(1).select(F.lit("").alias("word"), F.lit(-1).cast("long").alias("term"))
    terms = stored(spark, "terms", numbered.unionByName(end))
    index = stored(spark, "postings", postings(docs, broadcast_if_small(terms)))
    texts = index.filter("term = -1").select("row", "doc_id", "tag", F.col("place").cast("long").alias("n_words"))
    index = index.filter("term <> -1").select("row", "place", "term")

    frequency = index.groupBy("term").agg(F.count("*").alias("df"))
    known = items.join(terms, "word").join(frequency, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    known = stored(spark, "item-frequencies", known)

    # The rarest places of every window: windows are numbered by their first place in the item.
    starts = known.withColumn(
        "start",
        F.explode(F.sequence(F.greatest(F.col("at") - F.col("w") + 1, F.lit(0)), F.least("at", F.col("n") - F.col("w")))),
    )
    by_rarity = W.partitionBy("item", "start").orderBy("df", "at")
    rarest = starts.withColumn("k", F.row_number().over(by_rarity)).filter(F.col("k") <= RAREST)
    chosen = F.collect_list(F.struct("term", "at")).alias("chosen")
    wanted = rarest.groupBy("item", "start").agg(F.count("*").alias("need"), F.min("df").alias("least"), chosen)
    wanted = wanted.filter("least > 0")  # a term without postings: the window occurs nowhere
    anchors = stored(spark, "anchors", wanted.select("item", "start", "need", F.inline("chosen")))
    places = anchors.select("term", "item", "at").distinct()

    # Lists of the rarest terms, moved back by the place in the item; then the windows in which they all agree.
    aligned = index.join(broadcast_if_small(places), "term").select(
        "row", "item", "at", (F.col("place") - F.col("at")).alias("shift")
    )
    enough = anchors.groupBy("item").agg(F.min("need").alias("need"))
    groups = aligned.groupBy("row", "item", "shift").agg(F.count_distinct("at").alias("have"))
    groups = groups.join(broadcast_if_small(enough), "item").filter("have >= need")
    agreed = stored(spark, "agreed", groups.select("row", "item", "shift"))

    # All terms of the item at the alignments left; runs of matched places.
    candidates = agreed.join(broadcast_if_small(known.select("item", "n", "w", "at", "term")), "item").select(
        "row", "item", "shift", "w", "at", "term", (F.col("shift") + F.col("at")).alias("place")
    )
    near = index.join(broadcast_if_small(agreed.select("row").distinct()), "row", "left_semi")
    found = candidates.join(near, ["row", "place", "term"])
    order = W.partitionBy("row", "item", "shift").orderBy("at")
    runs = found.withColumn("run", F.col("at") - F.row_number().over(order))
    runs = runs.groupBy("row", "item", "shift", "run").agg(
        F.first("w").alias("w"), F.count("*").alias("len"), F.min("place").alias("first"), F.max("place").alias("last")
    )
    runs = runs.filter("len >= w")
    return runs.join(broadcast_if_small(ids), "item").select("row", "item_id", "first", "last"), texts


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, tag (hash of the text), n_words, n_hit (words inside occurrences), items (sorted ids as
    text), spans.

    Null and empty texts have no words and no hits; a null id of an item is left out of ``items``; rows that share an
    id are told apart and each gets its line. Without items, or without texts, there are no hits or no lines. Other
    columns of the inputs are not read.
    """
    runs, texts = matches(spark, docs, benchmark, window)
    runs = stored(spark, "occurrences", runs)
    hit = runs.select("row", F.explode(F.sequence("first", "last")).alias("place")).distinct()
    hit = hit.groupBy("row").agg(F.count("*").alias("n_hit"))
    found = runs.groupBy("row").agg(
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
        F.sort_array(F.collect_set(F.struct("first", "last", "item_id"))).alias("spans"),
    )
    joined = texts.join(broadcast_if_small(hit.join(found, "row")), "row", "left")
    return joined.select(
        "doc_id",
        "tag",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)).alias("spans"),
    )


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any occurrence, with all their columns."""
    found = contamination(spark, docs, benchmark, window).filter("n_hit > 0")
    gone = found.select(F.col("doc_id").alias("gone_id"), F.col("tag").alias("gone_tag")).distinct()
    gone = broadcast_if_small(stored(spark, "contaminated", gone))
    tag = fresh_name(docs, "tag")
    rows = docs.withColumn(tag, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = rows["doc_id"].cast("long").eqNullSafe(gone["gone_id"]) & (rows[tag] == gone["gone_tag"])
    return rows.join(gone, same, "left_anti").select(*docs.columns)
