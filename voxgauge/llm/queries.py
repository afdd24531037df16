"""The registered queries of the operators, with production parameters, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from voxgauge.llm import (
    decontaminate,
    language_id,
    lm_scoring,
    near_dedup,
    neighbours,
    packing,
    prefix_trie,
    quality,
    substring_dedup,
    token_files,
    toxicity,
    url_filter,
    whitening,
)
from voxgauge.llm.shared import documents, remainder, table
from voxgauge.session import shared_path, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


@_query("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), path)
    read = token_files.read_token_files(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack(spark, documents(spark, sf_dir))
    return placed.select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "sequence_id",
        "offset",
    )


_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{decontaminate.UPPER}', '{decontaminate.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@_query(
    "op1_decontamination",
    f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
    b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
    i AS (SELECT item_id, ws, least(len(ws), 10) AS w FROM b WHERE len(ws) > 0),
    iw AS (
      SELECT DISTINCT item_id, w, array_to_string(ws[s:s + w - 1], ' ') AS phrase
      FROM (SELECT *, unnest(range(1, len(ws) - w + 2)) AS s FROM i)
    ),
    dw AS (
      SELECT doc_id, w, s, array_to_string(ws[s:s + w - 1], ' ') AS phrase
      FROM (
        SELECT doc_id, ws, w, unnest(range(1, len(ws) - w + 2)) AS s FROM d, (SELECT DISTINCT w FROM i) AS k
        WHERE len(ws) >= w
      )
    ),
    h AS (SELECT doc_id, item_id, s, w FROM dw JOIN iw USING (w, phrase)),
    p AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (
      SELECT doc_id, unnest(range(s, s + w)) AS place FROM (SELECT DISTINCT doc_id, s, w FROM h)) GROUP BY doc_id),
    g AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN p USING (doc_id) LEFT JOIN g USING (doc_id)
    """,
)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(spark, documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.fit(docs.filter(remainder("doc_id", 3) != 1))
    found = language_id.predict(docs.select("doc_id", "text"), model, drop_text=True)
    return found.select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        "cosine",
        "rejected",
    )


#: The rules of the contract.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


@_query("op7_url_filter")
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "url_score")


@_query("op9_substring_dedup")
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its text without passages that an earlier document holds, and where they stood."""
    found = substring_dedup.dedup(spark, documents(spark, sf_dir).select("doc_id", "text"))
    return found.withColumn("has_repeats", F.col("removed_bytes") > 0)


@_query("op5_minhash_near_dedup")
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with the class of its near copies."""
    found = near_dedup.classes(spark, documents(spark, sf_dir))
    return found.select("doc_id", "class_id", "class_size", "n_links", "kept")


@_query("op10_lm_scoring")
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", (remainder("doc_id", 10) != 0).alias("train"))
    found = lm_scoring.scores(spark, docs)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), *found.columns[2:])


@_query("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "n_chars")
    model = quality.fit(docs, table(spark, sf_dir, "labels").filter(remainder("doc_id", 5) != 0))
    return quality.score(docs, model, drop_text=True).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.3).cast("int").alias("predicted"),
    )


@_query("op6_nearest_neighbours")
def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(spark, vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


@_query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding projected on the 32 leading eigenvectors of the covariance, over sqrt of the eigenvalue."""
    found = whitening.whiten(spark, table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue")


#: crc32 of a string in DuckDB, bit by bit: eight shifts by the reflected polynomial per byte (a rule, not a table).
_CRC_STEP = "list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 & -(a & 1)) + z)"


def _crc32_sql(text: str) -> str:
    chars = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {chars}), lambda crc, b: {_CRC_STEP}), 4294967295)"


@_query(
    "op13_conversation_trie",
    f"""
    WITH t AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
      FROM conversations WHERE conv_id IS NOT NULL
    ),
    ids AS (
      SELECT c, c - c % 100 AS base, {_crc32_sql("CAST(c AS VARCHAR)")} % 6 AS h
      FROM (SELECT DISTINCT conv_id AS c FROM t)
    ),
    r AS (
      SELECT ids.c, t.pos, t.role, t.text FROM ids JOIN t ON t.conv_id = ids.base AND t.pos <= ids.h
      UNION ALL
      SELECT ids.c, t.pos, t.role, t.text FROM ids JOIN t ON t.conv_id = ids.c AND t.pos > ids.h
    ),
    s AS (
      SELECT ids.c,
        coalesce(list(struct_pack(r := r.role, t := r.text) ORDER BY r.pos) FILTER (WHERE r.pos IS NOT NULL), []) AS seq,
        coalesce(list(CAST(length(r.text) AS BIGINT) ORDER BY r.pos) FILTER (WHERE r.pos IS NOT NULL), []) AS lens
      FROM ids LEFT JOIN r ON r.c = ids.c GROUP BY ids.c
    ),
    p AS (
      SELECT c, d, seq[1:d] AS key, len(seq) AS n, CASE WHEN d = 0 THEN 0 ELSE lens[d] END AS l
      FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM s)
    ),
    node AS (
      SELECT key, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(l) AS l,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256
      FROM p GROUP BY key
    ),
    kids AS (SELECT key[1:len(key) - 1] AS key, count(*) AS n_children FROM node WHERE len(key) > 0 GROUP BY 1),
    leafy AS (SELECT node.*, coalesce(kids.n_children, 0) AS n_children FROM node LEFT JOIN kids USING (key)),
    sub AS (
      SELECT key[1:a] AS key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * l) AS saved
      FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM leafy) GROUP BY 1
    )
    SELECT leafy.conv_id, CAST(leafy.depth AS BIGINT) AS depth, par.conv_id AS parent_conv_id, leafy.n_convs,
      CAST(leafy.n_children AS BIGINT) AS n_children, CAST(sub.n_leaves AS BIGINT) AS n_leaves,
      CAST(sub.saved AS BIGINT) AS saved_tokens, leafy.ends_sha256
    FROM leafy JOIN sub USING (key) LEFT JOIN node AS par ON leafy.depth > 0 AND par.key = leafy.key[1:len(leafy.key) - 1]
    """,
)
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix tree of the rebuilt conversations, with members, children, leaves and savings."""
    return prefix_trie.nodes(spark, table(spark, sf_dir, "conversations"))


@_query("op11_toxicity")
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored for toxicity by a classifier trained on the label model's posteriors of the training rows."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    docs = stored(spark, "toxicity", toxicity.with_features(docs))  # the texts are scanned once, for learning and scoring
    train = docs.filter(remainder("doc_id", 5) != 0)
    model = toxicity.fit(train, table(spark, sf_dir, "labels").filter(remainder("doc_id", 5) != 0))
    return toxicity.score(docs, model, drop_text=True).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= 0.5).cast("int").alias("predicted"),
    )
