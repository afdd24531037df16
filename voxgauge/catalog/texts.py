"""Queries on text: cleaning, sentences, aspects, entities, language, sentiment, intent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from voxgauge.catalog.registry import query, table
from voxgauge.functions import aspects as asp, entities as ent, intent, text as tx
from voxgauge.operators import brands as br, embed as em, language as lg, sentiment as st
from voxgauge.plans import enrich
from voxgauge.schema import ASPECTS
from voxgauge.session import stored

# Every Unicode space, for engines whose \s knows only ASCII.
SQL_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g')"


def sql_decode(c: str) -> str:
    """The entities the pages hold, with or without their semicolon, as a page may cut one short.

    The ampersand goes last, so that nothing is decoded twice.
    """
    for entity, char in (
        ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("copy", "©"), ("middot", "·"), ("amp", "&"),
    ):
        c = f"regexp_replace({c}, '&{entity};?', '{char}', 'g')"
    return c


def sql_clean(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace({sql_decode(c)}, '<[^>]+>', ' ', 'g'), '{SQL_SPACE}+', ' ', 'g'))"


# --- Cleaning -------------------------------------------------------------------------------------


@query(f"SELECT page_id, {sql_clean('html')} AS text_clean FROM pages")
def clean_pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", tx.clean_text("html").alias("text_clean"))


@query(
    f"""SELECT doc_id, md5(text) AS raw_md5, md5({sql_clean('text')}) AS clean_md5,
    left({sql_clean('text')}, 50) AS head, md5(coalesce(nullif({sql_clean('text')}, ''), text)) AS analysed_md5
    FROM documents"""
)
def preprocessed(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaning beside the raw text, which stays as it was; the head is a preview."""
    reviews = table(spark, sf, "documents").select("doc_id", F.col("text").alias("text_raw"))
    return enrich.preprocess(reviews).select(
        "doc_id",
        F.md5("text_raw").alias("raw_md5"),
        F.md5("text_clean").alias("clean_md5"),
        tx.cut("text_clean", 50).alias("head"),
        F.md5(tx.analysed_text()).alias("analysed_md5"),
    )


# --- Sentences and aspects ------------------------------------------------------------------------

# Text with remarks on delivery, price and service added by source, as the prose itself has next to none.
REMARKS = {
    "src1": " Great price. Arrived late!",
    "src2": " The package was fine, bad customer service?  Poor quality.",
    "src3": " Livraison rapide! Le vendeur est cher.",
}


def remarked() -> Column:
    remark = F.lit("")
    for source, words in REMARKS.items():
        remark = F.when(F.col("source") == source, words).otherwise(remark)
    return F.concat(F.col("text"), remark)


SQL_REMARKED = (
    "text || CASE source "
    + " ".join(f"WHEN '{s}' THEN '{w}'" for s, w in REMARKS.items())
    + " ELSE '' END"
)


def sql_sentences(c: str) -> str:
    marked = f"regexp_replace({sql_strip(c)}, '([.!?]){SQL_SPACE}+', '\\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda s: s <> '')"


def sql_mentions(c: str, aspect: str) -> str:
    return f"regexp_matches(lower({c}), '{'|'.join(asp.ASPECT_KEYWORDS[aspect])}')"


@query(
    f"""SELECT doc_id, len(s) AS n_sentences, list_max(list_transform(s, lambda x: length(x))) AS longest,
    md5(array_to_string(s, '|')) AS sentences_md5 FROM (SELECT doc_id, {sql_sentences('text')} AS s FROM documents)"""
)
def sentences(spark: SparkSession, sf: str) -> DataFrame:
    split = table(spark, sf, "documents").withColumn("s", tx.split_sentences("text"))
    return split.select(
        "doc_id",
        F.size("s").cast("long").alias("n_sentences"),
        F.array_max(F.transform("s", F.length)).cast("long").alias("longest"),
        F.md5(F.array_join("s", "|")).alias("sentences_md5"),
    )


@query(
    f"WITH s AS (SELECT doc_id, unnest({sql_sentences(SQL_REMARKED)}) AS s FROM documents) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS aspect, count(*) AS n_sentences, count(DISTINCT doc_id) AS n_reviews FROM s "
        f"WHERE {sql_mentions('s', a)} HAVING count(*) > 0"
        for a in ASPECTS
    )
)
def aspect_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences and reviews per aspect, counted inside each review first."""
    spoken = asp.with_aspect_sentences(table(spark, sf, "documents"), remarked())
    counts = F.array(
        *[F.struct(F.lit(a).alias("aspect"), F.size(f"aspect_sentences.{a}").alias("n")) for a in ASPECTS]
    )
    per_review = spoken.select(F.explode(F.filter(counts, lambda c: c["n"] > 0)).alias("c")).select("c.*")
    return per_review.groupBy("aspect").agg(
        F.sum("n").alias("n_sentences"), F.count(F.lit(1)).alias("n_reviews")
    )


def sql_spoken(a: str) -> str:
    return f"list_filter(s, lambda x: {sql_mentions('x', a)})"


@query(
    f"""WITH d AS (SELECT doc_id, {SQL_REMARKED} AS t, {sql_sentences(SQL_REMARKED)} AS s FROM documents),
    k AS (SELECT doc_id, t, {', '.join(f"{sql_spoken(a)} AS {a}" for a in ASPECTS)} FROM d),
    j AS (SELECT doc_id, CASE WHEN {' + '.join(f'len({a})' for a in ASPECTS)} = 0 THEN t
                         WHEN len(product) > 0 THEN array_to_string(product, ' ') END AS product,
      {', '.join(f"CASE WHEN len({a}) > 0 THEN array_to_string({a}, ' ') END AS {a}" for a in ASPECTS[1:])} FROM k)
    SELECT doc_id, {', '.join(f"md5({a}) AS {a}_md5, md5(left({a}, 512)) AS {a}_scored_md5" for a in ASPECTS)} FROM j"""
)
def aspect_texts(spark: SparkSession, sf: str) -> DataFrame:
    """What each review says of each aspect, whole and as a scorer reads it."""
    spoken = asp.with_aspect_texts(table(spark, sf, "documents"), remarked())
    return spoken.select(
        "doc_id",
        *[F.md5(f"aspect_texts.{a}").alias(f"{a}_md5") for a in ASPECTS],
        *[F.md5(asp.scored_text(f"aspect_texts.{a}")).alias(f"{a}_scored_md5") for a in ASPECTS],
    )


@query(
    f"""WITH d AS (SELECT {sql_sentences(SQL_REMARKED)} AS s FROM documents)
    SELECT count(*) AS n_reviews, count(*) AS n_detected,
      count(*) FILTER ({' + '.join(f'len({sql_spoken(a)})' for a in ASPECTS)} = 0) AS n_fallback FROM d"""
)
def aspect_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews with an aspect. Those that mention none fall back to the product, so all have one."""
    docs = table(spark, sf, "documents").withColumn("t", remarked())
    spoken = asp.with_aspect_sentences(asp.with_aspect_texts(docs, F.col("t")), F.col("t"))
    pairs = [x for a in ASPECTS for x in (F.lit(a), F.col(f"aspect_texts.{a}"))]
    return spoken.withColumn("aspects", F.create_map(*pairs)).agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.count_if(F.size(asp.present_aspects("aspects")) > 0).alias("n_detected"),
        F.count_if(asp.is_silent()).alias("n_fallback"),
    )


@query(
    """SELECT doc_id, quality * 4 + toxic AS stars,
    CASE WHEN quality * 4 + toxic <= 2 THEN 'negative' WHEN quality * 4 + toxic = 3 THEN 'neutral' ELSE 'positive' END
      AS label FROM labels"""
)
def star_labels(spark: SparkSession, sf: str) -> DataFrame:
    starred = table(spark, sf, "labels").withColumn("stars", F.col("quality") * 4 + F.col("toxic"))
    return starred.select("doc_id", "stars", asp.star_label("stars").alias("label"))


# --- Entities -------------------------------------------------------------------------------------


@query(
    r"""WITH d AS (SELECT doc_id, text || ' AB' || (10000 + doc_id) || ' B0012 AB' || (10000 + doc_id) AS t FROM documents),
    m AS (SELECT doc_id, list_sort(list_distinct(regexp_extract_all(t, '\b[A-Z]{1,3}\d{4,}[A-Z0-9]*\b'))) AS s FROM d)
    SELECT doc_id, array_to_string(s, ',') AS skus, len(s) AS n FROM m"""
)
def skus(spark: SparkSession, sf: str) -> DataFrame:
    code = F.concat(F.lit(" AB"), (F.col("doc_id") + 10000).cast("string"))
    found = table(spark, sf, "documents").select(
        "doc_id", ent.extract_skus(F.concat("text", code, F.lit(" B0012"), code)).alias("s")
    )
    return found.select("doc_id", F.array_join("s", ",").alias("skus"), F.size("s").cast("long").alias("n"))


BRANDS = ["Anthe", "Erthe", "Mentre", "Scher", "The"]


@query(
    " UNION ALL ".join(
        f"SELECT '{b}' AS brand, count(*) AS n_reviews FROM documents WHERE contains(text, '{b}') HAVING count(*) > 0"
        for b in BRANDS
    )
    + f""" UNION ALL SELECT 'any', count(*) FROM documents WHERE {' OR '.join(f"contains(text, '{b}')" for b in BRANDS)}"""
)
def brand_mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews that hold one of a few known names, in all and per name, in one scan."""
    held = br.naming(table(spark, sf, "documents"), BRANDS)
    names = F.array_compact(F.array(*[F.when(F.col("text").contains(b), F.lit(b)) for b in BRANDS]))
    tagged = held.select(F.concat(names, F.array(F.lit("any"))).alias("brands"))
    return br.brand_counts(tagged)


CAPITAL = r"\b\p{Lu}[\p{L}\p{N}]*"

# Capitalised words in at least one document of fifty stand for a dictionary.
SQL_DICTIONARY = r"""
words AS (
  SELECT doc_id, unnest(list_distinct(
    regexp_extract_all(text, '(?:^|[^\p{L}\p{N}_])(\p{Lu}[\p{L}\p{N}]*)', 1))) AS w
  FROM documents),
phrases AS (
  SELECT w AS phrase FROM words GROUP BY 1 HAVING count(*) * 50 >= (SELECT count(*) FROM documents))
"""


@query(
    f"""WITH {SQL_DICTIONARY},
    hit AS (SELECT w.doc_id, w.w FROM words w JOIN phrases p ON p.phrase = w.w)
    SELECT doc_id, string_agg(w, ',' ORDER BY w) AS brands FROM hit GROUP BY 1"""
)
def brand_join(spark: SparkSession, sf: str) -> DataFrame:
    """Dictionary names in whole texts; the dictionary is every frequent capitalised word."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("review_id"), "text")
    single = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?U)" + CAPITAL), 0))
    counted = docs.select(F.explode(single).alias("phrase")).groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
    total = docs.agg(F.count(F.lit(1))).scalar()
    phrases = stored(spark, "phrases", counted.where(F.col("n") * 50 >= total))
    found = br.find_brands(docs, phrases.select("phrase"), max_chars=None)
    return found.select(F.col("review_id").alias("doc_id"), F.array_join("brands", ",").alias("brands"))


# --- Language -------------------------------------------------------------------------------------


@query(
    f"""SELECT length({sql_strip('text')}) >= 20 AS decidable, count(*) AS n FROM
    (SELECT text FROM documents UNION ALL SELECT text FROM conversations) GROUP BY 1"""
)
def language_gate(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "documents").select("text").unionByName(table(spark, sf, "conversations").select("text"))
    return texts.groupBy(tx.long_enough("text").alias("decidable")).agg(F.count(F.lit(1)).alias("n"))


# All overlapping trigrams: non-overlapping ones from each of three starts.
SQL_PROFILE = r"""
g AS (
  SELECT doc_id, lang, unnest(list_concat(
      regexp_extract_all(lower(text), '(?s).{3}'),
      regexp_extract_all(substr(lower(text), 2), '(?s).{3}'),
      regexp_extract_all(substr(lower(text), 3), '(?s).{3}'))) AS gram
  FROM documents),
counts AS (SELECT lang, gram, count(*) AS n FROM g GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS place FROM counts),
shares AS (SELECT lang, gram, ln(n / sum(n) OVER (PARTITION BY lang)) AS share FROM top WHERE place <= 300),
profile AS (SELECT lang, gram, share - min(share) OVER () + 1 AS weight FROM shares)
"""


@query(f"WITH {SQL_PROFILE} SELECT lang, gram, round(weight, 6) AS weight FROM profile")
def language_profile(spark: SparkSession, sf: str) -> DataFrame:
    profiles = lg.build_profiles(table(spark, sf, "documents"))
    return profiles.select("lang", "gram", F.round("weight", 6).alias("weight"))


@query(
    f"""WITH {SQL_PROFILE},
    scores AS (SELECT doc_id, p.lang, round(sum(weight), 4) AS score FROM g JOIN profile p USING (gram) GROUP BY ALL),
    best AS (SELECT doc_id, lang, score, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS r FROM scores)
    SELECT d.doc_id, CASE WHEN length({sql_strip('d.text')}) >= 20 THEN b.lang END AS language,
      coalesce(b.score, 0) AS score
    FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id AND b.r = 1"""
)
def language_detect(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    profiles = stored(spark, "profiles", lg.build_profiles(docs))
    lengths = docs.select("doc_id", "text", tx.long_enough("text").alias("long"))
    best = lg.language_scores(lengths, profiles, ["doc_id", "long"], "text")
    return best.select(
        "doc_id",
        F.when(F.col("long"), F.col("language")).alias("language"),
        F.round(F.coalesce("score", F.lit(0.0)), 4).alias("score"),
    )


# --- Sentiment ------------------------------------------------------------------------------------

SQL_WEIGHTS = r"""
w AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))) AS token FROM documents),
totals AS (SELECT sum(quality) AS p, sum(1 - quality) AS n FROM labels JOIN documents USING (doc_id)),
weights AS (
  SELECT token, ln((sum(quality) + 1) / (any_value(p) + 2)) - ln((sum(1 - quality) + 1) / (any_value(n) + 2)) AS weight
  FROM w JOIN labels USING (doc_id), totals GROUP BY 1)
"""


@query(f"WITH {SQL_WEIGHTS} SELECT token, round(weight, 6) AS weight FROM weights")
def sentiment_weights(spark: SparkSession, sf: str) -> DataFrame:
    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return st.learn_weights(labelled).select("token", F.round("weight", 6).alias("weight"))


@query(
    f"""WITH {SQL_WEIGHTS},
    s AS (SELECT d.doc_id, avg(weight) AS score FROM documents d LEFT JOIN (w JOIN weights USING (token)) USING (doc_id) GROUP BY 1),
    bins AS (SELECT round(score, 3) AS bin, count(*) AS n FROM s WHERE score IS NOT NULL GROUP BY 1),
    upto AS (SELECT bin, sum(n) OVER (ORDER BY bin) / sum(n) OVER () AS u FROM bins),
    cuts AS (SELECT {', '.join(f'min(bin) FILTER (u >= {i} / 5) AS c{i}' for i in range(1, 5))} FROM upto),
    starred AS (
      SELECT doc_id, score, CASE WHEN score IS NOT NULL THEN 1 + {' + '.join(f'(round(score, 3) > c{i})::INT' for i in range(1, 5))} END AS stars
      FROM s, cuts)
    SELECT doc_id, round(score, 6) AS score, stars::INT AS stars,
      CASE WHEN stars <= 2 THEN 'negative' WHEN stars = 3 THEN 'neutral' WHEN stars > 3 THEN 'positive' END AS label FROM starred"""
)
def sentiment_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    weights = stored(spark, "weights", st.learn_weights(docs.join(table(spark, sf, "labels"), "doc_id")))
    scores = stored(spark, "scores", st.score_texts(docs, weights, ["doc_id"]))
    starred = st.with_stars(scores, st.learn_cuts(scores))
    return starred.select(
        "doc_id", F.round("score", 6).alias("score"), "stars", asp.star_label("stars").alias("label")
    )


# --- Questions and small expressions --------------------------------------------------------------

SQL_QUESTION = "CASE WHEN turn % 4 = 3 THEN '  ' ELSE text || CASE role WHEN 'user' THEN ' What do they love?' WHEN 'system' THEN ' The best problem' ELSE '' END END"


@query(
    f"""SELECT conv_id, turn,
    CASE WHEN length({sql_strip('q')}) = 0 THEN 'blank' ELSE 'ask' END AS status,
    CASE WHEN regexp_matches(lower(q), '{'|'.join(intent.NEGATIVE_INTENT)}') THEN 'negative'
         WHEN regexp_matches(lower(q), '{'|'.join(intent.POSITIVE_INTENT)}') THEN 'positive' END AS wish
    FROM (SELECT conv_id, turn, {SQL_QUESTION} AS q FROM conversations)"""
)
def question_intent(spark: SparkSession, sf: str) -> DataFrame:
    """Intent of every turn taken as a question; every fourth turn of a conversation is blank."""
    tail = F.when(F.col("role") == "user", " What do they love?").when(
        F.col("role") == "system", " The best problem"
    ).otherwise("")
    q = F.when(F.col("turn") % 4 == 3, "  ").otherwise(F.concat("text", tail))
    asked = table(spark, sf, "conversations").select("conv_id", "turn", q.alias("q"))
    status = F.when(intent.is_blank("q"), "blank").otherwise("ask")
    return asked.select("conv_id", "turn", status.alias("status"), intent.wanted_sentiment("q").alias("wish"))


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey,
    CASE WHEN l_quantity / 10 - 0.5 < 0 THEN 'No rating'
         ELSE repeat('★', least(5, round_even(l_quantity / 10 - 0.5, 0))::INT) END AS stars FROM lineitem"""
)
def star_text(spark: SparkSession, sf: str) -> DataFrame:
    rating = F.col("l_quantity") / 10 - 0.5
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", tx.stars(rating).alias("stars"))


# --- A user's own batch functions -----------------------------------------------------------------


@query(
    """SELECT doc_id, length(text)::DOUBLE AS size, (length(text) - length(replace(text, 'e', '')))::DOUBLE AS es FROM documents"""
)
def embedded_texts(spark: SparkSession, sf: str) -> DataFrame:
    """A toy embedder: length and the number of one letter."""

    def embed(batches):
        for texts in batches:
            yield texts.map(lambda t: [float(len(t)), float(t.count("e"))])

    docs = table(spark, sf, "documents").select("doc_id", em.embedder_udf(embed)("text").alias("v"))
    return docs.select("doc_id", F.col("v")[0].cast("double").alias("size"), F.col("v")[1].cast("double").alias("es"))


@query(
    """SELECT doc_id, length(text) % 5 + 1 AS stars,
      CASE WHEN length(text) % 5 < 2 THEN 'negative' WHEN length(text) % 5 = 2 THEN 'neutral' ELSE 'positive' END AS label
    FROM documents"""
)
def scored_texts(spark: SparkSession, sf: str) -> DataFrame:
    """A toy scorer: stars by the length."""

    def score(batches):
        for texts in batches:
            yield texts.str.len() % 5 + 1

    docs = table(spark, sf, "documents").select("doc_id", st.scorer_udf(score)("text").alias("stars"))
    return docs.select("doc_id", F.col("stars").cast("long").alias("stars"), asp.star_label("stars").alias("label"))


@query(
    r"""SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(left(text, 512), '[A-Z]{2,}'))), ',') AS names
    FROM documents"""
)
def found_names(spark: SparkSession, sf: str) -> DataFrame:
    """A toy name finder: words in capitals in the head of a text."""

    def find(batches):
        for texts in batches:
            yield texts.str.findall("[A-Z]{2,}")

    names = ent.sorted_set(br.finder_udf(find)(tx.cut("text", tx.MODEL_CHARS)))
    return table(spark, sf, "documents").select("doc_id", F.array_join(names, ",").alias("names"))
