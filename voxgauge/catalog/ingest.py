"""Queries on sources and sinks. Inputs in each source's shape are derived from the whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from voxgauge import schema
from voxgauge.catalog.registry import query, spread, table
from voxgauge.catalog.texts import SQL_SPACE, sql_decode, sql_strip
from voxgauge.functions import text as tx
from voxgauge.operators import upsert as up
from voxgauge.session import shared_path
from voxgauge.sources import cases as cs, pages as pg, rejects as rj, reviews as rv, sinks
from voxgauge.streaming.ingest import start_ingest

# --- Ids ------------------------------------------------------------------------------------------


@query(
    """SELECT doc_id, sha1('json:' || 'u' || doc_id || n_chars) AS json_id, sha1('csv:' || source || doc_id) AS csv_id,
    sha1('pdf:' || source || ':None:' || left(text, 50)) AS report_id FROM documents"""
)
def review_ids(spark: SparkSession, sf: str) -> DataFrame:
    d, n = F.col("doc_id").cast("string"), F.col("n_chars").cast("string")
    report = F.concat_ws(":", "source", F.lit("None"), tx.cut("text", tx.ID_TEXT_CHARS))
    return table(spark, sf, "documents").select(
        "doc_id",
        schema.review_id(schema.SOURCE_JSON, F.concat(F.lit("u"), d, n)).alias("json_id"),
        schema.review_id(schema.SOURCE_CSV, F.concat("source", d)).alias("csv_id"),
        schema.review_id(schema.SOURCE_REPORT, report).alias("report_id"),
    )


# --- JSON Lines -----------------------------------------------------------------------------------


def raw_json(spark: SparkSession, sf: str) -> DataFrame:
    """Raw review records: one source lacks text, one the product's parent id, one both ids."""
    src, n = F.col("source"), F.col("n_chars")
    return table(spark, sf, "documents").select(
        F.when(src == "src1", "").otherwise(F.col("text")).alias("text"),
        F.when(~src.isin("src2", "src3"), src).alias("parent_asin"),
        F.when(src != "src3", F.concat(F.lit("a"), src)).alias("asin"),
        F.concat(F.lit("u"), F.col("doc_id").cast("string")).alias("user_id"),
        F.when(src == "src4", F.lit(0)).otherwise(n * 86_400_000 + 1_500_000_000_123).alias("timestamp"),
        (n % 5 + 1).cast("double").alias("rating"),
        F.concat(F.lit("T"), F.col("doc_id").cast("string")).alias("title"),
        (n % 2 == 0).alias("verified_purchase"),
        (n % 7).alias("helpful_vote"),
        "source",
    )


def json_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The records as lines; one source's lines are cut short, one is blank, one is an array."""
    record = F.to_json(F.struct(*[c for c in raw_json(spark, sf).columns if c != "source"]))
    line = (
        F.when(F.col("source") == "src5", F.expr("left(line, length(line) - 1)"))
        .when(F.col("source") == "src6", "  ")
        .when(F.col("source") == "src7", "[1]")
        .otherwise(F.col("line"))
    )
    return raw_json(spark, sf).withColumn("line", record).select(line.alias("value"), "source")


SQL_JSON = """
j AS (
  SELECT doc_id, CASE WHEN source = 'src1' THEN '' ELSE text END AS text, source AS kind,
    CASE source WHEN 'src3' THEN NULL WHEN 'src2' THEN 'asrc2' ELSE source END AS product_id,
    CASE WHEN source = 'src4' THEN 0 ELSE n_chars * 86400000 + 1500000000123 END AS ms,
    n_chars FROM documents WHERE source <> 'src6'),
reason AS (
  SELECT *, CASE WHEN kind = 'src5' THEN 'broken_line' WHEN kind = 'src7' OR text = '' THEN 'no_text'
    WHEN product_id IS NULL THEN 'no_product' END AS reject_reason FROM j)
"""
SQL_JSON_ROWS = f"""
WITH {SQL_JSON}
SELECT sha1('json:u' || doc_id || ms) AS review_id, product_id, 'json' AS source, md5(text) AS text_md5,
  (n_chars % 5 + 1)::DOUBLE AS rating, CASE WHEN ms <> 0 THEN epoch_ms(ms)::DATE END AS review_date,
  'T' || doc_id AS title, n_chars % 2 = 0 AS verified_purchase, n_chars % 7 AS helpful_vote
FROM reason WHERE reject_reason IS NULL
"""


def json_columns(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id",
        "product_id",
        "source",
        F.md5("text_raw").alias("text_md5"),
        "rating",
        "review_date",
        "metadata.title",
        "metadata.verified_purchase",
        "metadata.helpful_vote",
    )


@query(SQL_JSON_ROWS)
def json_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return json_columns(rj.accepted(rv.stage_json(json_lines(spark, sf))))


@query(SQL_JSON_ROWS)
def json_file_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The lines as files, read by the source, written by the review sink, and read back."""
    raw, out = shared_path(spark, "lines"), shared_path(spark, "reviews")
    json_lines(spark, sf).select("value").write.text(raw)
    sinks.write_reviews_json(rj.accepted(rv.read_json(spark, raw)), out)
    return json_columns(spark.read.schema(schema.REVIEW).json(out))


@query(
    f"""WITH {SQL_JSON} SELECT count(*) AS with_null, count(*) FILTER (ms <> 0) AS with_date, count(*) AS n
    FROM reason WHERE reject_reason IS NULL"""
)
def json_sink_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The review sink's lines keep nulls and write ISO dates."""
    out = shared_path(spark, "reviews")
    sinks.write_reviews_json(rj.accepted(rv.stage_json(json_lines(spark, sf))), out)
    return spark.read.text(out).agg(
        F.count_if(F.col("value").contains('"language":null')).alias("with_null"),
        F.count_if(F.col("value").rlike('"review_date":"[0-9]{4}-[0-9]{2}-[0-9]{2}"')).alias("with_date"),
        F.count(F.lit(1)).alias("n"),
    )


# --- CSV ------------------------------------------------------------------------------------------


def csv_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Export cells as text: missing tokens by source, decimal ratings, three ways to write a date."""
    src, n = F.col("source"), F.col("n_chars")
    day = F.date_add(F.lit("2020-01-01").cast("date"), (n % 1000).cast("int"))
    rating = F.concat((n % 5 + 1).cast("string"), F.lit("."), (n % 10).cast("string"))
    return table(spark, sf, "documents").select(
        F.when(src == "src1", "NA").otherwise(F.concat(F.lit("r"), F.col("doc_id").cast("string"))).alias("review_id"),
        F.when(src == "src2", "").otherwise(src).alias("product_id"),
        F.when(src == "src3", "null").otherwise(F.col("text")).alias("review_text"),
        F.when(src == "src4", "bad").when(src == "src5", "").otherwise(rating).alias("star_rating"),
        F.when(src == "src6", F.date_format(day, "M/d/yyyy"))
        .when(src == "src7", F.date_format(day, "MMMM d, yyyy"))
        .when(src == "src8", "yesterday")
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("review_date"),
    )


SQL_CSV = """
c AS (
  SELECT *, CASE source WHEN 'src3' THEN 'no_text' WHEN 'src2' THEN 'no_product' WHEN 'src1' THEN 'no_id'
    WHEN 'src4' THEN 'bad_rating' END AS reject_reason FROM documents)
"""


@query(
    f"""WITH {SQL_CSV}
    SELECT sha1('csv:r' || doc_id) AS review_id, source AS product_id, md5(text) AS text_md5,
      CASE WHEN source <> 'src5' THEN (n_chars % 5 + 1)::DOUBLE END AS rating,
      CASE WHEN source <> 'src8' THEN DATE '2020-01-01' + (n_chars % 1000)::INT END AS review_date
    FROM c WHERE reject_reason IS NULL"""
)
def csv_reviews(spark: SparkSession, sf: str) -> DataFrame:
    reviews = rj.accepted(rv.stage_csv(csv_cells(spark, sf)))
    return reviews.select("review_id", "product_id", F.md5("text_raw").alias("text_md5"), "rating", "review_date")


@query(
    f"""WITH {SQL_JSON}
    SELECT sha1('csv:u' || doc_id || ms) AS review_id, product_id, md5(text) AS text_md5,
      (n_chars % 5 + 1)::DOUBLE AS rating, epoch_ms(ms)::DATE AS review_date
    FROM (SELECT doc_id, n_chars, CASE source WHEN 'src3' THEN NULL WHEN 'src2' THEN 'asrc2' ELSE source END AS product_id,
            CASE WHEN source = 'src1' THEN '' ELSE text END AS text,
            CASE WHEN source = 'src4' THEN 0 ELSE n_chars * 86400000 + 1500000000123 END AS ms FROM documents)
    WHERE text <> '' AND product_id IS NOT NULL"""
)
def csv_file_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Raw records through the export sink and the CSV source, line breaks and quotes included."""
    out = shared_path(spark, "export")
    sinks.export_csv(raw_json(spark, sf), out)
    reviews = rj.accepted(rv.read_csv(spark, out))
    return reviews.select("review_id", "product_id", F.md5("text_raw").alias("text_md5"), "rating", "review_date")


# --- Report tables --------------------------------------------------------------------------------


def report_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a report: a header per source, one source with short rows, one with odd dates."""
    docs = table(spark, sf, "documents")
    src, n = F.col("source"), F.col("n_chars")
    day = F.date_add(F.lit("2020-01-01").cast("date"), (n % 1000).cast("int"))
    date = (
        F.when(src == "src6", F.date_format(day, "yyyy-M-d")).when(src == "src7", "2024-02-31")
        .when(src == "src8", F.lit(None)).otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    stars = F.concat(F.lit(" "), (n % 5 + 1).cast("string"), F.lit(" stars"))
    body = docs.select(
        F.when(src == "src5", F.array(src, stars)).otherwise(
            F.array(F.concat(F.lit(" "), src), F.when(src == "src9", "x5").otherwise(stars), "text", date)
        ).alias("cells")
    )
    header = docs.select("source").distinct().select(
        F.array(F.lit("Product ID"), F.lit("Rating"), F.lit("Review"), F.lit("Date")).alias("cells")
    )
    return body.unionByName(header)


SQL_DAY = "DATE '2020-01-01' + (n_chars % 1000)::INT"


@query(
    f"""WITH r AS (
      SELECT source, text, n_chars,
        CASE source WHEN 'src6' THEN strftime({SQL_DAY}, '%Y-%-m-%-d') WHEN 'src7' THEN '2024-02-31'
          WHEN 'src8' THEN 'None' ELSE strftime({SQL_DAY}, '%Y-%m-%d') END AS d FROM documents WHERE source <> 'src5')
    SELECT sha1('pdf: ' || source || ':' || d || ':' || left(text, 50)) AS review_id, source AS product_id,
      md5({sql_strip('text')}) AS text_md5,
      CASE WHEN source <> 'src9' THEN (n_chars % 5 + 1)::DOUBLE END AS rating,
      CASE WHEN source NOT IN ('src7', 'src8') THEN {SQL_DAY} END AS review_date
    FROM r"""
)
def report_reviews(spark: SparkSession, sf: str) -> DataFrame:
    reviews = rj.accepted(rv.stage_report(report_cells(spark, sf)))
    return reviews.select("review_id", "product_id", F.md5("text_raw").alias("text_md5"), "rating", "review_date")


@query(
    """SELECT doc_id, replace(replace(replace(left(trim('A & B < ' || lang || '. ' || text, '. '), 200),
      '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS cell,
    strftime(to_timestamp(1300000000 + n_chars * 3600), '%Y-%m-%d') AS day FROM documents"""
)
def report_export(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of a printed report: merged, cut to the report's width, escaped, with an ISO date."""
    summary = F.concat(F.lit("A & B < "), "lang")
    day = tx.epoch_s_date(F.lit(1_300_000_000) + F.col("n_chars") * 3600)
    return table(spark, sf, "documents").select(
        "doc_id", tx.report_text(summary, "text").alias("cell"), F.date_format(day, "yyyy-MM-dd").alias("day")
    )


# --- Image texts ----------------------------------------------------------------------------------


def image_rows(spark: SparkSession, sf: str) -> DataFrame:
    item = F.col("item_id").cast("string")
    kind = F.when(F.col("item_id") % 3 == 0, ".png").when(F.col("item_id") % 3 == 1, ".jpg").otherwise(".gif")
    text = F.when(F.col("item_id") % 5 == 0, " \n").otherwise(F.concat(F.lit("\n"), "text"))
    return table(spark, sf, "benchmark").select(
        F.concat(F.lit("img/scan.v1_"), item, kind).alias("path"), text.alias("text")
    )


@query(
    f"""WITH i AS (
      SELECT 'scan.v1_' || item_id AS stem, CASE item_id % 3 WHEN 0 THEN '.png' ELSE '.jpg' END AS ext, text
      FROM benchmark WHERE item_id % 3 < 2 AND item_id % 5 <> 0 AND {sql_strip('text')} <> '')
    SELECT sha1('ocr:' || stem || ext) AS review_id, stem AS product_id, {sql_strip('text')} AS text_raw FROM i"""
)
def image_texts(spark: SparkSession, sf: str) -> DataFrame:
    reviews = rj.accepted(rv.stage_image_texts(image_rows(spark, sf)))
    return reviews.select("review_id", "product_id", "text_raw")


@query(
    """SELECT path, row_number() OVER (ORDER BY regexp_extract(path, '[^.]+$'), path) AS place FROM (
      SELECT 'img/scan.v1_' || item_id || CASE item_id % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' ELSE '.gif' END AS path
      FROM benchmark)"""
)
def image_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Every file of the listing with its place, by suffix and name."""
    listed = rv.numbered(image_rows(spark, sf).select("path"), *rv.listing_order())
    return listed.select("path", "place")


# --- Pages ----------------------------------------------------------------------------------------


def review_page_html() -> Column:
    """A product's reviews page with one review inside the list, one empty, and one outside of it."""
    n = F.col("n_chars")
    day = F.when(F.col("source") == "src1", "31-02-2024").otherwise(
        F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (n % 1000).cast("int")), "dd-MM-yyyy")
    )
    return F.concat(
        F.lit('<html><body><article><h3>Outside</h3></article><div class="list cola"><div><article class="item">'),
        F.lit('<div class="big stars">'), (n % 5 + 1).cast("string"), F.lit(' out of 5<b></b></div>'),
        F.lit('<h3> Opinion '), F.col("doc_id").cast("string"), F.lit(" </h3>"),
        F.lit('<p>'), tx.xml_escape("text"), F.lit("</p>"),
        F.lit('<div><div class="-pvm"><span>'), day,
        F.lit("</span><span>par Ann par "), F.col("lang"), F.lit("</span></div><div>"),
        F.when(F.col("source") == "src2", F.when(n % 2 == 0, "Achat vérifié").otherwise("Achat v&eacute;rifi&eacute;")).otherwise(""),
        F.lit("</div></div></article></div><article><h3></h3><p> . </p></article></div>"),
        F.lit("<article><p>Also outside</p></article></body></html>"),
    )


@query(
    f"""WITH p AS (
      SELECT doc_id, source AS product_id, n_chars, lang, 'Opinion ' || doc_id AS title, {sql_strip('text')} AS body,
        CASE WHEN source = 'src1' THEN '31-02-2024' ELSE strftime({SQL_DAY}, '%d-%m-%Y') END AS d FROM documents)
    SELECT sha1('{schema.SOURCE_PAGE}:' || product_id || ':' || d || ':' || 'Ann ' || lang || ':' || title) AS review_id,
      product_id, md5({sql_strip("trim(title || '. ' || body, '. ')")}) AS text_md5, (n_chars % 5 + 1)::DOUBLE AS rating,
      CASE WHEN product_id <> 'src1' THEN {SQL_DAY} END AS review_date,
      'Ann ' || lang AS author, product_id = 'src2' AS verified FROM p"""
)
def page_reviews(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "documents").select(F.col("source").alias("product_id"), review_page_html().alias("html"))
    reviews = rj.accepted(pg.stage_pages(pages))
    return reviews.select(
        "review_id",
        "product_id",
        F.md5("text_raw").alias("text_md5"),
        "rating",
        "review_date",
        "metadata.author",
        F.col("metadata.verified_purchase").alias("verified"),
    )


@query(
    rf"""WITH b AS (
      SELECT page_id, unnest(regexp_extract_all(html, '(?is)<article\b[^>]*>.*?</article\s*>')) AS block,
        generate_subscripts(regexp_extract_all(html, '(?is)<article\b[^>]*>.*?</article\s*>'), 1) - 1 AS pos FROM pages)
    SELECT page_id, pos, length(block) AS n_chars,
      regexp_replace({sql_decode("regexp_extract(block, '(?is)<h1>(.*?)</h1>', 1)")}, '^{SQL_SPACE}+|{SQL_SPACE}+$', '', 'g') AS title,
      len(regexp_extract_all(block, '(?is)<p\b[^>]*>.*?</p\s*>')) AS n_paragraphs
    FROM b"""
)
def page_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Article blocks of the stored pages as they are, with title and paragraph count."""
    found = pg.page_blocks(table(spark, sf, "pages").select("page_id", "html"), container=None)
    return found.select(
        "page_id",
        F.col("pos").cast("long").alias("pos"),
        F.length("block").cast("long").alias("n_chars"),
        tx.strip(tx.decode_entities(F.get(pg.text_nodes(F.col("block"), "h1"), 0))).alias("title"),
        F.size(F.regexp_extract_all("block", F.lit(r"(?is)<p\b[^>]*>.*?</p\s*>"), 0)).cast("long").alias("n_paragraphs"),
    )


def pages_with_pager(spark: SparkSession, sf: str) -> DataFrame:
    """The stored pages with a pager and two product links put before the end."""
    shelf = (F.col("page_id") % 20).cast("string")
    tail = F.concat(
        F.lit('<div class="pg-w -mh"><a class="pg" href="/shelf?sort=new&amp;page='), shelf, F.lit('#x">next</a><a href="/shelf?page='),
        shelf, F.lit('&amp;q=1">more</a><a href="/all">all</a></div>'),
        F.lit('<a href=/phone-'), shelf, F.lit('.html>phone</a><a href="/about.html">about</a>'),
    )
    host = F.concat(F.lit("https://shop"), (F.col("page_id") % 2).cast("string"), F.lit(".example/list/all?x=1"))
    return table(spark, sf, "pages").select("page_id", host.alias("url"), F.concat("html", tail).alias("html"))


@query(
    r"""WITH s AS (SELECT DISTINCT page_id % 20 AS k, 'https://shop' || (page_id % 2) || '.example' AS host FROM pages),
    h AS (
      SELECT 'https://shop' || (page_id % 2) || '.example' AS host, replace(unnest(
        regexp_extract_all(html, '(?i)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1)), '&amp;', '&') AS link FROM pages)
    SELECT 'pagination' AS kind, host || '/shelf?page=' || k || '&q=1' AS link FROM s
    UNION SELECT 'product', host || '/phone-' || k || '.html' FROM s
    UNION SELECT 'product', CASE WHEN link LIKE 'http%' THEN link WHEN link LIKE '/%' THEN host || link ELSE host || '/list/' || link END
    FROM h WHERE regexp_matches(link, '-\d+\.html')"""
)
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    return pg.discovered_links(pages_with_pager(spark, sf), url="url")


@query(
    r"""SELECT replace(link, '&amp;', '&') AS link, count(*) AS n FROM (
      SELECT unnest(regexp_extract_all(html, '(?i)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1)) AS link FROM pages)
    GROUP BY 1"""
)
def page_hrefs(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "pages").select(F.explode(pg.links("html")).alias("link"))
    return found.groupBy("link").agg(F.count(F.lit(1)).alias("n"))


HOST = "https://shop.example"


def product_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A product page per part; every fifth has no reviews link, and URLs without a number stand for themselves."""
    k = F.col("p_partkey").cast("string")
    url = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit(f"{HOST}/item/"), k)).otherwise(
        F.concat(F.lit(f"{HOST}/item-"), k, F.lit(".html"))
    )
    host = F.when(F.col("p_partkey") % 3 == 0, HOST).otherwise("")
    link = F.when(F.col("p_partkey") % 5 == 0, "").otherwise(
        F.concat(F.lit('<a href="'), host, F.lit("/productratingsreviews/"), k, F.lit('">ratings</a>'))
    )
    return table(spark, sf, "part").select(url.alias("product_url"), F.concat(F.lit("<body>"), link).alias("html"))


def stored_pages(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey").cast("string")
    review = F.concat(
        F.lit('<div class="cola"><article><h3>Part '), k, F.lit("</h3><p>Fits.</p></article></div>")
    )
    return table(spark, sf, "part").select(
        F.concat(F.lit(f"{HOST}/productratingsreviews/"), k).alias("url"), review.alias("html")
    )


@query(
    f"""SELECT CASE WHEN p_partkey % 4 = 0 THEN '{HOST}/item/' || p_partkey ELSE p_partkey || '' END AS product_id,
    CASE WHEN p_partkey % 5 <> 0 THEN '{HOST}/productratingsreviews/' || p_partkey END AS reviews_url,
    p_partkey % 5 <> 0 AS stored FROM part"""
)
def review_page_join(spark: SparkSession, sf: str) -> DataFrame:
    joined = pg.review_pages(product_pages(spark, sf), stored_pages(spark, sf), HOST)
    return joined.select("product_id", "reviews_url", F.col("html").isNotNull().alias("stored"))


@query(
    """SELECT count(*) FILTER (p_partkey % 5 <> 0) AS n_reviews, count(*) FILTER (p_partkey % 5 <> 0) AS n_products,
    count(*) FILTER (p_partkey % 5 = 0) AS n_skipped FROM part"""
)
def extraction_totals(spark: SparkSession, sf: str) -> DataFrame:
    pages = pg.review_pages(product_pages(spark, sf), stored_pages(spark, sf), HOST)
    reviews = rj.accepted(pg.stage_pages(pages.where(F.col("html").isNotNull())))
    return pg.extraction_totals(pages, reviews)


# --- Union and rejects ----------------------------------------------------------------------------


def all_sources(spark: SparkSession, sf: str) -> list[DataFrame]:
    pages = table(spark, sf, "documents").select(F.col("source").alias("product_id"), review_page_html().alias("html"))
    return [
        rv.stage_json(json_lines(spark, sf)),
        rv.stage_csv(csv_cells(spark, sf)),
        rv.stage_report(report_cells(spark, sf)),
        rv.stage_image_texts(image_rows(spark, sf)),
        pg.stage_pages(pages),
    ]


@query(
    f"""WITH {SQL_JSON}, {SQL_CSV}
    SELECT 'json' AS source, count(*) AS n_rows FROM reason WHERE reject_reason IS NULL
    UNION ALL SELECT 'csv', count(*) FROM c WHERE reject_reason IS NULL
    UNION ALL SELECT 'pdf', count(*) FROM documents WHERE source <> 'src5'
    UNION ALL SELECT 'ocr', count(*) FROM benchmark WHERE item_id % 3 < 2 AND item_id % 5 <> 0
    UNION ALL SELECT '{schema.SOURCE_PAGE}', count(*) FROM documents"""
)
def source_union(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews per source once all five are under one schema."""
    return rj.source_counts(rj.union_sources(*[rj.accepted(s) for s in all_sources(spark, sf)]))


@query(
    f"""WITH {SQL_JSON}, {SQL_CSV}
    SELECT 'json' AS source, reject_reason, count(*) AS n_rows FROM reason WHERE reject_reason IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'csv', reject_reason, count(*) FROM c WHERE reject_reason IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'pdf', 'no_text', count(*) FROM documents WHERE source = 'src5' HAVING count(*) > 0
    UNION ALL SELECT 'ocr', 'no_text', count(*) FROM benchmark WHERE item_id % 3 < 2 AND item_id % 5 = 0 HAVING count(*) > 0
    UNION ALL SELECT '{schema.SOURCE_PAGE}', 'no_text', count(*) FROM documents"""
)
def reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rj.reject_counts(*all_sources(spark, sf))


# --- Ratings and dates ----------------------------------------------------------------------------


@query(
    """WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS d, o_custkey AS k,
      CASE o_orderkey % 4 WHEN 0 THEN '31-02-' || year(o_orderdate) ELSE strftime(o_orderdate, '%d-%m-%Y') END AS dmy FROM orders)
    SELECT o_orderkey, CASE WHEN k % 3 = 0 THEN NULL ELSE (k % 10)::DOUBLE END AS leading,
      CASE WHEN k % 7 = 0 THEN NULL ELSE trunc((k % 50) / 10.0)::DOUBLE END AS whole,
      try_strptime(dmy, '%d-%m-%Y')::DATE AS found_date, d AS iso_date, d AS free_date, d AS ms_date,
      strftime(d, '%Y-%m-%d') AS iso_text FROM o"""
)
def rating_date_parse(spark: SparkSession, sf: str) -> DataFrame:
    d, k, o = F.col("o_orderdate").cast("date"), F.col("o_custkey"), F.col("o_orderkey")
    leading = F.when(k % 3 == 0, "x5").otherwise(F.concat(F.lit(" "), (k % 10).cast("string"), F.lit(" out of 5")))
    decimal = F.concat(F.floor(k % 50 / 10).cast("string"), F.lit("."), (k % 10).cast("string"))
    dmy = F.when(o % 4 == 0, F.concat(F.lit("31-02-"), F.year(d).cast("string"))).otherwise(F.date_format(d, "dd-MM-yyyy"))
    free = F.when(o % 4 == 0, F.date_format(d, "yyyy/MM/dd")).when(o % 4 == 1, F.date_format(d, "M/d/yyyy")).when(
        o % 4 == 2, F.date_format(d, "d MMM yyyy")
    ).otherwise(F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T10:11:12Z")))
    return spread(table(spark, sf, "orders")).select(
        "o_orderkey",
        tx.leading_digit(leading).alias("leading"),
        tx.truncated_number(F.when(k % 7 == 0, "4 stars").otherwise(decimal)).alias("whole"),
        tx.day_month_year(F.concat(F.lit("le "), dmy, F.lit(" à Rabat"))).alias("found_date"),
        tx.year_month_day(F.concat(F.lit(" "), F.date_format(d, "yyyy-M-d"), F.lit(" "))).alias("iso_date"),
        tx.free_date(free).alias("free_date"),
        tx.epoch_ms_date(F.unix_date(d).cast("long") * 86_400_000 + 86_399_999).alias("ms_date"),
        F.date_format(d, "yyyy-MM-dd").alias("iso_text"),
    )


# --- Small files ----------------------------------------------------------------------------------


@query(
    f"""SELECT 'review_' || item_id || '.jpg' AS filename, left({sql_strip('text')}, 250) AS truth
    FROM benchmark WHERE {sql_strip('text')} <> ''"""
)
def truth_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    out = shared_path(spark, "truth")
    name = F.concat(F.lit("review_"), F.col("item_id").cast("string"), F.lit(".jpg"))
    sinks.write_truth(table(spark, sf, "benchmark").withColumn("filename", name), out)
    return cs.read_truth(spark, out, whole_file=False)


@query(
    """SELECT 'Is ' || vec_id || ' good?' AS question, 'c' || label AS category,
    CASE WHEN label <> 7 THEN 'p' || label END AS relevant, label <> 0 AS expects_answer FROM embeddings"""
)
def cases_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    out, label = shared_path(spark, "cases"), F.col("label").cast("string")
    table(spark, sf, "embeddings").select(
        F.concat(F.lit("Is "), F.col("vec_id").cast("string"), F.lit(" good?")).alias("question"),
        F.concat(F.lit("c"), label).alias("category"),
        F.when(F.col("label") != 7, F.array(F.concat(F.lit("p"), label))).alias("relevant_reviews"),
        (F.col("label") != 0).alias("expects_answer"),
    ).write.option("ignoreNullFields", False).json(out)
    cases = cs.read_cases(spark, out, multi_line=False)
    return cases.select(
        "question", "category", F.array_join("relevant_reviews", ",").alias("relevant"), "expects_answer"
    )


@query(f"SELECT '{HOST}/item-' || p_partkey || '.html' AS product_url, p_partkey || '' AS product_id FROM part")
def product_urls(spark: SparkSession, sf: str) -> DataFrame:
    out = shared_path(spark, "urls")
    url = F.concat(F.lit(f"{HOST}/item-"), F.col("p_partkey").cast("string"), F.lit(".html"))
    table(spark, sf, "part").select(url.alias("product_url")).write.json(out)
    urls = cs.read_product_urls(spark, out)
    return urls.select("product_url", tx.url_product_id("product_url").alias("product_id"))


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 30")
def head_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The sampling operator: the first rows in key order."""
    return cs.head_sample(table(spark, sf, "documents"), 30, "doc_id").select("doc_id", "lang")


# --- Upsert and incremental load ------------------------------------------------------------------


def loaded(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """An index of all documents, and a batch that replaces the labelled ones and adds all turns."""
    docs = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("review_id"), "text", "doc_id"
    )
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    changed = docs.join(labels, "doc_id").select(
        "review_id", F.concat("text", F.lit(" q"), F.col("quality").cast("string")).alias("text")
    )
    turns = table(spark, sf, "conversations").select(
        F.concat_ws("-", F.lit("t"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("review_id"), "text"
    )
    return docs.drop("doc_id"), changed.unionByName(turns)


SQL_UPSERTED = """
SELECT 'd' || doc_id AS review_id, md5(text || coalesce(' q' || quality, '')) AS text_md5
FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 't-' || conv_id || '-' || turn, md5(text) FROM conversations
"""


@query(SQL_UPSERTED)
def upsert(spark: SparkSession, sf: str) -> DataFrame:
    return up.upsert(*loaded(spark, sf)).select("review_id", F.md5("text").alias("text_md5"))


@query(SQL_UPSERTED)
def upsert_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The same through stored batches, the second written twice as after a failure."""
    root = shared_path(spark, "index")
    index, batch = loaded(spark, sf)
    up.write_batch(index, root, 0)
    up.write_batch(batch, root, 1)
    up.write_batch(batch, root, 1)
    return up.read_index(spark, root).select("review_id", F.md5("text").alias("text_md5"))


@query(
    f"""WITH {SQL_JSON}
    SELECT sha1('json:u' || doc_id || ms) AS review_id, product_id, md5(text) AS raw_md5,
      contains(lower(text), 'cher') OR contains(lower(text), 'worth') AS speaks_of_price
    FROM reason WHERE reject_reason IS NULL"""
)
def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Record files loaded by a stream into index batches, then read as one index."""
    from voxgauge.functions.aspects import with_aspect_texts
    from voxgauge.plans.enrich import preprocess

    def enrich(reviews: DataFrame) -> DataFrame:
        spoken = with_aspect_texts(preprocess(reviews), tx.analysed_text())
        known = F.create_map(F.lit("price"), F.when(F.col("aspect_texts.price").isNotNull(), "neutral"))
        return spoken.withColumn("aspects", known).drop("aspect_texts")

    source, root, state = (shared_path(spark, n) for n in ("incoming", "index", "state"))
    lines = json_lines(spark, sf)
    lines.select("value").write.text(source)
    start_ingest(spark, source, root, state, enrich).awaitTermination()
    # The same records arrive again: the rerun loads them as a second batch and changes no row.
    lines.select("value").write.mode("append").text(source)
    start_ingest(spark, source, root, state, enrich).awaitTermination()
    return up.read_index(spark, root).select(
        "review_id",
        "product_id",
        F.md5("text_raw").alias("raw_md5"),
        (F.coalesce("aspect_price", F.lit("none")) == "neutral").alias("speaks_of_price"),
    )


def as_index(spark: SparkSession, sf: str) -> DataFrame:
    """A bulk of index rows made from the records, without what only later loads know."""
    from voxgauge.plans.enrich import index_rows, preprocess

    return index_rows(preprocess(rj.accepted(rv.stage_json(json_lines(spark, sf)))))


@query(
    f"""WITH {SQL_JSON}, bulk AS (SELECT sha1('json:u' || doc_id || ms) AS review_id, product_id FROM reason WHERE reject_reason IS NULL)
    SELECT * FROM bulk UNION ALL
    SELECT sha1('json:w' || item_id || '1'), 'late' FROM benchmark WHERE item_id % 2 = 0 AND {sql_strip('text')} <> '' UNION ALL
    SELECT sha1('json:w' || item_id || '2'), 'later' FROM benchmark WHERE item_id % 2 = 1 AND {sql_strip('text')} <> ''"""
)
def stream_into_index(spark: SparkSession, sf: str) -> DataFrame:
    """A bulk load, two streams with checkpoints of their own, and one of them again after its checkpoint was lost."""
    from voxgauge.plans.enrich import INDEX, preprocess

    root = shared_path(spark, "index")
    up.write_batch(as_index(spark, sf), root, 0)
    items = table(spark, sf, "benchmark")
    for k, product in ((0, "late"), (1, "later")):
        source = shared_path(spark, "incoming")
        record = F.struct(
            F.lit(product).alias("asin"), "text", F.concat(F.lit("w"), F.col("item_id").cast("string")).alias("user_id"),
            F.lit(k + 1).alias("timestamp"), F.lit(4.0).alias("rating"),
        )
        items.where(F.col("item_id") % 2 == k).select(F.to_json(record).alias("value")).write.text(source)
        for _ in range(k + 1):  # the second is replayed with nothing in its checkpoint
            start_ingest(spark, source, root, shared_path(spark, "state"), preprocess).awaitTermination()
    return up.read_index(spark, root, schema=INDEX).select("review_id", "product_id")


@query(
    """SELECT 'd' || doc_id AS review_id, CASE WHEN quality IS NOT NULL THEN lang END AS language,
      coalesce(quality = 1, false) AS has_vector
    FROM documents LEFT JOIN labels USING (doc_id) WHERE text <> ''"""
)
def index_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """A first load without language and vector, a later one with both: no column is lost."""
    from voxgauge.plans.enrich import INDEX, index_rows

    docs = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("review_id"),
        "doc_id",
        F.lit("p").alias("product_id"),
        F.lit("json").alias("source"),
        F.lit(None).cast("double").alias("rating"),
        F.col("text").alias("text_raw"),
        F.col("text").alias("text_clean"),
        "lang",
    )
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    vector = F.when(F.col("quality") == 1, F.array(F.lit(1.0), F.lit(2.0)))
    later = docs.join(labels, "doc_id").withColumns({"language": F.col("lang"), "embedding": vector})
    root = shared_path(spark, "index")
    up.write_batch(index_rows(docs), root, 0)
    up.write_batch(index_rows(later), root, 0, "enriched")
    read = up.read_index(spark, root, schema=INDEX)
    return read.select("review_id", "language", F.col("embedding").isNotNull().alias("has_vector"))
