"""Stored web pages: links, and review blocks inside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from voxgauge import schema
from voxgauge.functions import text as tx
from voxgauge.sources.rejects import first_reason

# Shapes of the links a crawl follows or keeps, and the marker of a verified purchase.
PAGINATION = r"\?page=\d+"
PRODUCT = r"-\d+\.html"
REVIEWS_MARK = "productratingsreviews"
VERIFIED_MARK = "Achat vérifié"

BLOCK = r"(?is)<article\b[^>]*>.*?</article\s*>"
CONTAINER_TOKENS = r"(?is)<article\b[^>]*>.*?</article\s*>|<div\b[^>]*>|</div\s*>"


def _all(c: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), group)


def has_class(name: str) -> str:
    """Pattern of an attribute list whose class list holds ``name``."""
    return rf"""[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?{name}(?:\s[^"']*)?["'][^>]*"""


def text_nodes(html: Column, tag: str, attrs: str = "[^>]*") -> Column:
    """Texts that lie directly inside the elements of one tag, in order, undecoded.

    Elements nested one level deep are taken out with their text; an element of the same tag ends the
    outer one, as the tags used here (paragraph, heading, span) do not nest.
    """
    inner = _all(html, rf"(?is)<{tag}\b(?:{attrs})>(.*?)</{tag}\s*>", 1)
    nested = r"(?is)<([a-z][a-z0-9]*)\b[^>]*>[^<]*</\1\s*>|<[^>]+>"
    pieces = F.transform(inner, lambda x: F.split(F.regexp_replace(x, nested, "\u0001"), "\u0001"))
    return F.filter(F.flatten(pieces), lambda x: x != "")


def blocks(html: Column | str, container: str | None = "cola") -> Column:
    """Article blocks of a page, in order; with ``container``, only those inside a div of that class.

    One pass over the page's div and article tags keeps the depth below the outermost such div.
    """
    html = tx.col(html)
    if container is None:
        return _all(html, BLOCK, 0)
    opens = rf"(?is)^<div\b{has_class(container)}>$"
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, token: Column) -> Column:
        depth, found = state["depth"], state["found"]
        is_open, is_close = token.rlike("(?i)^<div"), token.rlike("(?i)^</div")
        next_depth = (
            F.when(is_open & ((depth > 0) | token.rlike(opens)), depth + 1)
            .when(is_close & (depth > 0), depth - 1)
            .otherwise(depth)
        )
        keep = ~is_open & ~is_close & (depth > 0)
        return F.struct(
            next_depth.alias("depth"),
            F.when(keep, F.array_append(found, token)).otherwise(found).alias("found"),
        )

    return F.aggregate(_all(html, CONTAINER_TOKENS, 0), start, step, lambda s: s["found"])


def page_blocks(pages: DataFrame, html: str = "html", container: str | None = "cola") -> DataFrame:
    """One row per review block: the page's other columns, ``pos`` from 0, and ``block``."""
    keep = [c for c in pages.columns if c != html]
    return pages.select(*keep, F.posexplode(blocks(html, container)).alias("pos", "block"))


def stage_pages(pages: DataFrame, product_id: str = "product_id", html: str = "html") -> DataFrame:
    """Reviews of stored review pages."""

    def first(nodes: Column) -> Column:
        return F.coalesce(F.get(nodes, 0), F.lit(""))

    b = F.col("block")
    # A marker may be written with entities; most blocks show it as it is, or hold no ampersand.
    plain = F.regexp_replace(b, "<[^>]*>", "")
    hidden = F.when(~b.contains(VERIFIED_MARK) & b.contains("&"), plain).otherwise("")
    spans = F.flatten(
        F.transform(_all(b, rf"(?is)<div\b{has_class('-pvm')}>(.*?)</div\s*>", 1), lambda d: text_nodes(d, "span"))
    )
    parts = [first(text_nodes(b, "h3")), first(text_nodes(b, "p")), F.coalesce(F.get(spans, 0), F.lit("")),
             F.coalesce(F.get(spans, 1), F.lit("")), hidden]
    found = page_blocks(pages, html).select(
        F.col(product_id).alias("product_id"),
        b.contains(VERIFIED_MARK).alias("marked"),
        F.regexp_extract(b, rf"(?is)<div\b{has_class('stars')}>([^<]*)", 1).alias("stars"),
        tx.decode_entities(F.concat_ws("\u0001", *parts)).alias("parts"),  # one decoding for all of them
    )
    parts = F.split("parts", "\u0001")
    decoded = F.struct(
        "product_id",
        (F.col("marked") | parts[4].contains(VERIFIED_MARK)).alias("verified"),
        "stars",
        tx.strip(parts[0]).alias("title"),
        tx.strip(parts[1]).alias("body"),
        parts[2].alias("day"),
        tx.author_name(parts[3]).alias("author"),
    )
    # Out through a generator: a filter on the reject reason would otherwise repeat the decoding below it.
    found = found.select(F.inline(F.array(decoded))).withColumn("text", tx.merge_title("title", "body"))
    original = F.concat_ws(":", F.coalesce("product_id", F.lit("None")), "day", "author", "title")
    return schema.conform(
        found.select(
            schema.review_id(schema.SOURCE_PAGE, original).alias("review_id"),
            "product_id",
            F.lit(schema.SOURCE_PAGE).alias("source"),
            F.col("text").alias("text_raw"),
            tx.leading_digit("stars").alias("rating"),
            tx.day_month_year("day").alias("review_date"),
            schema.metadata(author=F.col("author"), verified_purchase=F.col("verified")).alias("metadata"),
            first_reason(("no_text", F.col("text") == "")).alias("reject_reason"),
        ),
        "reject_reason",
    )


# --- Links ----------------------------------------------------------------------------------------


def links(html: Column | str) -> Column:
    """Targets of the page's links as written, entities decoded, with quotes or without."""
    quoted = r"""["']([^"']*)["']"""
    found = _all(tx.col(html), rf"""(?i)<a\b[^>]*?\bhref\s*=\s*(?:{quoted}|([^\s"'>]+))""", 0)
    bare = r"""(?is)^<a\b.*?\bhref\s*=\s*["']?|["']$"""
    return F.transform(found, lambda u: decode_link(F.regexp_replace(u, bare, "")))


def decode_link(u: Column) -> Column:
    """The entities that links hold."""
    for entity, char in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        u = F.replace(u, F.lit(entity), F.lit(char))
    return u


def resolved(link: Column, base: Column) -> Column:
    """A link as seen from the page ``base``, without its fragment."""
    link, base = F.regexp_replace(link, "#.*$", ""), F.regexp_replace(base, "#.*$", "")
    host = F.regexp_extract(base, r"^([a-z][a-z0-9+.-]*://[^/?]*)", 1)
    page = F.regexp_replace(base, r"\?.*$", "")
    folder = F.when(page == host, F.concat(host, F.lit("/"))).otherwise(F.regexp_replace(page, r"[^/]*$", ""))
    return (
        F.when(link.rlike(r"^(?i)[a-z][a-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, "^([a-z]+:)", 1), link))
        .when(link.startswith("/"), F.concat(host, link))
        .when(link.startswith("?") | (link == ""), F.concat(page, link))
        .otherwise(F.concat(folder, link))
    )


def pager_links(html: Column | str, container: str = "pg-w") -> Column:
    """Pagination links inside the pager element."""
    pager = _all(tx.col(html), rf"(?is)<(div|nav|ul)\b{has_class(container)}>.*?</\1\s*>", 0)
    return F.filter(F.flatten(F.transform(pager, links)), lambda u: u.rlike(PAGINATION))


def product_links(html: Column | str) -> Column:
    return F.filter(links(html), lambda u: u.rlike(PRODUCT))


def reviews_link(html: Column | str) -> Column:
    """First link to a page of ratings and reviews, null when the page has none."""
    return F.get(F.filter(links(html), lambda u: u.contains(REVIEWS_MARK)), 0)


def discovered_links(pages: DataFrame, html: str = "html", url: str | None = None) -> DataFrame:
    """Distinct links to follow (``pagination``) or keep (``product``), absolute if ``url`` names the pages' own column."""
    tagged = F.concat(
        F.transform(pager_links(html), lambda u: F.struct(F.lit("pagination").alias("kind"), u.alias("link"))),
        F.transform(product_links(html), lambda u: F.struct(F.lit("product").alias("kind"), u.alias("link"))),
    )
    if url is None:
        return pages.select(F.explode(tagged).alias("x")).select("x.*").distinct()
    found = pages.select(F.col(url).alias("base"), F.explode(tagged).alias("x"))
    return found.select("x.kind", resolved(F.col("x.link"), F.col("base")).alias("link")).distinct()


def review_pages(products: DataFrame, pages: DataFrame, host: str) -> DataFrame:
    """Products with the URL of their reviews page and, where stored, its HTML.

    ``products`` has ``product_url, html`` (the product page), ``pages`` has ``url, html``. Products
    without a reviews link keep a null ``reviews_url``.
    """
    wanted = products.select(
        tx.url_product_id("product_url").alias("product_id"),
        "product_url",
        tx.absolute_url(reviews_link("html"), host).alias("reviews_url"),
    )
    stored = pages.select(F.col("url").alias("reviews_url"), "html")
    # Products without a link stay out of the join: their shared null key would fill one task.
    linked = wanted.where(F.col("reviews_url").isNotNull()).join(stored, "reviews_url", "left")
    unlinked = wanted.where(F.col("reviews_url").isNull()).withColumn("html", F.lit(None).cast("string"))
    return linked.unionByName(unlinked)


def extraction_totals(review_pages: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews found, products with a reviews page, products skipped for lack of a link."""
    products = review_pages.agg(
        F.count_if(F.col("reviews_url").isNotNull()).alias("n_products"),
        F.count_if(F.col("reviews_url").isNull()).alias("n_skipped"),
    )
    found = reviews.agg(F.count(F.lit(1)).alias("n_reviews"))
    return products.select(found.scalar().alias("n_reviews"), "n_products", "n_skipped")
