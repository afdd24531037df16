import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from voxgauge import schema
from voxgauge.operators import upsert as up
from voxgauge.plans.enrich import INDEX, index_rows
from voxgauge.sources import cases as cs, pages as pg, rejects as rj, reviews as rv, sinks
from voxgauge.streaming.ingest import start_ingest


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def reasons(staged):
    return {(r.source, r.reject_reason): r.n_rows for r in rj.reject_counts(staged).collect()}


def test_json_lines(spark, tmp_path):
    lines = [
        json.dumps({"text": "Très bon", "parent_asin": "P1", "asin": "A1", "user_id": "u", "timestamp": 1588687728923,
                    "rating": 5.0, "title": "t", "verified_purchase": True, "helpful_vote": 2}, ensure_ascii=False),
        json.dumps({"text": "x", "parent_asin": "", "asin": "A2", "rating": 4}),
        json.dumps({"text": "", "asin": "A3"}),
        json.dumps({"text": "no product"}),
        "",
        "   ",
        '{"text": "broken',
        "[1, 2]",
    ]
    staged = rv.read_json(spark, write(tmp_path / "r.jsonl", "\n".join(lines)))
    got = {r.product_id: r for r in rj.accepted(staged).collect()}
    assert set(got) == {"P1", "A2"}
    first = got["P1"]
    assert first.review_date == date(2020, 5, 5) and first.rating == 5.0 and first.text_raw == "Très bon"
    assert first.metadata.title == "t" and first.metadata.helpful_vote == 2 and first.metadata.verified_purchase
    assert got["A2"].review_date is None
    assert reasons(staged) == {("json", "broken_line"): 1, ("json", "no_text"): 2, ("json", "no_product"): 1}


def test_json_ids(spark):
    lines = spark.createDataFrame([(json.dumps({"text": "x", "asin": "A"}),), (json.dumps({"text": "x", "asin": "A", "user_id": "u", "timestamp": 7}),)], "value string")
    ids = {r.review_id for r in rv.stage_json(lines).collect()}
    expected = spark.range(1).select(schema.review_id("json", F.lit("")), schema.review_id("json", F.lit("u7"))).first()
    assert ids == set(expected)


def test_csv(spark, tmp_path):
    text = (
        "review_id,extra,product_id,review_text,star_rating,review_date\n"
        'r1,z,P1,"two\nlines, ""quoted""",4.7,2024-03-12\n'
        "r2,z,P2,,5,2024-03-12\n"
        "NA,z,P3,text,5,2024-03-12\n"
        "r4,z,null,text,5,2024-03-12\n"
        "r5,z,P5,text,bad,2024-03-12\n"
        "r6,z,P6,text,,soon\n"
    )
    staged = rv.read_csv(spark, write(tmp_path / "r.csv", text))
    got = {r.product_id: r for r in rj.accepted(staged).collect()}
    assert set(got) == {"P1", "P6"}
    assert got["P1"].text_raw == 'two\nlines, "quoted"' and got["P1"].rating == 4.0 and got["P1"].review_date == date(2024, 3, 12)
    assert got["P6"].rating is None and got["P6"].review_date is None
    assert reasons(staged) == {("csv", r): 1 for r in ("no_text", "no_id", "no_product", "bad_rating")}


def test_csv_with_missing_columns(spark, tmp_path):
    staged = rv.read_csv(spark, write(tmp_path / "r.csv", "review_id,product_id,review_text\nr1,P1,fine\n"))
    assert rj.accepted(staged).first().rating is None


def test_report_rows(spark):
    rows = [
        (["Product ID", "Rating", "Review", "Date"],), ([None, "1", "x", "y"],), ([" B001 ", "5 stars", " Good ", "2024-3-5"],),
        (["B001", "x5", "Good", None],), (["B002", "3"],), (["", "3", "text", None],),
    ]
    staged = rv.stage_report(spark.createDataFrame(rows, "cells array<string>"))
    got = rj.accepted(staged).collect()
    assert [(r.product_id, r.rating, r.text_raw, r.review_date) for r in got] == [
        ("B001", 5.0, "Good", date(2024, 3, 5)), ("B001", None, "Good", None),
    ]
    assert got[1].review_id.startswith("d30dbde5")
    assert reasons(staged) == {("pdf", "no_text"): 1, ("pdf", "no_product"): 1}


def test_images(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(b"good one ")
    (tmp_path / "b.png").write_bytes(b" ")
    (tmp_path / "c.txt").write_bytes(b"ignored")

    def read(batches):
        for b in batches:
            yield b.map(lambda x: bytes(x).decode())

    staged = rv.read_images(spark, str(tmp_path), read)
    got = rj.accepted(staged).collect()
    assert [(r.product_id, r.text_raw, r.source) for r in got] == [("a", "good one", "ocr")]
    assert reasons(staged) == {("ocr", "no_text"): 1}


PAGE = """<html><article><h3>Outside</h3></article>
<div class='row cola x'><div><article class="-pvm -hr">
 <div class="stars _m _al">5 out of 5<div class="in" style="w"></div></div>
 <h3 class="-m">Bon &amp; beau</h3><p class="-pvm"><b>nested</b>Tr&egrave;s bien.</p>
 <div class="-df -j-bet"><div class="-pvm"><span class="-prm">12-03-2024</span><span>par Ann</span></div>
 <div><svg></svg>Achat vérifié</div></div></article></div>
 <article><h3></h3><p></p></article></div>
<div class="colander"><article><p>Not here</p></article></div></html>"""


def test_review_page(spark):
    staged = pg.stage_pages(spark.createDataFrame([("77", PAGE), ("78", "<p>nothing</p>")], "product_id string, html string"))
    got = rj.accepted(staged).collect()
    assert len(got) == 1
    r = got[0]
    assert r.text_raw == "Bon & beau. Très bien" and r.rating == 5.0 and r.review_date == date(2024, 3, 12)
    assert r.metadata.author == "Ann" and r.metadata.verified_purchase
    expected = spark.range(1).select(schema.review_id(schema.SOURCE_PAGE, F.lit("77:12-03-2024:Ann:Bon & beau"))).first()[0]
    assert r.review_id == expected
    assert reasons(staged) == {(schema.SOURCE_PAGE, "no_text"): 1}


def test_links(spark):
    page = """<div class="pg-w"><a href="/x?page=2">2</a><a href='/all'>all</a></div>
    <a href="/x?page=3">outside</a><a class="c" href="/tv-12.html">tv</a><a href="/r/productratingsreviews/sku/1">r</a>"""
    df = spark.createDataFrame([(page,), ("<a href='/y'>y</a>",)], "html string")
    found = {(r.kind, r.link) for r in pg.discovered_links(df).collect()}
    assert found == {("pagination", "/x?page=2"), ("product", "/tv-12.html")}
    assert [r[0] for r in df.select(pg.reviews_link("html")).collect()] == ["/r/productratingsreviews/sku/1", None]


def test_review_page_join_keeps_products_without_link(spark):
    products = spark.createDataFrame(
        [("https://h/a-1.html", '<a href="/productratingsreviews/1">r</a>'), ("https://h/b", "none"), ("https://h/c", "")],
        "product_url string, html string",
    )
    pages = spark.createDataFrame([("https://h/productratingsreviews/1", PAGE)], "url string, html string")
    joined = pg.review_pages(products, pages, "https://h")
    assert {(r.product_id, r.html is not None) for r in joined.collect()} == {("1", True), ("https://h/b", False), ("https://h/c", False)}
    reviews = rj.accepted(pg.stage_pages(joined.where("html is not null")))
    assert tuple(pg.extraction_totals(joined, reviews).first()) == (1, 1, 2)


def test_sources_union_keeps_equal_ids_of_two_sources(spark):
    a = rj.accepted(rv.stage_csv(spark.createDataFrame([("same", "P", "t")], "review_id string, product_id string, review_text string")))
    b = rj.accepted(rv.stage_image_texts(spark.createDataFrame([("same.jpg", "t")], "path string, text string")))
    both = rj.union_sources(a, b)
    assert both.schema == schema.REVIEW or both.columns == [f.name for f in schema.REVIEW.fields]
    assert {r.source: r.n_rows for r in rj.source_counts(both).collect()} == {"csv": 1, "ocr": 1}


def test_sinks(spark, tmp_path):
    lines = spark.createDataFrame([(json.dumps({"text": "é", "asin": "A", "timestamp": 1588687728923}),)], "value string")
    sinks.write_reviews_json(rj.accepted(rv.stage_json(lines)), str(tmp_path / "out"))
    row = json.loads(spark.read.text(str(tmp_path / "out")).first()[0])
    assert row["review_date"] == "2020-05-05" and row["text_raw"] == "é" and row["language"] is None
    texts = spark.createDataFrame([("a.jpg", " " + "x" * 300), ("b.jpg", " ")], "filename string, text string")
    sinks.write_truth(texts, str(tmp_path / "truth"))
    assert [(r.filename, len(r.truth)) for r in cs.read_truth(spark, str(tmp_path / "truth"), False).collect()] == [("a.jpg", 250)]


def test_whole_truth_file_and_cases(spark, tmp_path):
    truth = write(tmp_path / "t.json", json.dumps({"a.jpg": "x", "b.jpg": "é"}, indent=2, ensure_ascii=False))
    assert {tuple(r) for r in cs.read_truth(spark, truth).collect()} == {("a.jpg", "x"), ("b.jpg", "é")}
    cases = write(tmp_path / "c.json", json.dumps([{"question": "q", "category": "c", "relevant_reviews": None, "expects_answer": False}], indent=1))
    assert cs.read_cases(spark, cases).first().asDict() == {"question": "q", "category": "c", "relevant_reviews": None, "expects_answer": False}
    urls = write(tmp_path / "u.jsonl", '{"product_url": "https://h/a-1.html"}\n')
    assert cs.read_product_urls(spark, urls).first()[0] == "https://h/a-1.html"


def test_head_sample(spark):
    df = spark.range(100).withColumnRenamed("id", "n")
    assert [r.n for r in cs.head_sample(df, 3, "n").collect()] == [0, 1, 2]
    assert cs.head_sample(df, 3).count() == 3


def frame(spark, rows):
    return spark.createDataFrame(rows, "review_id string, text string")


def test_upsert(spark):
    index, batch = frame(spark, [("a", "1"), ("b", "2")]), frame(spark, [("b", "3"), ("c", "4"), ("c", "5")])
    got = sorted(tuple(r) for r in up.upsert(index, batch).collect())
    assert got[:2] == [("a", "1"), ("b", "3")] and [g[0] for g in got[2:]] == ["c"]
    again = up.upsert(up.upsert(index, batch), batch)
    assert sorted(tuple(r) for r in again.collect()) == got


def test_repeated_ids_choose_alike_with_maps(spark):
    rows = [("a", {"k": "1"}), ("a", {"k": "2"}), ("b", None)]
    df = spark.createDataFrame(rows, "review_id string, m map<string,string>")
    one = sorted((r.review_id, str(r.m)) for r in up.distinct_batch(df).collect())
    two = sorted((r.review_id, str(r.m)) for r in up.distinct_batch(df.repartition(3)).collect())
    assert one == two and len(one) == 2


def test_stored_batches(spark, tmp_path):
    root = str(tmp_path / "ix")
    up.write_batch(frame(spark, [("a", "1"), ("b", "2")]), root, 0)
    assert up.read_index(spark, root).count() == 2
    up.write_batch(frame(spark, [("b", "3")]), root, 1)
    up.write_batch(frame(spark, [("b", "4"), ("c", "5")]), root, 2)
    want = [("a", "1"), ("b", "4"), ("c", "5")]
    assert sorted(tuple(r) for r in up.read_index(spark, root).collect()) == want
    up.write_batch(frame(spark, [("b", "4"), ("c", "5")]), root, 2)
    assert sorted(tuple(r) for r in up.read_index(spark, root).collect()) == want
    up.compact(spark, root, str(tmp_path / "ix2"))
    assert sorted(tuple(r) for r in up.read_index(spark, str(tmp_path / "ix2")).collect()) == want


def test_incremental_ingest_replays_are_harmless(spark, tmp_path):
    src, root, state = tmp_path / "in", str(tmp_path / "ix"), str(tmp_path / "state")
    rejects = str(tmp_path / "rejects")
    src.mkdir()

    def put(name, records):
        write(src / name, "\n".join(json.dumps(r) for r in records))

    def load(checkpoint=state):
        query = start_ingest(spark, str(src), root, checkpoint, lambda r: r, rejects_root=rejects)
        query.awaitTermination()
        return {r.product_id: r.document for r in up.read_index(spark, root).collect()}

    put("1.jsonl", [{"text": "one", "asin": "A", "user_id": "u", "timestamp": 1}])
    assert load() == {"A": "one"}
    put("2.jsonl", [{"text": "new", "asin": "A", "user_id": "u", "timestamp": 1}, {"text": "two", "asin": "B"}, {"text": ""}])
    assert load() == {"A": "new", "B": "two"}
    assert load() == {"A": "new", "B": "two"}
    counted = spark.read.schema("source string, reject_reason string, n_rows long, batch int").json(rejects).drop("writer")
    assert [tuple(r) for r in counted.collect()] == [("json", "no_text", 1, 1)]


def test_lines_that_one_parser_refuses(spark):
    lines = [
        '{"text": "odd number", "asin": "N", "rating": NaN}',
        '{"text": "first", "asin": "R", "text": "last"}',
        '{"text": "no time", "asin": "Z", "user_id": "u", "timestamp": null}',
        '{"text": "a point", "asin": "F", "user_id": "u", "timestamp": 1588687728923.0}',
        '{"text": "broken", "asin": "B"',
    ]
    rows = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r.product_id: r for r in rj.accepted(rv.stage_json(rows)).collect()}
    assert set(got) == {"N", "R", "Z", "F"} and got["R"].text_raw == "last" and got["N"].rating != got["N"].rating
    ids = spark.range(1).select(*[schema.review_id("json", F.lit(x)) for x in ("uNone", "u1588687728923.0")]).first()
    assert (got["Z"].review_id, got["F"].review_id) == tuple(ids) and got["F"].review_date == date(2020, 5, 5)


def test_csv_files_of_two_headers_fail(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.csv", "review_id,product_id,review_text,star_rating,review_date\nr1,P1,good,5,2024-03-12\n")
    write(tmp_path / "in" / "b.csv", "product_id,review_id,review_text,star_rating,review_date\nP2,r2,fine,4,2024-03-12\n")
    with pytest.raises(Exception, match="(?i)header"):
        rj.accepted(rv.read_csv(spark, str(tmp_path / "in"))).collect()


def test_epoch_start_is_exported(spark, tmp_path):
    raw = spark.createDataFrame([("u", 0, "P", None, "t", 5.0)], "user_id string, timestamp long, parent_asin string, asin string, text string, rating double")
    sinks.export_csv(raw, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).first().review_date == "1970-01-01"


def test_links_are_decoded_and_resolved(spark):
    page = """<ul class="pg-w"><a href="?page=2&amp;q=a#top">2</a></ul><a href=/lamp-9.html>lamp</a>
    <a class=x href='lamp-8.html'>b</a><a href="//cdn.example/lamp-7.html">c</a><a href="https://o.example/lamp-6.html">d</a>"""
    rows = [(page, f"https://{h}.example/home/lamps?x=1") for h in ("one", "two")]
    df = spark.createDataFrame(rows, "html string, url string")
    expected = set()
    for host in ("https://one.example", "https://two.example"):
        expected |= {("pagination", f"{host}/home/lamps?page=2&q=a"), ("product", f"{host}/lamp-9.html"),
                     ("product", f"{host}/home/lamp-8.html")}
    expected |= {("product", "https://cdn.example/lamp-7.html"), ("product", "https://o.example/lamp-6.html")}
    assert {(r.kind, r.link) for r in pg.discovered_links(df, url="url").collect()} == expected


def test_marker_with_entities(spark):
    block = "<div class=cola></div><div class='cola'><article><h3>T &amp; U</h3><p>Body</p><i>Achat v&eacute;rifi&eacute;</i></article></div>"
    got = rj.accepted(pg.stage_pages(spark.createDataFrame([("P", block)], "product_id string, html string"))).first()
    assert got.metadata.verified_purchase and got.text_raw == "T & U. Body"


def python_stages(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("ArrowEvalPython")


def test_python_runs_once(spark, tmp_path):
    (tmp_path / "img").mkdir()
    (tmp_path / "img" / "a.jpg").write_bytes(b"seen")

    def recognise(batches):
        for images in batches:
            yield images.map(lambda b: b.decode())

    images = rj.accepted(rv.read_images(spark, str(tmp_path / "img"), recognise))
    pages = spark.createDataFrame([("P", "<div class='cola'><article><p>a &amp; b</p></article></div>")], "product_id string, html string")
    assert images.first().text_raw == "seen"
    assert python_stages(images) == 1 and python_stages(rj.accepted(pg.stage_pages(pages))) == 1


def test_writers_do_not_touch_each_other(spark, tmp_path):
    root, src = str(tmp_path / "ix"), tmp_path / "in"
    src.mkdir()
    bulk = spark.createDataFrame([(f"b{i}", f"text {i}") for i in range(100)], "review_id string, text_raw string")
    bulk = bulk.selectExpr("*", "'P' AS product_id", "'json' AS source", "CAST(NULL AS STRING) AS text_clean", "1.0D AS rating")
    up.write_batch(index_rows(bulk), root, 0)
    write(src / "1.jsonl", json.dumps({"text": "one", "asin": "A", "user_id": "u", "timestamp": 1}))
    for state in ("first", "lost and new"):
        start_ingest(spark, str(src), root, str(tmp_path / state), lambda r: r).awaitTermination()
    assert up.read_index(spark, root, schema=INDEX).count() == 101
    later = index_rows(bulk.limit(1).withColumn("language", F.lit("en")))
    up.write_batch(later, root, 0, "tags")
    up.write_batch(index_rows(bulk.withColumn("text_raw", F.lit("second"))), root, 1)
    up.write_batch(later, root, 0, "tags")  # a replay keeps its place before the load that came after it
    read = up.read_index(spark, root, schema=INDEX)
    assert read.where("document = 'second'").count() == 100 and read.columns == INDEX.names
    with pytest.raises(ValueError):
        up.write_batch(later, root, 0, "a/b")


def test_shared_path_needs_a_shared_folder(spark):
    from voxgauge.session import shared_path

    assert shared_path(spark, "x") != shared_path(spark, "x")
