import html
import re
import random
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from voxgauge import schema
from voxgauge.functions import aspects as asp, entities as ent, intent, text as tx


def test_review_id_is_deterministic_and_differs_by_source(spark):
    row = spark.range(1).select(
        schema.review_id("json", F.lit("user123:1234567890")),
        schema.review_id("json", F.lit("same_original_id")),
        schema.review_id("csv", F.lit("same_original_id")),
        schema.review_id("ocr", F.lit("review_00.jpg")),
    ).first()
    assert row[0] == "fac34b29571bf5b7515ab3b89b0f0f4e87f22920"
    assert row[1].startswith("a3b3fc7b") and row[2].startswith("c42cc2c2")
    assert row[3] == "525589ff27ab1f391fae4491538ac84528c914c3"


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Great product<br />Highly recommend", "Great product Highly recommend"),
        ("Price &amp; quality are great", "Price & quality are great"),
        ("Too   many\n\nspaces", "Too many spaces"),
        ("5 &lt; 6 and 7 &gt; 2 ok", "5 2 ok"),
        ("&lt;b&gt;bold&lt;/b&gt;", "bold"),
        ("&amp;lt;b&amp;gt;", "&lt;b&gt;"),
        ("a  b", "a b"),
        ("caf&eacute; &#8364;5 &unknown; &notit;", html.unescape("café €5 &unknown; &notit;")),
        ("", ""),
        (None, None),
    ],
)
def test_clean_text(values, raw, clean):
    assert values(tx.clean_text, [raw]) == [clean]


def _plain_clean(text):
    text = re.sub(r"<[^>]+>", " ", html.unescape(text))
    return re.sub(r"\s+", " ", text).strip()


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab<>/&;#39ltgamp \t\n\x0b\x1c\x85  é😀.!?", max_size=40), min_size=30, max_size=60))
def test_text_rules_agree_with_plain_python(values, texts):
    assert values(tx.clean_text, texts) == [_plain_clean(t) for t in texts]
    expected = [[s for s in re.split(r"(?<=[.!?])\s+", t.strip()) if s] for t in texts]
    assert values(tx.split_sentences, texts) == expected
    assert values(tx.strip, texts) == [t.strip() for t in texts]


def test_sentences(values):
    got = values(tx.split_sentences, ["Great price. Arrived late!  Bad service? ok", "v1.2 is fine", ""])
    assert [len(x) for x in got] == [4, 1, 0]


def test_detect_aspects(values):
    got = values(asp.detect_aspects, ["Great price.", "Arrived late!", "worthless", "nothing here", "Qualité et LIVRAISON"])
    assert got == [["price"], ["shipping"], ["price"], [], ["product", "shipping"]]


def test_aspect_texts_and_fallback(spark):
    long = "x" * 600
    df = spark.createDataFrame(
        [(1, "Great price. Arrived late! Cheap too."), (2, "nothing here"), (3, f"The seller {long}.")], "id int, t string"
    )
    got = {r.id: r.aspect_texts for r in asp.with_aspect_texts(df, F.col("t")).collect()}
    assert got[1].price == "Great price. Cheap too." and got[1].shipping == "Arrived late!" and got[1].product is None
    assert got[2].product == "nothing here" and got[2].price is None
    scored = asp.with_aspect_texts(df, F.col("t")).select(F.max(F.length(asp.scored_text("aspect_texts.service"))))
    assert scored.first()[0] == 512


def test_star_label(values):
    assert values(asp.star_label, [1, 2, 3, 4, 5, None], "int") == [
        "negative", "negative", "neutral", "positive", "positive", None,
    ]


def test_skus(values):
    text = "AB12345 B0012 AB12345 abc1234 ABCD1234 Z9999X éA1234"
    assert values(ent.extract_skus, [text, "none"]) == [["AB12345", "B0012", "Z9999X"], []]


def test_intent(values):
    asked = ["What do customers complain about?", "What do customers love?", "What products are mentioned?", "love it but a problem"]
    assert values(intent.wanted_sentiment, asked) == ["negative", "positive", None, "negative"]
    assert values(intent.is_blank, ["", "  \n", None, "x"]) == [True, True, True, False]


def test_ratings(values):
    assert values(tx.leading_digit, ["5 out of 5", " 3", "x5", "", None]) == [5.0, 3.0, None, None, None]
    assert values(tx.truncated_number, ["4.7", "5", " 3.0 ", "1e1", "-2.5", "bad", "5d", None]) == [
        4.0, 5.0, 3.0, 10.0, -2.0, None, None, None,
    ]


def test_dates(values):
    assert values(tx.day_month_year, ["31-02-2024", "le 03-02-2024.", "x", None, "29-02-2024", "00-01-2024"]) == [
        None, date(2024, 2, 3), None, None, date(2024, 2, 29), None,
    ]
    assert values(tx.year_month_day, [" 2024-03-05 ", "2024-3-5", "2024-02-31", "2024-03-05x", None]) == [
        date(2024, 3, 5), date(2024, 3, 5), None, None, None,
    ]
    free = ["2024-03-12", "2024/3/12", "3/12/2024", "25/12/2024", "25-12-2024", "March 5, 2024", "5 Mar 2024",
            "2024-03-12T10:00:00Z", "20240312", "yesterday", "Foo 5, 2024", "13/13/2024", None]
    assert values(tx.free_date, free) == [
        date(2024, 3, 12), date(2024, 3, 12), date(2024, 3, 12), date(2024, 12, 25), date(2024, 12, 25),
        date(2024, 3, 5), date(2024, 3, 5), date(2024, 3, 12), date(2024, 3, 12), None, None, None, None,
    ]
    assert values(tx.epoch_ms_date, [1588687728923, 0, None, -1], "long") == [
        date(2020, 5, 5), None, None, date(1969, 12, 31),
    ]


def test_dates_do_not_depend_on_the_session_zone(spark, values):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert values(tx.epoch_ms_date, [1588687728923], "long") == [date(2020, 5, 5)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_title_merge(spark):
    rows = [("Title", "Body."), ("", ""), ("T", None), ("", "only body...")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(tx.merge_title("a", "b")).collect()] == ["Title. Body", "", "T", "only body"]


def test_urls_and_files(values):
    assert values(tx.url_product_id, ["https://x/a-123.html?b", "https://x/a"]) == ["123", "https://x/a"]
    assert values(lambda c: tx.absolute_url(c, "https://h"), ["/a", "http://z/a"]) == ["https://h/a", "http://z/a"]
    assert values(tx.file_stem, ["d/a.b.jpg", "d/.hidden", "plain"]) == ["a.b", ".hidden", "plain"]
    assert values(tx.author_name, [" par Ann ", "Ann"]) == ["Ann", "Ann"]


def test_edit_distance(spark):
    df = spark.createDataFrame([("kitten", "sitting"), ("x", ""), (None, "ab"), ("é", "e")], "p string, t string")
    assert [r[0] for r in df.select(tx.edit_distance("p", "t")).collect()] == [3 / 7, 1.0, 1.0, 1.0]


def test_stars(values):
    assert values(tx.stars, [2.5, 3.5, None, -1.0, 9.0], "double") == ["★★", "★★★★", "No rating", "No rating", "★★★★★"]


def test_report_shapes(values):
    assert values(tx.whole_percent, [0.125, 0.5, 1.0], "double") == ["12%", "50%", "100%"]
    assert values(tx.two_decimals, [0.125, 0.555, 2.0], "double") == ["0.12", "0.56", "2.00"]
    assert values(tx.xml_escape, ["a<b & c>"]) == ["a&lt;b &amp; c&gt;"]
    assert values(lambda c: F.length(tx.report_text(F.lit("s"), c)), ["y" * 500]) == [200]


def test_language_gate(values):
    assert values(tx.long_enough, ["Love it", "x" * 20, " " * 30]) == [False, True, False]


def test_more_written_dates(values):
    day = date(2024, 3, 12)
    read = ["12-Mar-2024", "2024.03.12", "03/12/24", "March 12, 2024 10:30", "Tue, 12 Mar 2024", "2024-03-12 9:05 pm",
            "Tuesday 12 March 2024", "2024-03-12 23:59:59.5+02:00"]
    assert values(tx.free_date, read) == [day] * len(read)
    assert values(tx.free_date, ["2024-03", "1/2/69", "1/2/68"]) == [date(2024, 3, 1), date(1969, 1, 2), date(2068, 1, 2)]
    assert values(tx.free_date, ["Mayday 5, 2024", "2024-03-12 99:99", "Marching 5, 2024", "12:30", "2024-13"]) == [None] * 5


def test_two_decimals_round_the_number(values):
    rng = random.Random(4)
    numbers = [0.155, 0.005, 0.125, 0.375, 0.0, 1.0, 2.675, *[rng.random() for _ in range(300)]]
    assert values(tx.two_decimals, numbers, "double") == [f"{x:.2f}" for x in numbers]
