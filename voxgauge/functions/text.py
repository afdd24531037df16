"""Column expressions on text, dates and numbers. All run inside the JVM except entity decoding."""

from __future__ import annotations

import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Every character str.isspace() accepts; Java's \s knows only the ASCII ones.
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
SPACE_CLASS = r"[\s\x1c-\x1f]"

# Lengths at which the analysed texts are cut or refused.
MIN_LANGUAGE_CHARS = 20
MODEL_CHARS = 512
ID_TEXT_CHARS = 50
REPORT_CHARS = 200
TRUTH_CHARS = 250


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def decode_entities(c: Column | str) -> Column:
    """HTML entities to characters. Only rows holding an ampersand carry their text to Python."""
    c = col(c)
    return F.coalesce(_unescape(F.when(c.contains("&"), c)), c)


def strip(c: Column | str) -> Column:
    """Trim every Unicode space at both ends."""
    return F.btrim(col(c), F.lit(SPACES))


def collapse_spaces(c: Column | str) -> Column:
    return F.btrim(F.regexp_replace(col(c), f"(?U){SPACE_CLASS}+", " "))


def clean_text(c: Column | str) -> Column:
    """Decode entities, then drop tags, then collapse white space, then trim."""
    return collapse_spaces(F.regexp_replace(decode_entities(c), "<[^>]+>", " "))


def non_empty(c: Column | str) -> Column:
    """Null for the empty string, as truthiness tests treat both alike."""
    return F.nullif(col(c), F.lit(""))


def first_non_empty(*cols: Column | str) -> Column:
    return F.coalesce(*[non_empty(c) for c in cols])


def analysed_text() -> Column:
    """The cleaned text, or the raw one when cleaning has not run or left nothing."""
    return F.coalesce(non_empty("text_clean"), F.col("text_raw"))


def long_enough(c: Column | str) -> Column:
    return F.length(strip(c)) >= MIN_LANGUAGE_CHARS


def split_sentences(c: Column | str) -> Column:
    """Array of sentences: a break follows ``.``, ``!`` or ``?`` before white space."""
    parts = F.split(strip(c), f"(?U)(?<=[.!?]){SPACE_CLASS}+")
    return F.filter(parts, lambda s: s != "")


def cut(c: Column | str, n: int) -> Column:
    return F.substring(col(c), 1, n)


def leading_digit(c: Column | str) -> Column:
    """Rating from its first character: ``5 out of 5`` is 5, ``x5`` is null."""
    return F.regexp_extract(strip(c), r"^([0-9])", 1).try_cast("int").cast("double")


def truncated_number(c: Column | str) -> Column:
    """Whole part of a decimal text (``4.7`` is 4); anything else is null."""
    c = col(c)
    plain = F.when(strip(c).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), strip(c))
    return plain.try_cast("double").try_cast("long").cast("double")


def bind(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is computed once however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), 0)


def calendar_date(year: Column, month: Column, day: Column) -> Column:
    """Date of three numbers, null where the calendar has no such day. Raises nothing, unlike a parse."""

    def build(p: Column) -> Column:
        first = F.when((p["y"] >= 1) & p["m"].between(1, 12), F.make_date(p["y"], p["m"], F.lit(1)))
        inside = (p["d"] >= 1) & (p["d"] <= F.dayofmonth(F.last_day(first)))
        return F.when(inside, F.date_add(first, p["d"] - 1))

    return bind(F.struct(year.alias("y"), month.alias("m"), day.alias("d")), build)


def _slice_number(c: Column, start: int, length: int) -> Column:
    return F.substring(c, start, length).try_cast("int")


DAY_MONTH_YEAR = r"[0-9]{2}-[0-9]{2}-[0-9]{4}"
YEAR_MONTH_DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def day_month_year(c: Column | str) -> Column:
    """First ``dd-MM-yyyy`` anywhere in the text; impossible dates are null."""
    found = F.regexp_extract(col(c), DAY_MONTH_YEAR, 0)
    return bind(
        found, lambda t: calendar_date(_slice_number(t, 7, 4), _slice_number(t, 4, 2), _slice_number(t, 1, 2))
    )


def _numbers(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit("[0-9]+"), 0), lambda n: n.try_cast("int"))


def year_month_day(c: Column | str) -> Column:
    """The whole trimmed text as ``yyyy-MM-dd``, padded or not."""

    def read(t: Column) -> Column:
        date = bind(_numbers(t), lambda n: calendar_date(F.get(n, 0), F.get(n, 1), F.get(n, 2)))
        return F.when(t.rlike(YEAR_MONTH_DAY), date)

    return bind(strip(c), read)


# The names of months and days that a written date may hold, in full or by three letters.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTH = (
    "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:tember)?|oct(?:ober)?"
    "|nov(?:ember)?|dec(?:ember)?)"
)
WEEKDAY = r"(?i)^(mon(day)?|tue(sday)?|wed(nesday)?|thu(rsday)?|fri(day)?|sat(urday)?|sun(day)?),? +"
TIME = r"(?i)[T ] *([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9]([.][0-9]+)?)?( ?[ap]m)?( ?(Z|UTC|[+-][0-9]{2}:?[0-9]{2}))?$"
YEAR_FIRST = r"^[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}$"
YEAR_MONTH = r"^[0-9]{4}[-/][0-9]{1,2}$"
YEAR_LAST = r"^[0-9]{1,2}[-/.][0-9]{1,2}[-/.]([0-9]{4}|[0-9]{2})$"
COMPACT = r"^[0-9]{8}$"
MONTH_FIRST = rf"(?i)^{MONTH}[.]? [0-9]{{1,2}},? [0-9]{{4}}$"
DAY_FIRST = rf"(?i)^[0-9]{{1,2}}[- ]{MONTH}[.]?,?[- ][0-9]{{4}}$"


def free_date(c: Column | str) -> Column:
    """Date in one of the usual written forms, else null. The month comes first where both orders fit.

    A weekday before the date and a time of day behind it are passed over; a time that no clock shows makes it no date. Years
    of two digits are those from 1969 to 2068.
    """
    months = F.array(*[F.lit(m) for m in MONTHS])

    def read(t: Column) -> Column:
        name = F.lower(F.substring(F.regexp_extract(t, "[A-Za-z]+", 0), 1, 3))
        month = F.nullif(F.array_position(months, name), F.lit(0)).cast("int")

        def by_shape(n: Column) -> Column:
            a, b, y = F.get(n, 0), F.get(n, 1), F.get(n, 2)
            short = t.rlike(r"[^0-9][0-9]{2}$")
            year = F.when(short, y + F.when(y < 69, 2000).otherwise(1900)).otherwise(y)
            return (
                F.when(t.rlike(YEAR_FIRST), calendar_date(a, b, y))
                .when(t.rlike(YEAR_MONTH), calendar_date(a, b, F.lit(1)))
                .when(t.rlike(YEAR_LAST), F.coalesce(calendar_date(year, a, b), calendar_date(year, b, a)))
                .when(
                    t.rlike(COMPACT),
                    calendar_date(_slice_number(t, 1, 4), _slice_number(t, 5, 2), _slice_number(t, 7, 2)),
                )
                .when(t.rlike(MONTH_FIRST) | t.rlike(DAY_FIRST), calendar_date(b, month, a))
            )

        return bind(_numbers(t), by_shape)

    day = F.regexp_replace(F.regexp_replace(strip(c), TIME, ""), WEEKDAY, "")
    return bind(day, read)


def epoch_ms_date(c: Column | str) -> Column:
    """UTC date of epoch milliseconds, whatever the session time zone; 0 and null give null."""
    days = F.floor(F.nullif(col(c), F.lit(0)) / F.lit(86_400_000)).cast("int")
    return F.date_from_unix_date(days)


def epoch_s_date(c: Column | str) -> Column:
    return F.date_from_unix_date(F.floor(col(c) / F.lit(86_400)).cast("int"))


def merge_title(title: Column | str, body: Column | str) -> Column:
    """``title. body`` without any dot or space at either end; the body's last full stop goes too."""
    joined = F.concat(F.coalesce(col(title), F.lit("")), F.lit(". "), F.coalesce(col(body), F.lit("")))
    return strip(F.btrim(joined, F.lit(". ")))


def author_name(c: Column | str) -> Column:
    return strip(F.replace(col(c), F.lit("par "), F.lit("")))


def url_product_id(url: Column | str) -> Column:
    """Digits before ``.html``, else the URL itself."""
    return F.coalesce(non_empty(F.regexp_extract(col(url), r"-([0-9]+)\.html", 1)), col(url))


def absolute_url(url: Column | str, host: str) -> Column:
    u = col(url)
    return F.when(u.startswith("http"), u).otherwise(F.concat(F.lit(host), u))


def file_name(path: Column | str) -> Column:
    return F.regexp_extract(col(path), r"([^/]*)$", 1)


def file_stem(path: Column | str) -> Column:
    """File name without its last suffix; a leading dot does not start a suffix."""
    return F.regexp_replace(file_name(path), r"(?<=[^/])\.[^.]+$", "")


def edit_distance(predicted: Column | str, truth: Column | str) -> Column:
    """Levenshtein distance over the truth's length; 1 for an empty truth, may exceed 1."""
    t = F.coalesce(col(truth), F.lit(""))
    p = F.coalesce(col(predicted), F.lit(""))
    return F.when(F.length(t) == 0, F.lit(1.0)).otherwise(F.levenshtein(p, t) / F.length(t))


def stars(rating: Column | str) -> Column:
    """Rating as up to five stars, rounded half to even."""
    r = col(rating)
    filled = F.least(F.lit(5), F.bround(r).cast("int"))
    return F.when(r.isNull() | (r < 0), F.lit("No rating")).otherwise(F.repeat(F.lit("★"), filled))


def xml_escape(c: Column | str) -> Column:
    out = F.replace(col(c), F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))


def whole_percent(c: Column | str) -> Column:
    """``37%``, halves to even; null stays null."""
    return F.when(col(c).isNotNull(), F.format_string("%.0f%%", F.bround(col(c) * 100, 0)))


def two_decimals(c: Column | str) -> Column:
    """``0.12`` for an eighth: the number itself is rounded, halves to even, not its shortest decimal."""
    return F.call_function("format_number", col(c).cast("double"), F.lit("0.00"))


def report_text(summary: Column | str, body: Column | str) -> Column:
    """Text of one row of a printed report: merged, cut, then escaped."""
    joined = F.concat(F.coalesce(col(summary), F.lit("")), F.lit(". "), F.coalesce(col(body), F.lit("")))
    return xml_escape(cut(F.btrim(joined, F.lit(". ")), REPORT_CHARS))
