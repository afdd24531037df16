"""Queries on engines, judges and extraction quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from voxgauge.catalog.registry import query, table
from voxgauge.functions import text as tx
from voxgauge.operators import engines as en
from voxgauge.plans import evaluate as ev


def ascii_text(c: str) -> Column:
    """Every other character as one mark, so that engines counting bytes and characters agree."""
    return F.regexp_replace(c, r"[^\x00-\x7F]", "?")


SQL_ASCII = r"regexp_replace(text, '[^\x00-\x7F]', '?', 'g')"


def drop_e(text: str) -> str:
    return text.replace("e", "")


def merge_th(text: str) -> str:
    return text.replace("th", "t")


def odd_fails(text: str) -> str:
    if len(text) % 2:
        raise ValueError(f"odd length {len(text)}")
    return text[::-1]


@query(
    f"""WITH t AS (SELECT {SQL_ASCII} AS truth FROM benchmark),
    p AS (SELECT 'drop_e' AS engine, truth, replace(truth, 'e', '') AS output FROM t
          UNION ALL SELECT 'merge_th', truth, replace(truth, 'th', 't') FROM t)
    SELECT engine, count(*) AS n,
      round(avg(CASE WHEN length(truth) = 0 THEN 1.0 ELSE levenshtein(output, truth) / length(truth) END), 6) AS avg_score
    FROM p GROUP BY 1"""
)
def edit_distance_board(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "benchmark").select("item_id", ascii_text("text").alias("truth"))
    predicted = en.run_engines(texts, {"drop_e": drop_e, "merge_th": merge_th}, "item_id", "truth")
    board = en.leaderboard(en.score_against_truth(predicted, texts, "item_id"), "score")
    return board.select("engine", "n", F.round("avg_score", 6).alias("avg_score"))


@query(
    f"""WITH t AS (SELECT item_id, {SQL_ASCII} AS x FROM benchmark)
    SELECT item_id, 'drop_e' AS engine, replace(x, 'e', '') AS output, false AS failed FROM t
    UNION ALL SELECT item_id, 'odd_fails',
      CASE WHEN length(x) % 2 = 1 THEN '[ERROR: odd length ' || length(x) || ']' ELSE reverse(x) END,
      length(x) % 2 = 1 FROM t"""
)
def engine_cross(spark: SparkSession, sf: str) -> DataFrame:
    """Every engine on every row; a failure is a row too."""
    texts = table(spark, sf, "benchmark").select("item_id", ascii_text("text").alias("x"))
    ran = en.run_engines(texts, {"drop_e": drop_e, "odd_fails": odd_fails}, "item_id", "x")
    return ran.select("item_id", "engine", "output", "failed")


@query(
    """SELECT role, count(*) AS n, round(avg((length(text) % 3 > 0)::INT), 6) AS pass_rate,
    printf('%.0f%%', round_even(100 * avg((length(text) % 3 > 0)::INT), 0)) AS shown,
    printf('%.2f', round_even(avg((length(text) % 3 > 0)::INT), 2)) AS shown_rate FROM conversations GROUP BY 1"""
)
def judge_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Pass rate per role over judge texts; a text without the mark is a failure."""
    n = F.length("text") % 3
    verdict = F.when(n == 1, "VERDICT: PASS\nREASON: fine").when(n == 2, "I say VERDICT: PASS").otherwise("VERDICT: FAIL")
    judged = table(spark, sf, "conversations").select("role", ev.passed(verdict).cast("int").alias("ok"))
    rates = judged.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.avg("ok").alias("r"))
    return rates.select(
        "role",
        "n",
        F.round("r", 6).alias("pass_rate"),
        tx.whole_percent("r").alias("shown"),
        tx.two_decimals("r").alias("shown_rate"),
    )
