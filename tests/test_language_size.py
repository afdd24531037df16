"""Small profiles are looked up where a text is read: one row per text and language leaves the scan, not one per trigram."""

import pytest
from pyspark.sql import functions as F

from voxgauge.operators import language as lg

TEXTS = ["Der Hund läuft im Wald und bellt", "the dog runs in the woods and barks", "a😀b😀a😀b", "ab", "", None, "zzzzzz\nzz", "THE DOG İI"]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(i % 7, t) for i, t in enumerate(TEXTS * 3)], "id int, text string")  # ids repeat


@pytest.fixture
def profiles(spark):
    known = [("de", "der", 1.5), ("de", "und", 2.0), ("de", " un", 1.0), ("en", "the", 2.5), ("en", " do", 1.0), ("de", " do", 0.25)]
    odd = [("xx", "a😀b", 3.0), ("xx", "a😀b", 0.5), (None, "zzz", 9.0), ("en", None, 1.0), ("en", "long", 1.0), ("en", "zz\n", 1.0)]
    return spark.createDataFrame(known + odd, "lang string, gram string, weight double")


def scored(found):
    return sorted((r.id, r.language, r.score and round(r.score, 9)) for r in found.collect())


@pytest.mark.parametrize("held", [1, 1 << 20])
def test_lookup_and_join_agree(rows, profiles, monkeypatch, held):
    monkeypatch.setattr(lg, "HELD_SUMS", held)
    monkeypatch.setattr(lg, "HELD_WEIGHTS", held)
    in_place = scored(lg.language_scores(rows, profiles, ["id"], "text"))
    monkeypatch.setattr(lg, "BROADCAST_BYTES", -1)
    assert in_place == scored(lg.language_scores(rows, profiles, ["id"], "text"))
    assert {x[1] for x in in_place} >= {"de", "en", "xx"}


def test_trigrams_are_not_rows(rows, profiles):
    plan = lg.language_scores(rows, profiles, ["id"], "text")._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan and "Join" not in plan


@pytest.mark.parametrize("profile", [[], [("en", "the", None)]])
def test_profiles_without_weights(spark, rows, profile):
    profiles = spark.createDataFrame(profile, "lang string, gram string, weight double")
    assert lg.language_scores(rows, profiles, ["id"], "text").where(F.col("score").isNotNull()).count() == 0
