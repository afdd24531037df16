"""Every registered query of the catalog against its SQL on the smallest data."""

import pytest

import __spark_entry__ as entry
import check
from voxgauge import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return check.database(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, database, name):
    ok, note = check.compare(spark, database, SF, name)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
