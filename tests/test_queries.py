import pytest

import __spark_entry__ as entry
from compare import difference
from starloom.oracle import ORACLE_SQL
from starloom.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), SMALL, ORACLE_SQL[name]) == ""


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns[:4] == ["year", "month", "category_name", "item_count"]
    assert found.count() > 0


def test_queries_are_strict_in_any_session(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert difference(QUERIES["fn_dates"](spark, SMALL), SMALL, ORACLE_SQL["fn_dates"]) == ""
        assert spark.conf.get("spark.sql.ansi.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
