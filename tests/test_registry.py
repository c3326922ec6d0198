"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from registry import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, con, small, name):
    outcome, rows = compare(spark, con, small, name)
    assert outcome == "ok"
    assert rows > 0


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["window_start", "window_end", "source_id", "article_count"]
    assert not df.isEmpty()


def test_results_do_not_depend_on_the_session_zone(spark, con, small):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kathmandu")
    try:
        assert compare(spark, con, small, "windowed_count_by_source")[0] == "ok"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
