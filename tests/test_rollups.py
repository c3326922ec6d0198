"""Totals, rankings, and the questions asked of counts."""

import random

import pytest
from pyspark.sql import functions as F

from tallywire.operators.documents import key_documents
from tallywire.operators.ranking import with_rank
from tallywire.operators.rollups import (
    NO_DATA, chart_data, data_status, first_rows, top_key, total_per_key, total_per_key_sorted,
    windows_per_key,
)
from tallywire.plans.dashboard import bars_or_status
from tallywire.schemas import SOURCE_COUNTS

_KEYS = ("source_id", "article_count")


def counts(spark, *rows):
    data = [((None, None), key, n) for key, n in rows]
    return spark.createDataFrame(data, SOURCE_COUNTS)


def test_null_keys_are_not_totalled(spark):
    df = counts(spark, ("a", 2), ("a", 3), (None, 9), ("b", 1))
    assert sorted(map(tuple, total_per_key(df, *_KEYS).collect())) == [("a", 5), ("b", 1)]


def test_windows_are_counted_not_articles(spark):
    df = counts(spark, ("a", 1), ("a", 1), ("b", 100), (None, 1))
    assert {tuple(r) for r in windows_per_key(df, "source_id").collect()} == {
        ("a", 2, 1), ("b", 1, 2)}
    bars = {r.source_id: (r.height, r.label, r.articles, r["rank"])
            for r in chart_data(df, *_KEYS).collect()}
    assert bars == {"a": (2, 2, 2, 1), "b": (1, 1, 100, 2)}


def test_top_key_breaks_ties_by_name(spark):
    df = counts(spark, ("b", 2), ("c", 2), ("a", 1), (None, 50))
    assert tuple(top_key(df, *_KEYS).first()) == ("b", 2)


def test_empty_input_gives_empty_results(spark):
    df = counts(spark)
    assert total_per_key(df, *_KEYS).count() == 0
    assert total_per_key_sorted(df, *_KEYS).count() == 0
    assert windows_per_key(df, "source_id").count() == 0
    assert top_key(df, *_KEYS).count() == 0
    bars, status = bars_or_status(df, *_KEYS)
    assert bars.count() == 0
    assert tuple(status.first()) == (True, NO_DATA)
    assert tuple(data_status(counts(spark, ("a", 1))).first()) == (False, "ok")


@pytest.mark.parametrize("merge_small", ["true", "false"])
def test_rank_is_the_place_in_the_whole_order(spark, merge_small):
    # A third of the rows share one value; ranks must still be 1..n without gaps,
    # whether or not the sort ends up in one partition.
    rng = random.Random(3)
    rows = [(f"k{i:05d}", 7 if i % 3 == 0 else rng.randrange(1000)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "key string, n int").repartition(13)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, merge_small)
    try:
        ranked = with_rank(df, [F.desc("n"), F.col("key")])
    finally:
        spark.conf.unset(setting)
    expected = {key: place for place, (key, _) in
                enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), start=1)}
    assert {r.key: r["rank"] for r in ranked.collect()} == expected


def test_first_rows(spark):
    df = counts(spark, *[(f"s{i}", i) for i in range(9, 0, -1)])
    assert [r.source_id for r in first_rows(df, "source_id").collect()] == [
        "s1", "s2", "s3", "s4", "s5"]


def test_documents(spark):
    df = spark.createDataFrame([("cnn", 7)], "source_id string, article_count long")
    (row,) = key_documents(df, *_KEYS).collect()
    assert row.page_content == "Source: cnn, Number of articles: 7"
    assert row.metadata == {"source": "cnn"}
    people = spark.createDataFrame([("Ann", 2)], "author string, article_count_by_author long")
    (row,) = key_documents(people, "author", "article_count_by_author").collect()
    assert row.page_content == "Author: Ann, Number of articles: 2"
    assert row.metadata == {"author": "Ann"}
