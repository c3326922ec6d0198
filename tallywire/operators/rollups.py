"""Batch questions asked of the windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.operators.ranking import with_rank

# Fixed value: the message shown in place of a chart without data.
NO_DATA = "No data available"


def total_per_key(counts: DataFrame, key: str, count: str) -> DataFrame:
    """Articles per key over all windows; unlike in the stream, a null key is dropped."""
    return (
        counts.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(count).alias(count))
    )


def total_per_key_sorted(counts: DataFrame, key: str, count: str) -> DataFrame:
    return with_rank(total_per_key(counts, key, count), [F.col(key)], "position")


def windows_per_key(counts: DataFrame, key: str) -> DataFrame:
    """How many windows mention each key, most frequent first."""
    windows = (
        counts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_windows"))
    )
    return with_rank(windows, [F.desc("n_windows"), F.col(key)])


def top_key(counts: DataFrame, key: str, count: str) -> DataFrame:
    """The key with the most articles; of equals, the first by name."""
    return top_total(total_per_key(counts, key, count), key, count)


def top_total(totals: DataFrame, key: str, count: str) -> DataFrame:
    """Sort and limit together become one top-1 per task, merged on the way back."""
    return totals.orderBy(F.desc(count), F.col(key)).limit(1)


def chart_data(counts: DataFrame, key: str, count: str) -> DataFrame:
    """Bars of the dashboard: its height is the number of windows, as charted.

    The axis of such a chart is easily read as articles, so their number stands
    beside it.
    """
    bars = (
        counts.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("height"), F.sum(count).alias("articles"))
        .withColumn("label", F.col("height").cast("long"))
    )
    return with_rank(bars, [F.desc("height"), F.col(key)])


def first_rows(df: DataFrame, *order: str, n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def data_status(df: DataFrame) -> DataFrame:
    """One row: is there anything to show? Looks at no more than a row per task."""
    found = df.select(F.lit(1).alias("one")).limit(1).agg(F.count("*").alias("n"))
    return found.select(
        (F.col("n") == 0).alias("is_empty"),
        F.when(F.col("n") == 0, F.lit(NO_DATA)).otherwise(F.lit("ok")).alias("status"),
    )
