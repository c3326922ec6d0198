"""Counting per time window and key, the same for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.functions.event_time import without_zone

# Fixed values.
WINDOW_LENGTH = "5 minutes"
WATERMARK_DELAY = "10 minutes"


def windowed_count(
    articles: DataFrame,
    key: str,
    count_name: str,
    *,
    event_time: str = "publishedAt",
    length: str = WINDOW_LENGTH,
    delay: str = WATERMARK_DELAY,
    window_first: bool = True,
) -> DataFrame:
    """Rows per (tumbling window, key).

    A null key is a group of its own; a null event time belongs to no window. In
    a batch the watermark does nothing. In a stream it drops late rows and decides
    when a window is final. Map-side partial counts mean the shuffle carries one
    row per task and group, so a key holding most of the rows costs no more than
    any other.
    """
    window = F.window(event_time, length)
    groups = [window, F.col(key)] if window_first else [F.col(key), window]
    return (
        articles.withWatermark(event_time, delay)
        .groupBy(*groups)
        .agg(F.count("*").alias(count_name))
    )


def count_by_source(articles: DataFrame, **options) -> DataFrame:
    return windowed_count(articles, "source_id", "article_count", **options)


def count_by_author(articles: DataFrame, **options) -> DataFrame:
    return windowed_count(articles, "author", "article_count_by_author",
                          window_first=False, **options)


def with_window_bounds(counts: DataFrame) -> DataFrame:
    """``window_start`` and ``window_end`` (zoneless) in place of the struct."""
    rest = [name for name in counts.columns if name != "window"]
    return counts.select(
        without_zone("window.start").alias("window_start"),
        without_zone("window.end").alias("window_end"),
        *rest,
    )
