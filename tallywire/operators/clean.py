"""Selecting and shaping articles. Every step is a narrow projection or filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.functions.event_time import parse_published_at
from tallywire.schemas import ARTICLE

# The marker left in withdrawn articles, and the fields it is looked for in.
PLACEHOLDER = "[Removed]"
PLACEHOLDER_FIELDS = ("title", "author", "publishedAt")


def keyword_match(df: DataFrame, text: str, keyword: str) -> DataFrame:
    return df.where(F.lower(F.col(text)).contains(keyword.lower()))


def in_list(df: DataFrame, column: str, listing: str) -> DataFrame:
    """Rows whose ``column`` is one of the comma-separated names."""
    return df.where(F.col(column).isin(*listing.split(",")))


def equals(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.where(F.col(column) == value)


def drop_placeholders(articles: DataFrame) -> DataFrame:
    """Drop withdrawn articles; a null field is not a placeholder, so it stays."""
    withdrawn = F.lit(False)
    for name in PLACEHOLDER_FIELDS:
        withdrawn = withdrawn | F.col(name).eqNullSafe(PLACEHOLDER)
    return articles.where(~withdrawn)


def pack_source(source_id: Column | str, source_name: Column | str) -> Column:
    def column(c: Column | str) -> Column:
        return F.col(c) if isinstance(c, str) else c

    return F.struct(column(source_id).alias("id"), column(source_name).alias("name"))


def project_fields(articles: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the published fields; an absent source becomes a struct of nulls."""
    fields = [
        pack_source(F.col("source.id"), F.col("source.name")).alias("source")
        if name == "source" else F.col(name)
        for name in ARTICLE.names
    ]
    return articles.select(*keep, *fields)


def flatten_article(articles: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Replace the ``source`` struct by ``source_id`` and ``source_name``."""
    columns: list[Column | str] = list(keep)
    for name in articles.columns:
        if name == "source":
            columns += [F.col("source.id").alias("source_id"),
                        F.col("source.name").alias("source_name")]
        elif name not in keep:
            columns.append(name)
    return articles.select(*columns)


def with_event_time(articles: DataFrame) -> DataFrame:
    return articles.withColumn("publishedAt", parse_published_at("publishedAt"))
