"""Declared schemas. Every field is nullable; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


SOURCE = T.StructType(_strings("id", "name"))

# The message's field names, in the order they are published.
ARTICLE = T.StructType(
    _strings("author", "content", "description", "publishedAt")
    + [T.StructField("source", SOURCE)]
    + _strings("title", "url", "urlToImage")
)

POLL_RESPONSE = T.StructType([T.StructField("articles", T.ArrayType(ARTICLE))])

MESSAGE = T.StructType([T.StructField("value", T.BinaryType())])

WINDOW = T.StructType(
    [T.StructField("start", T.TimestampType()), T.StructField("end", T.TimestampType())]
)

SOURCE_COUNTS = T.StructType(
    [
        T.StructField("window", WINDOW),
        T.StructField("source_id", T.StringType()),
        T.StructField("article_count", T.LongType()),
    ]
)

AUTHOR_COUNTS = T.StructType(
    [
        T.StructField("author", T.StringType()),
        T.StructField("window", WINDOW),
        T.StructField("article_count_by_author", T.LongType()),
    ]
)


def article_fields(*names: str) -> T.StructType:
    """The article schema cut down to ``names``, so a decode builds only those."""
    return T.StructType([ARTICLE[name] for name in names])
