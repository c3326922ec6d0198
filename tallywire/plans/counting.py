"""Messages to windowed counts, batch or stream alike."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallywire.functions.json_codec import decode_messages
from tallywire.operators.clean import flatten_article, with_event_time
from tallywire.operators.windowed import count_by_author, count_by_source
from tallywire.schemas import article_fields


def articles_from_messages(messages: DataFrame) -> DataFrame:
    """The nine flat fields, the published time still text."""
    return flatten_article(decode_messages(messages))


def source_counts(messages: DataFrame, **options) -> DataFrame:
    """Counts per window and source; only the two fields involved are decoded."""
    decoded = decode_messages(messages, article_fields("publishedAt", "source"))
    return count_by_source(with_event_time(flatten_article(decoded)), **options)


def author_counts(messages: DataFrame, **options) -> DataFrame:
    decoded = decode_messages(messages, article_fields("author", "publishedAt"))
    return count_by_author(with_event_time(decoded), **options)
