"""Polls to published messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tallywire.functions.json_codec import decode_poll_responses, encode_articles
from tallywire.operators.clean import drop_placeholders, project_fields
from tallywire.sources.polls import poll_source

# What is asked of the search service, and how often.
KEYWORD = "nepal"
NEWS_SOURCES = ("bbc-news,cnn,fox-news,nbc-news,the-guardian-uk,the-new-york-times,"
                "the-washington-post,usa-today,independent,daily-mail")
LANGUAGE = "en"
POLL_INTERVAL = "15 minutes"


def polled_responses(
    spark: SparkSession,
    fetch: Callable[[str, str, str], dict],
    keyword: str = KEYWORD,
    news_sources: str = NEWS_SOURCES,
    language: str = LANGUAGE,
    landing: str | None = None,
) -> DataFrame:
    """The responses of a search service as a stream, one poll per trigger.

    With ``landing``, a shared folder, a batch that is run again reads what it read before.
    """
    source = poll_source(fetch)
    spark.dataSource.register(source)
    stream = (
        spark.readStream.format(source.name())
        .option("q", keyword)
        .option("sources", news_sources)
        .option("language", language)
    )
    return (stream if landing is None else stream.option("landing", landing)).load()


def messages_from_responses(responses: DataFrame) -> DataFrame:
    """Explode, drop withdrawn articles, keep the published fields, encode."""
    articles = decode_poll_responses(responses)
    return encode_articles(project_fields(drop_placeholders(articles)))


def at_poll_interval(writer: DataStreamWriter, every: str = POLL_INTERVAL) -> DataStreamWriter:
    return writer.trigger(processingTime=every)
