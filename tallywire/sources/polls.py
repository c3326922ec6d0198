"""Responses of a polled article search, landed as text or fetched live."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from tallywire.commits import ArrowFolder
from tallywire.functions.json_codec import decode_poll_responses

# One response per line.
RESPONSE = "value string"


def landed_name(poll: int, source: str) -> str:
    """The file of one response; sources may have any characters."""
    return f"{poll:020d}-{source.encode().hex()}.json"


def poll_of(name: str) -> int:
    number = name.lstrip(".").split("-")[0]
    return int(number) if number.isdigit() else 1 << 62


def landed_responses(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return spark.readStream.options(**options).text(path)


def landed_articles(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """One row per article of the responses arriving in a folder."""
    return decode_poll_responses(landed_responses(spark, path, **options))


def poll_source(fetch: Callable[[str, str, str], dict], name: str = "article_poll") -> type:
    """A data source that asks a search service for articles.

    ``fetch(query, source, language)`` returns one response. Register the class with
    ``spark.dataSource.register`` and set the options ``q``, ``sources`` (comma
    separated) and ``language``: keyword, source list and language are applied by
    the service. Every source is fetched by a task of its own. Streamed, each
    trigger polls once more, so give it an interval; a service without a cursor
    resends what it sent before, and nothing here removes the repeats.

    The option ``landing`` names a folder that driver and executors share. A streamed poll
    then writes each response there, under its poll and source, before it passes it on; a
    batch that is run again finds what it read before and asks for nothing. Responses go
    when a later poll has been committed. Without it a batch run again polls again.
    """

    class Part(InputPartition):
        def __init__(self, source: str, poll: int | None = None):
            self.source, self.poll = source, poll

    def parts(options, poll: int | None = None) -> list:
        return [Part(s, poll) for s in options["sources"].split(",")]

    def fetched(options, part) -> str:
        response = fetch(options.get("q", ""), part.source, options.get("language", ""))
        return json.dumps(response, ensure_ascii=False)

    def rows(options, part) -> Iterator[tuple[str]]:
        landing = options.get("landing")
        if landing is None or part.poll is None:
            yield (fetched(options, part),)
            return
        folder, name = ArrowFolder(landing), landed_name(part.poll, part.source)
        if name not in folder.names():
            folder.write(name, fetched(options, part).encode())
        yield (folder.read(name).decode(),)

    class Batch(DataSourceReader):
        def __init__(self, options):
            self.options = options

        def partitions(self):
            return parts(self.options)

        def read(self, partition):
            return rows(self.options, partition)

    class Stream(DataSourceStreamReader):
        def __init__(self, options):
            self.options = options

        # A poll is known by its time, which also grows across restarts.
        def initialOffset(self):
            return {"polled_at_ms": 0}

        def latestOffset(self, start=None, limit=None):
            return {"polled_at_ms": time.time_ns() // 1_000_000}

        def partitions(self, start, end):
            return parts(self.options, end["polled_at_ms"])

        def read(self, partition):
            return rows(self.options, partition)

        def commit(self, end):
            if "landing" in self.options:
                folder = ArrowFolder(self.options["landing"])
                for name in folder.names():
                    if poll_of(name) < end["polled_at_ms"]:
                        folder.remove(name)

    class PollSource(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return RESPONSE

        def reader(self, schema):
            return Batch(self.options)

        def streamReader(self, schema):
            return Stream(self.options)

    return PollSource
