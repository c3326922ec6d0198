"""The streaming operators, each run to the end of its input.

Wherever a result depends on what arrives first, the input arrives in waves: one
part of the table is landed and processed, then the next, from one checkpoint.
Within a wave any number of files and tasks take part.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from registry import query
from registry.inputs import (
    CLEAN, CLOSED, COUNTS, FLAT_COLUMNS, JSON_TEXT, RAW, TYPED,
    clean_articles, counted, messages, poll_responses, written,
)
from tallywire.functions.event_time import PUBLISHED_AT_FORMAT, parse_published_at
from tallywire.functions.json_codec import encode_articles, message_text
from tallywire.operators.clean import flatten_article
from tallywire.operators.windowed import with_window_bounds
from tallywire.plans.counting import author_counts, source_counts
from tallywire.schemas import ARTICLE, AUTHOR_COUNTS, SOURCE_COUNTS
from tallywire.session import stateful
from tallywire.sources.directories import day_rows, json_directory, parquet_directory
from tallywire.sources.messages import land_messages, landed_messages
from tallywire.sources.polls import landed_articles
from tallywire.storage import materialize, scratch_path
from tallywire.streaming.fanout import CommittedBatches, directory_target, fan_out
from tallywire.streaming.late import LateRows, late_messages
from tallywire.streaming.publish import committed_messages, committed_sink
from tallywire.streaming.refresh import delta_sink, latest_snapshot, running_counts
from tallywire.streaming.sinks import json_sink, parquet_sink, run_available
from tallywire.streaming.state import whole_counts

_CLOSED_BY_SOURCE = f"""
WITH {COUNTS}
SELECT window_start, window_end, source_id, article_count FROM by_source WHERE {CLOSED}"""
_CLOSED_BY_AUTHOR = f"""
WITH {COUNTS}
SELECT author, window_start, window_end, article_count_by_author FROM by_author WHERE {CLOSED}"""


def _run(spark: SparkSession, writer: DataStreamWriter) -> None:
    with stateful(spark):
        run_available(writer)


def _landed(spark: SparkSession, sf: str) -> DataFrame:
    path = land_messages(messages(spark, sf), scratch_path(spark, "landing"))
    return landed_messages(spark, path)


def _waves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Messages of the first and of the second half of the covered time."""
    articles = clean_articles(spark, sf).withColumn(
        "_second", F.unix_seconds(parse_published_at("publishedAt"))
    )
    span = articles.agg(F.min("_second"), F.max("_second")).first()
    middle = (span[0] + span[1]) // 2
    later = F.coalesce(F.col("_second") >= middle, F.lit(True))
    return encode_articles(articles.where(~later)), encode_articles(articles.where(later))


_MIDDLE = ("(SELECT make_timestamp(((epoch_us(min(ts)) + epoch_us(max(ts))) "
           "// 2000000) * 1000000) FROM typed)")


@query("poll_explode", f"WITH {RAW} SELECT {FLAT_COLUMNS} FROM raw")
def _(spark, sf):
    landing = written(poll_responses(spark, sf), "responses", "text")
    path, checkpoint = scratch_path(spark, "articles"), scratch_path(spark, "checkpoint")
    _run(spark, parquet_sink(landed_articles(spark, landing), path, checkpoint))
    return flatten_article(parquet_directory(spark, path, ARTICLE))


@query("stream_scan", f"WITH {CLEAN} SELECT {JSON_TEXT} AS value FROM clean")
def _(spark, sf):
    path, checkpoint = scratch_path(spark, "values"), scratch_path(spark, "checkpoint")
    values = _landed(spark, sf).select(message_text().alias("value"))
    _run(spark, parquet_sink(values, path, checkpoint))
    return parquet_directory(spark, path, T.StructType().add("value", T.StringType()))


@query("open_windows", f"""
WITH {COUNTS} SELECT window_start, window_end, source_id, article_count, NOT ({CLOSED}) AS is_open
FROM by_source""")
def _(spark, sf):
    # Written windows and those held back are together what a batch counts.
    path, checkpoint = scratch_path(spark, "by-source"), scratch_path(spark, "checkpoint")
    _run(spark, parquet_sink(source_counts(_landed(spark, sf)), path, checkpoint))
    written = parquet_directory(spark, path, SOURCE_COUNTS)
    return with_window_bounds(whole_counts(spark, written, checkpoint, SOURCE_COUNTS))


_SECOND_DAY = "(SELECT CAST(min(ts) AS DATE) + 1 FROM typed)"


@query("stream_sink_by_day", f"""
WITH {COUNTS} SELECT author, window_start, window_end, article_count_by_author FROM by_author
WHERE {CLOSED} AND CAST(window_start AS DATE) = {_SECOND_DAY}""")
def _(spark, sf):
    path, checkpoint = scratch_path(spark, "by-author"), scratch_path(spark, "checkpoint")
    _run(spark, json_sink(author_counts(_landed(spark, sf)), path, checkpoint, by_day=True))
    first = clean_articles(spark, sf).agg(F.min(F.to_date(parse_published_at("publishedAt")))).first()[0]
    day = str(first + timedelta(days=1))
    return with_window_bounds(day_rows(spark, path, AUTHOR_COUNTS, [day], "json").drop("day"))


@query("publish_committed", f"WITH {CLEAN} SELECT {JSON_TEXT} AS value FROM clean")
def _(spark, sf):
    # The first run fails in one of its tasks after others have written; the second is whole.
    landing, topic = scratch_path(spark, "landing"), scratch_path(spark, "topic")
    checkpoint = scratch_path(spark, "checkpoint")
    land_messages(messages(spark, sf).repartition(4), landing)
    stream = landed_messages(spark, landing)
    failed = F.raise_error(F.lit("a task attempt that fails on purpose")).cast("binary")
    broken = stream.select(F.when(F.spark_partition_id() == 0, failed).otherwise(F.col("value")).alias("value"))
    try:
        _run(spark, committed_sink(broken, topic, checkpoint))
    except StreamingQueryException:
        _run(spark, committed_sink(stream, topic, checkpoint))
    return committed_messages(spark, topic).select(message_text().alias("value"))


@query("stream_windowed_source", _CLOSED_BY_SOURCE)
def stream_windowed_source(spark, sf):
    path, checkpoint = scratch_path(spark, "by-source"), scratch_path(spark, "checkpoint")
    batches = directory_target(path)
    _run(spark, fan_out(source_counts(_landed(spark, sf)), [batches], checkpoint))
    return with_window_bounds(parquet_directory(spark, path, SOURCE_COUNTS))


@query("stream_windowed_author", _CLOSED_BY_AUTHOR)
def _(spark, sf):
    path, checkpoint = scratch_path(spark, "by-author"), scratch_path(spark, "checkpoint")
    batches = directory_target(path)
    _run(spark, fan_out(author_counts(_landed(spark, sf)), [batches], checkpoint))
    return with_window_bounds(parquet_directory(spark, path, AUTHOR_COUNTS))


@query("stream_parquet_sink", _CLOSED_BY_SOURCE)
def _(spark, sf):
    path, checkpoint = scratch_path(spark, "by-source"), scratch_path(spark, "checkpoint")
    _run(spark, parquet_sink(source_counts(_landed(spark, sf)), path, checkpoint))
    return with_window_bounds(parquet_directory(spark, path, SOURCE_COUNTS))


@query("stream_json_sink", _CLOSED_BY_AUTHOR)
def _(spark, sf):
    path, checkpoint = scratch_path(spark, "by-author"), scratch_path(spark, "checkpoint")
    _run(spark, json_sink(author_counts(_landed(spark, sf)), path, checkpoint))
    return with_window_bounds(json_directory(spark, path, AUTHOR_COUNTS))


def _run_waves(spark: SparkSession, waves: list[DataFrame | None]) -> DataFrame:
    """Counts by source after landing each wave and running again from the checkpoint."""
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "by-source")
    checkpoint = scratch_path(spark, "checkpoint")
    for wave in waves:
        if wave is not None:
            land_messages(wave, landing)
        counts = source_counts(landed_messages(spark, landing))
        _run(spark, parquet_sink(counts, path, checkpoint))
    return with_window_bounds(parquet_directory(spark, path, SOURCE_COUNTS))


@query("stream_restart_resume", _CLOSED_BY_SOURCE)
def _(spark, sf):
    # The last run finds nothing new and must not repeat anything.
    earlier, later = _waves(spark, sf)
    return _run_waves(spark, [earlier, later, None])


@query("late_rows_dropped", f"""
WITH {TYPED}, {counted(where=f"ts >= {_MIDDLE}")}
SELECT window_start, window_end, source_id, article_count FROM by_source WHERE {CLOSED}""")
def _(spark, sf):
    # The earlier half comes second: its windows were closed by the later half.
    earlier, later = _waves(spark, sf)
    return _run_waves(spark, [later, earlier])


@query("late_messages", f"""
WITH {TYPED} SELECT {FLAT_COLUMNS} FROM typed WHERE ts < {_MIDDLE}""")
def _(spark, sf):
    # The same two halves; what the count of the second dropped, message by message.
    earlier, later = _waves(spark, sf)
    kept, checkpoint = scratch_path(spark, "late"), scratch_path(spark, "checkpoint")
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "by-source")
    for wave in (later, earlier):
        land_messages(wave, landing)
        counts = source_counts(landed_messages(spark, landing))
        with stateful(spark):
            run_available(parquet_sink(counts, path, checkpoint), LateRows(spark, kept))
    found = late_messages(spark, kept, checkpoint).drop("batch", "limit")
    return found.withColumn("publishedAt", F.date_format("publishedAt", PUBLISHED_AT_FORMAT))


@query("stream_fanout", f"""
WITH {COUNTS}, closed AS (
  SELECT window_start, window_end, source_id, article_count FROM by_source WHERE {CLOSED})
SELECT 'parquet' AS target, * FROM closed UNION ALL SELECT 'json', * FROM closed""")
def _(spark, sf):
    # Deliveries that must not count: the first batch again, and one that was broken off.
    counts = source_counts(_landed(spark, sf))
    batches = CommittedBatches(spark, scratch_path(spark, "fan"), {"parquet": "parquet", "json": "json"})
    _run(spark, batches.writer(counts, scratch_path(spark, "checkpoint")))
    sides = {name: batches.read(name, SOURCE_COUNTS) for name in ("parquet", "json")}
    batches.deliver(sides["parquet"], 0)
    sides["parquet"].write.parquet(f"{batches.folders('parquet')[0]}-again")
    first, second = (
        with_window_bounds(batches.read(name, SOURCE_COUNTS)).select(F.lit(name).alias("target"), "*")
        for name in sides)
    return first.unionByName(second)


@query("refreshing_counts", f"""
WITH {COUNTS}
SELECT source_id, count(*) AS n_windows FROM by_source WHERE source_id IS NOT NULL
GROUP BY source_id""")
def _(spark, sf):
    # The sink grows between three refreshes; each reads what was added and writes what changed.
    sink, path = scratch_path(spark, "by-source"), scratch_path(spark, "refreshes")
    checkpoint = scratch_path(spark, "checkpoint")
    counts = materialize(source_counts(messages(spark, sf)), "counts")
    third = F.pmod(F.expr("unix_seconds(window.start) div 300"), F.lit(3))
    for part in range(3):
        counts.where(third == part).write.mode("append").parquet(sink)
        running = running_counts(spark, sink, SOURCE_COUNTS, "source_id")
        _run(spark, delta_sink(running, path, checkpoint))
    return latest_snapshot(spark, path, running.schema)
