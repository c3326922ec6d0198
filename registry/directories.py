"""Reading result directories back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from registry import query
from registry.inputs import COUNTS, messages, written
from tallywire.operators.windowed import with_window_bounds
from tallywire.plans.compaction import compact
from tallywire.plans.counting import author_counts, source_counts
from tallywire.plans.totals import DayTotals
from tallywire.schemas import AUTHOR_COUNTS, SOURCE_COUNTS
from tallywire.sources.directories import json_directory, json_rejects, parquet_directory
from tallywire.storage import scratch_path

_BY_AUTHOR = f"""
WITH {COUNTS} SELECT author, window_start, window_end, article_count_by_author FROM by_author"""


@query("parquet_dir_scan", f"""
WITH {COUNTS} SELECT window_start, window_end, source_id, article_count FROM by_source""")
def _(spark, sf):
    path = written(source_counts(messages(spark, sf)), "parquet-sink")
    return with_window_bounds(parquet_directory(spark, path, SOURCE_COUNTS))


@query("compacted_sink", f"""
WITH {COUNTS} SELECT window_start, window_end, source_id, article_count FROM by_source""")
def _(spark, sf):
    # A second run replaces the days it finds.
    path, days = written(source_counts(messages(spark, sf)), "parquet-sink"), scratch_path(spark, "days")
    for _ in range(2):
        compact(parquet_directory(spark, path, SOURCE_COUNTS), days)
    return with_window_bounds(parquet_directory(spark, days, SOURCE_COUNTS))


@query("json_dir_scan", _BY_AUTHOR)
def _(spark, sf):
    path = written(author_counts(messages(spark, sf)), "json-sink", "json")
    return with_window_bounds(json_directory(spark, path, AUTHOR_COUNTS))


@query("suffix_filter_scan", _BY_AUTHOR)
def _(spark, sf):
    # The same rows lie beside the JSON files in files of another suffix.
    counts = author_counts(messages(spark, sf))
    path = written(counts, "mixed-sink", "json")
    counts.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(path)
    return with_window_bounds(json_directory(spark, path, AUTHOR_COUNTS))


@query("json_skip_malformed", f"{_BY_AUTHOR} WHERE minute(window_start) % 15 <> 5")
def _(spark, sf):
    line = F.to_json(F.struct("author", "window", "article_count_by_author"))
    cut = line.substr(F.lit(1), F.length(line) - 3)
    lines = author_counts(messages(spark, sf)).select(
        F.when(F.minute("window.start") % 15 == 5, cut).otherwise(line).alias("value")
    )
    path = written(lines, "damaged-sink", "text")
    return with_window_bounds(json_directory(spark, path, AUTHOR_COUNTS, pattern="*.txt"))


@query("json_reject_kinds", f"""
WITH {COUNTS}, kinds AS (SELECT CASE minute(window_start) % 20 WHEN 5 THEN 'no json' WHEN 10 THEN 'no object'
    WHEN 15 THEN 'other type' END AS reject FROM by_author)
SELECT reject, count(*) AS n_lines, true AS has_place FROM kinds WHERE reject IS NOT NULL GROUP BY reject""")
def _(spark, sf):
    line = F.to_json(F.struct("author", "window", "article_count_by_author"))
    minute = F.minute("window.start") % 20
    lines = author_counts(messages(spark, sf)).select(
        F.when(minute == 5, line.substr(F.lit(1), F.length(line) - 3))
        .when(minute == 10, F.concat(F.lit("["), line, F.lit("]")))
        .when(minute == 15, F.to_json(F.struct("author", F.lit("noon").alias("window"))))
        .otherwise(line).alias("value"))
    path = written(lines, "damaged-sink", "text")
    rejects = json_rejects(spark, path, AUTHOR_COUNTS, "*.txt")
    placed = F.col("file").contains(path.rsplit("/", 1)[1]) & (F.length("line") > 0)
    return rejects.groupBy("reject").agg(F.count("*").alias("n_lines"), F.bool_and(placed).alias("has_place"))


@query("running_totals", f"""
WITH {COUNTS} SELECT source_id, CAST(sum(article_count) AS BIGINT) AS article_count FROM by_source
WHERE source_id IS NOT NULL GROUP BY source_id""")
def _(spark, sf):
    # A sink by day that grows by a part of its windows; the second refresh reads the days it grew in.
    counts, days = source_counts(messages(spark, sf)), scratch_path(spark, "days")
    kept = DayTotals(spark, days, scratch_path(spark, "totals"), SOURCE_COUNTS, "source_id", "article_count")
    late = (F.dayofmonth("window.start") % 10 == 3) & (F.hour("window.start") >= 12)
    for part in (counts.where(~late), counts.where(late)):
        part.withColumn("day", F.to_date("window.start")).write.mode("append").partitionBy("day").parquet(days)
        kept.refresh()
    return kept.totals()


@query("json_mixed_types", f"""
WITH {COUNTS}, kept AS (
  SELECT * FROM by_author WHERE minute(window_start) % 15 = 0 AND author IS NOT NULL)
SELECT count(*) AS n_lines, CAST(sum(article_count_by_author) AS BIGINT) AS n_articles,
  count(DISTINCT window_start) AS n_windows, count(DISTINCT author) AS n_authors FROM kept""")
def _(spark, sf):
    # Some lines have a text for the count, some for the window; each figure needs other columns.
    counts = author_counts(messages(spark, sf)).where("author is not null")
    minute = F.minute("window.start") % 15
    text = F.to_json(F.struct("author", "window", F.lit("many").alias("article_count_by_author")))
    flat = F.to_json(F.struct("author", F.lit("noon").alias("window"), "article_count_by_author"))
    lines = counts.select(F.when(minute == 5, text).when(minute == 10, flat).otherwise(
        F.to_json(F.struct("author", "window", "article_count_by_author"))).alias("value"))
    path = written(lines, "mixed-types", "text")

    def read():
        return json_directory(spark, path, AUTHOR_COUNTS, pattern="*.txt")

    # Each figure from a read of its own, in one row.
    figures = {"n_lines": F.count("*"), "n_articles": F.sum("article_count_by_author"),
               "n_windows": F.count_distinct("window.start"), "n_authors": F.count_distinct("author")}
    rows = [read().agg(figure.alias(name)) for name, figure in figures.items()]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return every.agg(*(F.max(name).alias(name) for name in figures))
