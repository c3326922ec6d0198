"""Windowed counts and the questions asked of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.inputs import COUNTS, messages
from tallywire.operators.documents import key_documents
from tallywire.operators.rollups import (
    chart_data, data_status, first_rows, top_key, total_per_key, total_per_key_sorted,
    windows_per_key,
)
from tallywire.operators.windowed import with_window_bounds
from tallywire.plans.counting import author_counts, source_counts

_SOURCE = ("source_id", "article_count")
_AUTHOR = ("author", "article_count_by_author")


def _totals(table: str, key: str, count: str) -> str:
    return (f"totals AS (SELECT {key}, CAST(sum({count}) AS BIGINT) AS {count} "
            f"FROM {table} WHERE {key} IS NOT NULL GROUP BY {key})")


_SOURCE_TOTALS = f"{COUNTS}, {_totals('by_source', *_SOURCE)}"
_AUTHOR_TOTALS = f"{COUNTS}, {_totals('by_author', *_AUTHOR)}"


@query("windowed_count_by_source", f"""
WITH {COUNTS} SELECT window_start, window_end, source_id, article_count FROM by_source""")
def windowed_count_by_source(spark, sf):
    return with_window_bounds(source_counts(messages(spark, sf)))


@query("windowed_count_by_author", f"""
WITH {COUNTS} SELECT author, window_start, window_end, article_count_by_author FROM by_author""")
def _(spark, sf):
    return with_window_bounds(author_counts(messages(spark, sf)))


@query("total_by_source", f"WITH {_SOURCE_TOTALS} SELECT source_id, article_count FROM totals")
def _(spark, sf):
    return total_per_key(source_counts(messages(spark, sf)), *_SOURCE)


@query("total_by_author", f"WITH {_AUTHOR_TOTALS} SELECT author, article_count_by_author FROM totals")
def _(spark, sf):
    return total_per_key(author_counts(messages(spark, sf)), *_AUTHOR)


@query("total_by_source_sorted", f"""
WITH {_SOURCE_TOTALS}
SELECT source_id, article_count, row_number() OVER (ORDER BY source_id) AS position FROM totals""")
def _(spark, sf):
    return total_per_key_sorted(source_counts(messages(spark, sf)), *_SOURCE)


@query("total_by_author_sorted", f"""
WITH {_AUTHOR_TOTALS}
SELECT author, article_count_by_author, row_number() OVER (ORDER BY author) AS position
FROM totals""")
def _(spark, sf):
    return total_per_key_sorted(author_counts(messages(spark, sf)), *_AUTHOR)


def _windows_sql(table: str, key: str) -> str:
    return f"""
WITH {COUNTS}, bars AS (
  SELECT {key}, count(*) AS n_windows FROM {table} WHERE {key} IS NOT NULL GROUP BY {key})
SELECT {key}, n_windows, row_number() OVER (ORDER BY n_windows DESC, {key}) AS rank FROM bars"""


@query("windows_per_source", _windows_sql("by_source", "source_id"))
def _(spark, sf):
    return windows_per_key(source_counts(messages(spark, sf)), "source_id")


@query("windows_per_author", _windows_sql("by_author", "author"))
def _(spark, sf):
    return windows_per_key(author_counts(messages(spark, sf)), "author")


@query("top_source", f"""
WITH {_SOURCE_TOTALS}
SELECT source_id, article_count FROM totals ORDER BY article_count DESC, source_id LIMIT 1""")
def _(spark, sf):
    return top_key(source_counts(messages(spark, sf)), *_SOURCE)


@query("top_author", f"""
WITH {_AUTHOR_TOTALS}
SELECT author, article_count_by_author FROM totals
ORDER BY article_count_by_author DESC, author LIMIT 1""")
def _(spark, sf):
    return top_key(author_counts(messages(spark, sf)), *_AUTHOR)


@query("preview_head", f"""
WITH {COUNTS}
SELECT author, window_start, window_end, article_count_by_author FROM by_author
ORDER BY author NULLS FIRST, window_start LIMIT 5""")
def _(spark, sf):
    counts = with_window_bounds(author_counts(messages(spark, sf)))
    return first_rows(counts, "author", "window_start")


@query("no_data_status", f"""
WITH {COUNTS}, views AS (
  SELECT 'all windows' AS shown, count(*) AS n FROM by_source
  UNION ALL SELECT 'windows without articles', count(*) FROM by_source WHERE article_count = 0)
SELECT shown, n = 0 AS is_empty,
       CASE WHEN n = 0 THEN 'No data available' ELSE 'ok' END AS status FROM views""")
def _(spark, sf):
    counts = source_counts(messages(spark, sf))
    views = {"all windows": counts, "windows without articles": counts.where("article_count = 0")}
    status = [data_status(view).select(F.lit(name).alias("shown"), "is_empty", "status")
              for name, view in views.items()]
    return status[0].unionByName(status[1])


@query("chart_data", f"""
WITH {COUNTS}, bars AS (
  SELECT source_id, count(*) AS height, CAST(sum(article_count) AS BIGINT) AS articles
  FROM by_source WHERE source_id IS NOT NULL GROUP BY source_id)
SELECT source_id, height, articles, height AS label,
       row_number() OVER (ORDER BY height DESC, source_id) AS rank FROM bars""")
def _(spark, sf):
    return chart_data(source_counts(messages(spark, sf)), *_SOURCE)


@query("chart_data_by_author", f"""
WITH {COUNTS}, bars AS (
  SELECT author, count(*) AS height, CAST(sum(article_count_by_author) AS BIGINT) AS articles
  FROM by_author WHERE author IS NOT NULL GROUP BY author)
SELECT author, height, articles, height AS label,
       row_number() OVER (ORDER BY height DESC, author) AS rank FROM bars""")
def _(spark, sf):
    return chart_data(author_counts(messages(spark, sf)), *_AUTHOR)


@query("source_documents", f"""
WITH {_SOURCE_TOTALS}
SELECT source_id AS source,
  'Source: ' || source_id || ', Number of articles: ' || CAST(article_count AS VARCHAR)
    AS page_content FROM totals""")
def _(spark, sf):
    totals = total_per_key(source_counts(messages(spark, sf)), *_SOURCE)
    return key_documents(totals, *_SOURCE).select(
        F.col("metadata")["source"].alias("source"), "page_content"
    )


@query("author_documents", f"""
WITH {_AUTHOR_TOTALS}
SELECT author, 'Author: ' || author || ', Number of articles: '
  || CAST(article_count_by_author AS VARCHAR) AS page_content FROM totals""")
def _(spark, sf):
    totals = total_per_key(author_counts(messages(spark, sf)), *_AUTHOR)
    return key_documents(totals, *_AUTHOR).select(
        F.col("metadata")["author"].alias("author"), "page_content"
    )


@query("document_metadata", f"""
WITH {_SOURCE_TOTALS}, authors AS (SELECT DISTINCT author FROM by_author WHERE author IS NOT NULL)
SELECT 'source' AS name, source_id AS value FROM totals
UNION ALL SELECT 'author', author FROM authors""")
def _(spark, sf):
    sent = messages(spark, sf)
    documents = key_documents(total_per_key(source_counts(sent), *_SOURCE), *_SOURCE).unionByName(
        key_documents(total_per_key(author_counts(sent), *_AUTHOR), *_AUTHOR))
    return documents.select(F.explode("metadata").alias("name", "value"))
