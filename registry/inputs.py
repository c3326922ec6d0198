"""Articles derived from the ``events`` table, in Spark and in SQL.

The tables hold no nulls and no placeholders; both are put in here, because the
cleaning and counting rules differ exactly there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywire.functions.event_time import PUBLISHED_AT_FORMAT
from tallywire.functions.json_codec import encode_articles
from tallywire.operators.clean import drop_placeholders
from tallywire.schemas import ARTICLE
from tallywire.sources.tables import read_table
from tallywire.storage import scratch_path

ARTICLES_PER_RESPONSE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id`` and the eight article fields, before cleaning."""
    event, user = F.col("event_id"), F.col("user_id")
    return table(spark, sf_dir, "events").select(
        event,
        F.when(user % 17 == 0, None).when(user % 23 == 0, "[Removed]")
        .otherwise(F.concat(F.lit("author_"), user.cast("string"))).alias("author"),
        F.col("props").alias("content"),
        F.lit(None).cast("string").alias("description"),
        F.when(event % 31 == 0, None)
        .otherwise(F.date_format("ts", PUBLISHED_AT_FORMAT)).alias("publishedAt"),
        F.struct(F.nullif("event_type", F.lit("error")).alias("id"),
                 F.upper("event_type").alias("name")).alias("source"),
        F.when(event % 29 == 0, "[Removed]")
        .otherwise(F.concat(F.lit("title "), event.cast("string"))).alias("title"),
        F.concat(F.lit("http://example.com/"), event.cast("string")).alias("url"),
        F.lit(None).cast("string").alias("urlToImage"),
    )


def clean_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_placeholders(raw_articles(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    return encode_articles(clean_articles(spark, sf_dir), keep)


def poll_responses(spark: SparkSession, sf_dir: str, refused: int = 0) -> DataFrame:
    """Uncleaned articles as responses of at most 500 each, one JSON text per row.

    With ``refused``, every poll whose number it divides got an error instead.
    """
    articles = raw_articles(spark, sf_dir)
    grouped = articles.groupBy(
        F.expr(f"event_id div {ARTICLES_PER_RESPONSE}").alias("poll")
    ).agg(F.collect_list(F.struct(*ARTICLE.names)).alias("articles"))
    value = F.to_json(F.struct("articles"), {"ignoreNullFields": "false"})
    if refused:
        value = F.when(F.col("poll") % refused == 0, '{"status":"error","code":"rateLimited"}'
                       ).otherwise(value)
    return grouped.select(value.alias("value"))


def written(df: DataFrame, label: str, fmt: str = "parquet") -> str:
    """Put ``df`` in a directory of its own, as an earlier job would have."""
    path = scratch_path(df.sparkSession, label)
    df.write.format(fmt).save(path)
    return path


# --- the same in SQL -------------------------------------------------------------------

RAW = """raw AS (
  SELECT event_id,
    CASE WHEN user_id % 17 = 0 THEN NULL WHEN user_id % 23 = 0 THEN '[Removed]'
         ELSE 'author_' || CAST(user_id AS VARCHAR) END AS author,
    props AS content,
    CAST(NULL AS VARCHAR) AS description,
    CASE WHEN event_id % 31 = 0 THEN NULL
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS "publishedAt",
    nullif(event_type, 'error') AS source_id,
    upper(event_type) AS source_name,
    CASE WHEN event_id % 29 = 0 THEN '[Removed]'
         ELSE 'title ' || CAST(event_id AS VARCHAR) END AS title,
    'http://example.com/' || CAST(event_id AS VARCHAR) AS url,
    CAST(NULL AS VARCHAR) AS "urlToImage"
  FROM events)"""

CLEAN = RAW + """, clean AS (
  SELECT * FROM raw
  WHERE title IS DISTINCT FROM '[Removed]' AND author IS DISTINCT FROM '[Removed]'
    AND "publishedAt" IS DISTINCT FROM '[Removed]')"""

TYPED = CLEAN + """, typed AS (
  SELECT *, try_strptime("publishedAt", '%Y-%m-%dT%H:%M:%SZ') AS ts FROM clean)"""


def counted(rows: str = "typed", where: str = "ts IS NOT NULL") -> str:
    """``by_source`` and ``by_author``: counts per five minutes."""
    bucket = "time_bucket(INTERVAL '5 minutes', ts)"
    bounds = f"{bucket} AS window_start, {bucket} + INTERVAL '5 minutes' AS window_end"
    return f"""by_source AS (
  SELECT {bounds}, source_id, count(*) AS article_count FROM {rows} WHERE {where} GROUP BY ALL),
by_author AS (
  SELECT author, {bounds}, count(*) AS article_count_by_author
  FROM {rows} WHERE {where} GROUP BY ALL)"""


COUNTS = TYPED + ", " + counted()

# Windows the watermark has passed once every row has been seen.
CLOSED = "window_end <= (SELECT max(ts) - INTERVAL '10 minutes' FROM typed)"

SOURCE_STRUCT = "{'id': source_id, 'name': source_name}"
JSON_TEXT = f"""CAST(to_json({{'author': author, 'content': content,
  'description': description, 'publishedAt': "publishedAt", 'source': {SOURCE_STRUCT},
  'title': title, 'url': url, 'urlToImage': "urlToImage"}}) AS VARCHAR)"""

FLAT_COLUMNS = ('author, content, description, "publishedAt", source_id, source_name, '
                'title, url, "urlToImage"')
