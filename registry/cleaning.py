"""Decoding, cleaning, projecting."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.inputs import (
    CLEAN, COUNTS, FLAT_COLUMNS, JSON_TEXT, RAW, SOURCE_STRUCT, TYPED,
    clean_articles, messages, poll_responses, raw_articles, table,
)
from tallywire.functions.event_time import parse_published_at, without_zone
from tallywire.functions.json_codec import (
    as_json, decode_messages, decode_poll_responses, message_text, rejected_responses,
)
from tallywire.operators.clean import (
    drop_placeholders, equals, flatten_article, in_list, keyword_match, pack_source,
    project_fields, with_event_time,
)
from tallywire.operators.combine import concat_by_name, flatten_nested
from tallywire.operators.profile import profile_columns
from tallywire.operators.windowed import with_window_bounds
from tallywire.plans.counting import author_counts, source_counts
from tallywire.plans.ingest import messages_from_responses

@query("poll_rejects", f"""
SELECT count(*) FILTER (event_id // 500 % 7 <> 0) AS n_articles,
  count(DISTINCT event_id // 500) FILTER (event_id // 500 % 7 = 0) AS n_rejected FROM events""")
def _(spark, sf):
    responses = poll_responses(spark, sf, refused=7)
    articles = decode_poll_responses(responses).agg(F.count("*").alias("n_articles"))
    return articles.join(rejected_responses(responses).agg(F.count("*").alias("n_rejected")))


_DOCUMENT = ("doc_id", "lang", "source", "n_chars")


@query("keyword_match", """
SELECT doc_id, lang, source, n_chars FROM documents WHERE contains(lower(text), 'tion')""")
def _(spark, sf):
    return keyword_match(table(spark, sf, "documents"), "text", "Tion").select(*_DOCUMENT)


@query("source_in_list", """
SELECT doc_id, lang, source, n_chars FROM documents WHERE source IN ('src1', 'src4', 'src19')""")
def _(spark, sf):
    return in_list(table(spark, sf, "documents"), "source", "src1,src4,src19").select(*_DOCUMENT)


@query("language_eq", """
SELECT doc_id, lang, source, n_chars FROM documents WHERE lang = 'en'""")
def _(spark, sf):
    return equals(table(spark, sf, "documents"), "lang", "en").select(*_DOCUMENT)


@query("drop_removed", f"WITH {CLEAN} SELECT event_id, {FLAT_COLUMNS} FROM clean")
def _(spark, sf):
    return flatten_article(drop_placeholders(raw_articles(spark, sf)), keep=("event_id",))


@query("project_fields", f"""
WITH {RAW} SELECT author, content, description, "publishedAt",
  CAST(to_json({SOURCE_STRUCT}) AS VARCHAR) AS source, title, url, "urlToImage" FROM raw""")
def _(spark, sf):
    projected = project_fields(raw_articles(spark, sf))
    return projected.withColumn("source", as_json("source.id", "source.name"))


@query("pack_source", f"""
WITH {RAW} SELECT event_id, source_id AS id, source_name AS name FROM raw""")
def _(spark, sf):
    flat = flatten_article(raw_articles(spark, sf), keep=("event_id",))
    return flat.select("event_id", pack_source("source_id", "source_name").alias("source")).select(
        "event_id", "source.id", "source.name"
    )


@query("publish_json", f"""
WITH {CLEAN}, encoded AS (SELECT {JSON_TEXT} AS value FROM clean)
SELECT value, CAST(strlen(value) AS INTEGER) AS n_bytes FROM encoded""")
def _(spark, sf):
    published = messages_from_responses(poll_responses(spark, sf))
    return published.select(message_text().alias("value"),
                            F.octet_length("value").alias("n_bytes"))


@query("decode_value", f"WITH {CLEAN} SELECT event_id, {JSON_TEXT} AS value FROM clean")
def _(spark, sf):
    return messages(spark, sf, keep=("event_id",)).select(
        "event_id", message_text().alias("value")
    )


@query("expand_struct", f"""
WITH {CLEAN} SELECT author, content, description, "publishedAt",
  CAST(to_json({SOURCE_STRUCT}) AS VARCHAR) AS source, title, url, "urlToImage" FROM clean""")
def _(spark, sf):
    decoded = decode_messages(messages(spark, sf))
    return decoded.withColumn("source", as_json("source.id", "source.name"))


@query("flatten_article", f"WITH {CLEAN} SELECT {FLAT_COLUMNS} FROM clean")
def _(spark, sf):
    return flatten_article(decode_messages(messages(spark, sf)))


@query("json_roundtrip", f"WITH {CLEAN} SELECT event_id, {FLAT_COLUMNS} FROM clean")
def _(spark, sf):
    decoded = decode_messages(messages(spark, sf, keep=("event_id",)), keep=("event_id",))
    return flatten_article(decoded, keep=("event_id",))


@query("missing_field_null", f"WITH {RAW} SELECT event_id, {FLAT_COLUMNS} FROM raw")
def _(spark, sf):
    # Null fields are left out of the text, so they are absent when it is read.
    articles = raw_articles(spark, sf)
    fields = [name for name in articles.columns if name != "event_id"]
    sparse = articles.select("event_id", F.to_json(F.struct(*fields)).alias("value"))
    return flatten_article(decode_messages(sparse, keep=("event_id",)), keep=("event_id",))


_BROKEN = "event_id % 13 IN (1, 2, 3, 4, 5, 7)"


@query("json_decode", f"""
WITH {RAW}
SELECT event_id,
  CASE WHEN {_BROKEN} THEN NULL WHEN event_id % 13 = 6 THEN CAST(event_id AS VARCHAR)
       ELSE author END AS author,
  {", ".join(f'CASE WHEN {_BROKEN} OR event_id % 13 = 6 THEN NULL ELSE {c} END AS {c}'
             for c in FLAT_COLUMNS.split(", ")[1:])}
FROM raw""")
def _(spark, sf):
    # A share of the messages is damaged, each kind in its own way.
    articles = raw_articles(spark, sf)
    fields = [name for name in articles.columns if name != "event_id"]
    text, kind = F.col("text"), F.col("event_id") % 13
    damaged = articles.select("event_id", as_json(*fields).alias("text")).select(
        "event_id",
        F.when(kind == 1, "not json")
        .when(kind == 2, text.substr(F.lit(1), F.length(text) - 5))
        .when(kind == 3, F.concat(F.lit("["), text, F.lit(","), text, F.lit("]")))
        .when(kind == 4, "")
        .when(kind == 5, None)
        .when(kind == 6, F.concat(F.lit('{"author":'), F.col("event_id").cast("string"),
                                  F.lit(',"source":"cnn"}')))
        .when(kind == 7, '{"Author":"A"}')
        .otherwise(text).alias("value"),
    )
    return flatten_article(decode_messages(damaged, keep=("event_id",)), keep=("event_id",))


@query("parse_published_at", """
SELECT event_id, CASE WHEN event_id % 11 IN (1, 2, 3, 4, 5) THEN NULL
                      ELSE date_trunc('second', ts) END AS published_at FROM events""")
def _(spark, sf):
    ts, kind = F.col("ts"), F.col("event_id") % 11
    text = (
        F.when(kind == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(kind == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+05:45'"))
        .when(kind == 3, "[Removed]")
        .when(kind == 4, "")
        .when(kind == 5, F.date_format(ts, "yyyy-'02-30T'HH:mm:ss'Z'"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )
    return table(spark, sf, "events").select(
        "event_id", without_zone(parse_published_at(text)).alias("published_at")
    )


@query("with_event_time", f"""
WITH {TYPED} SELECT author, content, description, ts AS "publishedAt", source_id, source_name,
  title, url, "urlToImage" FROM typed""")
def _(spark, sf):
    timed = with_event_time(flatten_article(decode_messages(messages(spark, sf))))
    return timed.withColumn("publishedAt", without_zone("publishedAt"))


@query("normalize_nested", f"""
WITH {COUNTS} SELECT author, window_start, window_end, article_count_by_author FROM by_author""")
def _(spark, sf):
    flat = flatten_nested(author_counts(messages(spark, sf)), separator="_")
    return flat.withColumns({c: without_zone(c) for c in ("window_start", "window_end")})


@query("concat_by_name", f"""
WITH {COUNTS}
SELECT window_start, window_end, source_id, article_count,
       CAST(NULL AS VARCHAR) AS author, CAST(NULL AS BIGINT) AS article_count_by_author
FROM by_source
UNION ALL
SELECT window_start, window_end, NULL, NULL, author, article_count_by_author FROM by_author""")
def _(spark, sf):
    sent = messages(spark, sf)
    return concat_by_name(with_window_bounds(source_counts(sent)),
                          with_window_bounds(author_counts(sent)))


_PROFILED = [(name, "timestamp" if name == "publishedAt" else "string")
             for name in FLAT_COLUMNS.replace('"', "").split(", ")]


@query("profile_columns", f"WITH {TYPED}, shown AS (SELECT * REPLACE (ts AS \"publishedAt\") FROM typed)\n"
       + "\nUNION ALL\n".join(
           f"SELECT CAST({i} AS INTEGER) AS position, '{name}' AS column_name, '{kind}' AS data_type, "
           f"count(*) AS n_rows, count(\"{name}\") AS non_null FROM shown"
           for i, (name, kind) in enumerate(_PROFILED)))
def _(spark, sf):
    return profile_columns(with_event_time(flatten_article(
        clean_articles(spark, sf).drop("event_id"))))
