"""Vectors, neighbours, contexts."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query
from registry.inputs import COUNTS, messages, table, written
from registry.text_sql import bucketed, idf, split_words, weighted
from tallywire.operators.cells import CellIndex
from tallywire.operators.documents import stuff_context
from tallywire.operators.embed import embed_corpus
from tallywire.operators.nearest import nearest, vector_table
from tallywire.operators.rollups import total_per_key
from tallywire.plans.answers import QUESTIONS, answer, totals_store
from tallywire.plans.counting import author_counts, source_counts
from tallywire.plans.store import DocumentStore, attach_documents
from tallywire.storage import materialize, scratch_path

# The questions: the mean vector of every label.
_MEANS = """means AS (
  SELECT label, list(m ORDER BY i) AS embedding FROM (
    SELECT label, i, avg(x) AS m FROM (
      SELECT label, unnest(range(1, len(embedding) + 1)) AS i,
             CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
    GROUP BY label, i)
  GROUP BY label)"""

def _hits_sql(corpus: str) -> str:
    return f"""{_MEANS}, ranked AS (
  SELECT label, vec_id, distance,
         row_number() OVER (PARTITION BY label ORDER BY distance, vec_id) AS rank
  FROM (SELECT m.label, e.vec_id,
               round(list_distance(m.embedding, CAST(e.embedding AS DOUBLE[])), 6) AS distance
        FROM means m, {corpus} e)),
hits AS (SELECT * FROM ranked WHERE rank <= 4)"""


_HITS = _hits_sql("embeddings")
# The corpus with a NaN in some vectors and an infinity in others.
_DAMAGED = _hits_sql("""(SELECT vec_id, CASE
  WHEN vec_id % 97 = 0 THEN list_concat([CAST('nan' AS FLOAT)], embedding[2:])
  WHEN vec_id % 89 = 0 THEN list_concat([CAST('inf' AS FLOAT)], embedding[2:])
  ELSE embedding END AS embedding FROM embeddings)""")


def _label_means(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select(
        "label", array_to_vector("embedding").alias("vector")
    )
    means = vectors.groupBy("label").agg(Summarizer.mean(F.col("vector")).alias("mean"))
    return means.select("label", vector_to_array("mean").alias("embedding"))


def _hits(spark: SparkSession, sf: str, **options) -> DataFrame:
    return nearest(_label_means(spark, sf), table(spark, sf, "embeddings"),
                   question_id="label", corpus_id="vec_id", **options)


def _answer_sql(p: str, key: str, title: str, table: str, count: str,
                asked: str | None = None) -> str:
    """CTEs, prefixed with ``p``, ending in the context for the question ``asked``, or ``key``'s."""
    asked = asked or key
    documents_counts = f"(SELECT * FROM {p}counts WHERE is_document)"
    return f"""
{p}documents AS (
  SELECT {key} AS id, '{title}: ' || {key} || ', Number of articles: '
    || CAST(CAST(sum({count}) AS BIGINT) AS VARCHAR) AS text
  FROM {table} WHERE {key} IS NOT NULL GROUP BY {key}),
{p}texts AS (
  SELECT id, text, true AS is_document FROM {p}documents
  UNION ALL SELECT question_id, question, false FROM questions WHERE question_id = '{asked}'),
{p}words AS ({split_words(f"{p}texts", "id, is_document", "text")}),
{bucketed(f"{p}words", p)},
{p}counts AS (
  SELECT id, is_document, bucket, count(*) AS n
  FROM {p}words JOIN {p}buckets USING (word) GROUP BY ALL),
{p}idf AS ({idf(f"{p}documents", documents_counts)}),
{p}vectors AS ({weighted(f"{p}counts", f"{p}idf", "id, is_document")}),
{p}ranked AS (
  SELECT d.id, d.text, row_number() OVER (ORDER BY round(sqrt(sum(
           (coalesce(q.weight, 0) - coalesce(v.weight, 0)) ** 2)), 6), d.id) AS rank
  FROM {p}documents d CROSS JOIN (SELECT bucket FROM {p}idf) i
  LEFT JOIN {p}vectors v ON v.id = d.id AND v.is_document AND v.bucket = i.bucket
  LEFT JOIN {p}vectors q ON NOT q.is_document AND q.bucket = i.bucket
  GROUP BY d.id, d.text),
{p}context AS (
  SELECT '{asked}' AS question_id, count(*) AS n_documents,
         string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context
  FROM {p}ranked WHERE rank <= 4)"""


@query("vector_table", """
SELECT vec_id, len(embedding) AS dimensions,
       round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))), 6) AS length
FROM embeddings""")
def _(spark, sf):
    path = written(vector_table(table(spark, sf, "embeddings"), "vec_id", "embedding"), "vectors")
    vectors = spark.read.schema("vec_id bigint, embedding array<float>").parquet(path)
    squares = F.aggregate("embedding", F.lit(0.0),
                          lambda total, x: total + x.cast("double") * x.cast("double"))
    return vectors.select("vec_id", F.size("embedding").cast("bigint").alias("dimensions"),
                          F.round(F.sqrt(squares), 6).alias("length"))


@query("knn_top4", f"WITH {_HITS} SELECT label, vec_id, distance, CAST(rank AS INTEGER) AS rank FROM hits")
def knn_top4(spark, sf):
    return _hits(spark, sf)


@query("knn_question_blocks",
       f"WITH {_HITS} SELECT label, vec_id, distance, CAST(rank AS INTEGER) AS rank FROM hits")
def _(spark, sf):
    # The way taken when the questions are too many for one broadcast: with room for
    # about five vectors of 64 per block, the same question set takes several blocks.
    return _hits(spark, sf, block_bytes=6 * 64 * 8)


@query("knn_cells",
       f"WITH {_HITS} SELECT label, vec_id, distance, CAST(rank AS INTEGER) AS rank FROM hits")
def _(spark, sf):
    # The same neighbours from an index that every vector is in.
    index = CellIndex(spark, scratch_path(spark, "cells"), "vec_id")
    index.build(table(spark, sf, "embeddings"))
    return index.search(_label_means(spark, sf), "label")


def _damaged_hits(spark: SparkSession, sf: str, **options) -> DataFrame:
    first = F.when(F.col("vec_id") % 97 == 0, float("nan")).when(
        F.col("vec_id") % 89 == 0, float("inf")).otherwise(F.col("embedding")[0]).cast("float")
    corpus = table(spark, sf, "embeddings").withColumn(
        "embedding", F.concat(F.array(first), F.slice("embedding", 2, F.size("embedding"))))
    return nearest(_label_means(spark, sf), corpus, question_id="label", corpus_id="vec_id",
                   **options)


@query("knn_damaged_vectors",
       f"WITH {_DAMAGED} SELECT label, vec_id, distance, CAST(rank AS INTEGER) AS rank FROM hits")
def _(spark, sf):
    return _damaged_hits(spark, sf)


@query("knn_damaged_vectors_blocks",
       f"WITH {_DAMAGED} SELECT label, vec_id, distance, CAST(rank AS INTEGER) AS rank FROM hits")
def _(spark, sf):
    return _damaged_hits(spark, sf, block_bytes=6 * 64 * 8)


@query("stuff_context", f"""
WITH {_HITS}
SELECT label, count(*) AS n_documents,
       coalesce(string_agg(d.text, chr(10) || chr(10) ORDER BY h.rank), '') AS context
FROM hits h LEFT JOIN documents d ON d.doc_id = h.vec_id
GROUP BY label""")
def _(spark, sf):
    documents = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    return stuff_context(attach_documents(_hits(spark, sf), documents, "vec_id"), "label", "text")


# A vector is compared by its parts: one row per dimension that is not zero.
@query("embed_documents", f"""
WITH words AS ({split_words("documents", "doc_id", "text")}),
{bucketed("words")},
counts AS (SELECT doc_id, bucket, count(*) AS n FROM words JOIN buckets USING (word) GROUP BY ALL),
idf AS ({idf("documents", "counts")}),
vectors AS ({weighted("counts", "idf", "doc_id")})
SELECT doc_id, bucket AS dimension, round(weight, 6) AS weight FROM vectors WHERE weight <> 0""")
def embed_documents(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    _, vectors = embed_corpus(documents, "text")
    parts = vectors.select("doc_id", F.posexplode("embedding").alias("dimension", "part"))
    return parts.where("part <> 0").select(
        "doc_id", "dimension", F.round(F.col("part").cast("double"), 6).alias("weight")
    )


@query("retrieve_for_question", f"""
WITH {COUNTS},
questions AS (
  SELECT 'source_id' AS question_id, '{QUESTIONS["source_id"]}' AS question
  UNION ALL SELECT 'author', '{QUESTIONS["author"]}'),
""" + ",".join(_answer_sql(*kind) for kind in (
    ("s_", "source_id", "Source", "by_source", "article_count"),
    ("a_", "author", "Author", "by_author", "article_count_by_author"))) + """
SELECT * FROM s_context UNION ALL SELECT * FROM a_context""")
def _(spark, sf):
    sent = messages(spark, sf)
    by_source, _ = answer(source_counts(sent), "source_id", "article_count")
    by_author, _ = answer(author_counts(sent), "author", "article_count_by_author")
    return by_source.unionByName(by_author)


_ASKED = {"seven": "Author with Number of articles: 7", "named": "Author: author_42 and articles"}


_ASKED_SQL = f"""
WITH {COUNTS},
questions AS (
  SELECT 'seven' AS question_id, '{_ASKED["seven"]}' AS question
  UNION ALL SELECT 'named', '{_ASKED["named"]}'),
""" + ",".join(
    _answer_sql(f"{asked}_", "author", "Author", "by_author", "article_count_by_author", asked)
    for asked in _ASKED) + """
SELECT * FROM seven_context UNION ALL SELECT * FROM named_context"""


@query("store_asked_twice", _ASKED_SQL)
def _(spark, sf):
    # Embedded once; each question comes later and on its own.
    key, count = "author", "article_count_by_author"
    totals = total_per_key(author_counts(messages(spark, sf)), key, count)
    store = totals_store(totals, key, count, scratch_path(spark, "store"))
    return _asked_twice(spark, store)


@query("store_updated", _ASKED_SQL)
def _(spark, sf):
    # Totals change and some go; then they are as they were. Changed ones alone are embedded.
    key, count, path = "author", "article_count_by_author", scratch_path(spark, "store")
    totals = materialize(total_per_key(author_counts(messages(spark, sf)), key, count), "totals")
    kept = F.pmod(F.xxhash64(key), F.lit(3))
    other = totals.where(kept > 0).withColumn(count, F.when(kept == 1, F.col(count) + 1).otherwise(F.col(count)))
    for rows in (totals, other, totals):
        store = totals_store(rows, key, count, path, update=True)
    return _asked_twice(spark, store)


def _asked_twice(spark: SparkSession, store: DocumentStore) -> DataFrame:
    first, second = (
        store.contexts(spark.createDataFrame([asked], "question_id string, question string"),
                       "question_id")
        for asked in _ASKED.items())
    return first.unionByName(second)
