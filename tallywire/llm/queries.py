"""The operators of this subpackage as queries over the given tables, with SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tallywire.llm.ball_tree import rank_documents
from tallywire.llm.chat_format import digests, format_chats
from tallywire.llm.decontaminate import hit_words, match_items
from tallywire.llm.exact_dedup import duplicate_groups
from tallywire.llm.inputs import fitted_grammar, fold, table, vocabulary, with_digests
from tallywire.llm.license_scan import scan_licenses
from tallywire.llm.lm_scoring import score_documents
from tallywire.llm.near_dedup import near_duplicate_groups
from tallywire.llm.packing import pack
from tallywire.llm.recompression import remove_repeats
from tallywire.llm.run_index import remove_repeated_bytes
from tallywire.llm.spelling import damaged_words, spelling_variants
from tallywire.llm.toxicity import THRESHOLD, score_toxicity
from tallywire.llm.warc import read_warc, with_revisits, write_warc
from tallywire.session import pin_utc
from tallywire.storage import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(pin_utc(spark), sf_dir)
    return build


@query
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    match = F.col("match")
    found = match_items(table(spark, sf_dir, "documents").select("doc_id", "text"),
                        table(spark, sf_dir, "benchmark"))
    n_hit = hit_words(match["spans"])
    return found.select(
        "doc_id", match["n_words"].alias("n_words"), n_hit.alias("n_hit"),
        F.size(match["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(match["items"], ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


_PLAIN = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

ORACLE_SQL["op2_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
b AS (SELECT DISTINCT item_id, {_PLAIN} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, w[i:i + least(len(w), 10) - 1] AS g, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, i, n, w[i:i + n - 1] AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, p.n, item_id FROM places p JOIN windows USING (g)),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "documents"))


ORACLE_SQL["op4_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("licenses")
    first = F.transform(found["places"], lambda p: p["first"])
    base = F.array_sort(F.array_distinct(F.transform(found["places"], lambda p: p["label"])))
    spans = F.transform(found["spans"], lambda s: s["label"])
    coverage = F.array_max(F.transform(found["spans"], lambda s: s["coverage"]))
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(documents).select(
        "doc_id", found["n_words"].alias("n_words"),
        F.size(found["places"]).cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, spans)), ",").alias("labels"),
        F.when(F.size(found["places"]) > 0, 1.0).otherwise(F.coalesce(coverage, F.lit(0.0)))
        .alias("score"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = scratch_path(spark, "warc")
    write_warc(with_revisits(pages), folder)
    return read_warc(spark, folder).select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast("long").alias("refers_to"))


ORACLE_SQL["op5_warc"] = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100
    THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM f"""


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    score = F.col("toxicity.score")
    return score_toxicity(documents, fitted_grammar(spark, sf_dir)).select(
        "doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_digests(pack(documents, vocabulary())).drop("ids")


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed",
        F.sha2("text", 256).alias("kept_sha256"))


_SPACED = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

ORACLE_SQL["op8_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
s AS (SELECT doc_id, i, list_aggregate(w[i:i + 49], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT doc_id, i FROM (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM s) WHERE first < doc_id),
x AS (SELECT DISTINCT doc_id, k FROM (SELECT doc_id, unnest(range(i, i + 50)) AS k FROM f)),
k AS (SELECT d.doc_id, i, word, x.k IS NULL AS stays
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d) d
  LEFT JOIN x ON x.doc_id = d.doc_id AND x.k = d.i),
t AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) FILTER (stays) AS kept,
  count(*) FILTER (NOT stays) AS n_removed FROM k GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)"""


@query
def op6_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed",
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


# Bytes as hexadecimal digits, two each; a window is 800 of them.
ORACLE_SQL["op6_run_length_index"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, i, md5_number(substr(h, 2 * i + 1, 800)) AS g
  FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM d WHERE length(h) >= 800)),
x AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY g) AS c FROM w) WHERE c > 1),
s AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 400 THEN 0 ELSE 1 END AS new FROM x),
k AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS span FROM s),
spans AS (SELECT r, span, min(i) AS a, max(i) + 400 AS b FROM k GROUP BY ALL),
parts AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS after FROM spans),
kept AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans,
  string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS h
  FROM parts JOIN d USING (r) GROUP BY r)
SELECT doc_id, length(d.h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


@query
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicate_groups(table(spark, sf_dir, "documents"), words=3, percent=85)
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                         (F.col("id") == F.col("component_id")).alias("kept"))


ORACLE_SQL["op9_near_dedup"] = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * c >= 85 * (a.n + b.n - c)),
r AS (SELECT doc_id, doc_id AS o FROM d UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.o),
m AS (SELECT doc_id, min(o) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM m LEFT JOIN n USING (doc_id)"""


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(documents, fold("doc_id", 10) == 0).withColumnRenamed("id", "doc_id")


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = damaged_words(table(spark, sf_dir, "documents"))
    return spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


# crc32 has no function there: its table is made by the rule, and its bytes from code points.
ORACLE_SQL["op11_spelling_variants"] = """
WITH RECURSIVE t AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
runs AS (SELECT doc_id, word, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS word FROM documents)
  GROUP BY ALL),
h AS (SELECT word, n, xor(list_reduce([4294967295] || flatten(list_transform(
    string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || word, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, unicode(c) - 64] END)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM runs, t),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT CASE WHEN h % 97 = 0 THEN word[:h % length(word)] || word[h % length(word) + 2:] ELSE word END
    AS word, n FROM h) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
v AS (SELECT word, i, word[:i - 1] || word[i + 1:] AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (
  SELECT a.word, b.word AS near FROM v a JOIN v b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT v.word, w.word FROM v JOIN w ON v.rest = w.word
  UNION SELECT w.word, v.word FROM v JOIN w ON v.rest = w.word),
best AS (SELECT near.word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n
  FROM near JOIN w ON w.word = near.near GROUP BY near.word),
f AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
    CASE WHEN near_n >= 2 * n THEN near_n END AS form_n FROM w LEFT JOIN best USING (word)),
chain AS (SELECT word, form, word AS root FROM f
  UNION ALL SELECT chain.word, f.form, f.word FROM chain JOIN f ON f.word = chain.form),
roots AS (SELECT word, root FROM chain WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN roots USING (word)"""


# Its texts hold control strings of the template.
_HARD_CHAT = "</s>[INST] ok [/INST]"


@query
def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_HARD_CHAT).alias("text"))
    chats = format_chats(rows.unionByName(hard))
    return digests(materialize(chats, "formatted", compression="zstd"))


_ESCAPED = r"regexp_replace({}, '([<\[])(\\*(?:/?s>|/?INST\]|/?ROLE\]|END\]))', '\1\\\2', 'g')"

ORACLE_SQL["op12_chat_format"] = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{_HARD_CHAT}'), (-7, 1, 'assistant', '{_HARD_CHAT}')),
e AS (SELECT *, length({_ESCAPED.format('text')}) AS n, length({_ESCAPED.format('role')}) AS r FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(3 + sum(n + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 ELSE 22 + r END) AS BIGINT)
    AS formatted_chars
FROM e GROUP BY conv_id"""


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = ("regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

ORACLE_SQL["op13_lexical_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS.format('text')} AS w FROM documents),
a AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
q AS (SELECT item_id, term, count(*) AS times FROM (
  SELECT DISTINCT item_id, text, unnest({_TERMS.format('text')}) AS term,
    generate_subscripts({_TERMS.format('text')}, 1) AS place FROM benchmark) GROUP BY ALL),
t AS (SELECT row, doc_id, n_terms, term, count(*) AS tf FROM (
  SELECT row, doc_id, len(w) AS n_terms, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM t, a GROUP BY term, n),
s AS (SELECT item_id, row, doc_id, CAST(sum(times * w.w * ((1000000000 * tf) //
    (1000 * tf + 8 * (25 + (75 * n_terms * n) // l)))) AS BIGINT) AS score
  FROM q JOIN t USING (term) JOIN w USING (term), a GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
