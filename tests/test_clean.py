"""Null, error and placeholder rules on literal rows."""

import json

from pyspark.sql import functions as F

from tallywire.functions.event_time import parse_published_at
from tallywire.functions.json_codec import decode_messages, encode_articles
from tallywire.operators.clean import (
    drop_placeholders, flatten_article, in_list, keyword_match, project_fields,
)
from tallywire.operators.combine import concat_by_name, flatten_nested
from tallywire.operators.profile import profile_columns
from tallywire.operators.windowed import count_by_source, with_window_bounds
from tallywire.plans.ingest import messages_from_responses
from tallywire.schemas import ARTICLE, article_fields


def article(**fields):
    return tuple(fields.get(name) for name in ARTICLE.names)


def articles(spark, *rows):
    return spark.createDataFrame([article(**row) for row in rows], ARTICLE)


def test_placeholders_go_and_nulls_stay(spark):
    df = articles(
        spark,
        {"title": "a", "author": None},
        {"title": "[Removed]", "author": None},
        {"title": None, "author": "[Removed]"},
        {"title": None, "author": "x", "publishedAt": None},
        {"title": "b", "author": "x", "publishedAt": "[Removed]"},
        {"title": "[removed]", "author": "x"},
    )
    kept = [(r.title, r.author) for r in drop_placeholders(df).collect()]
    assert sorted(kept, key=str) == sorted([("a", None), (None, "x"), ("[removed]", "x")], key=str)


def decoded(spark, schema, *texts):
    values = spark.createDataFrame([(t,) for t in texts], "value string")
    return decode_messages(values, schema).collect()


def test_bad_json_gives_a_row_of_nulls(spark):
    bad = ["not json", '{"author":"a"', '[{"author":"a"},{"author":"b"}]', "", None,
           '{"Author":"A"}']
    rows = decoded(spark, ARTICLE, *bad)
    assert len(rows) == len(bad)
    assert all(value is None for row in rows for value in row)


def test_a_number_reads_as_text_and_a_wrong_source_as_null(spark):
    (row,) = decoded(spark, ARTICLE, '{"author":5,"source":"cnn"}')
    assert row.author == "5" and row.source is None


def test_narrow_decode_agrees_with_full_decode(spark):
    texts = ["not json", '{"author":"a"', "", None, '{"author":5,"source":"cnn","publishedAt":"p"}',
             '{"author":{"x":1},"publishedAt":"p","source":{"id":"i"}}',
             '{"title":[1],"publishedAt":"p","source":{"id":7,"name":null}}',
             '{"publishedAt":"p","source":{"id":"i"},"extra":[{"y":2}]}']
    full = [(r.publishedAt, r.source) for r in decoded(spark, ARTICLE, *texts)]
    narrow = [(r.publishedAt, r.source)
              for r in decoded(spark, article_fields("publishedAt", "source"), *texts)]
    assert narrow == full


def test_published_at_layout(spark):
    texts = ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05.123Z", "2024-01-02T03:04:05+05:45",
             "2024-02-30T00:00:00Z", "[Removed]", "", None, "2024-01-02", "1704164645"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = df.select(parse_published_at("t").cast("string")).collect()
    assert [r[0] for r in parsed] == ["2024-01-02 03:04:05"] + [None] * 8


def test_event_time_null_has_no_window_but_source_null_has_a_group(spark):
    rows = [("2024-01-01 00:01:00", None), ("2024-01-01 00:04:59", None),
            ("2024-01-01 00:05:00", "a"), (None, "a")]
    df = spark.createDataFrame(rows, "t string, source_id string").withColumn(
        "publishedAt", F.col("t").cast("timestamp"))
    counts = with_window_bounds(count_by_source(df))
    got = {(str(r.window_start), r.source_id): r.article_count for r in counts.collect()}
    assert got == {("2024-01-01 00:00:00", None): 2, ("2024-01-01 00:05:00", "a"): 1}


def test_messages_carry_every_field_as_utf8_json(spark):
    df = articles(spark, {"title": "Ærø “q” \\", "source": ("i", None)})
    (row,) = encode_articles(df).collect()
    sent = json.loads(bytes(row.value).decode("utf-8"))
    assert sent == {**dict.fromkeys(ARTICLE.names), "title": "Ærø “q” \\",
                    "source": {"id": "i", "name": None}}
    assert list(sent) == ARTICLE.names


def test_missing_source_is_published_as_a_struct_of_nulls(spark):
    response = json.dumps({"articles": [
        {"title": "a", "extra": 1}, {"title": "[Removed]"},
        {"title": "b", "source": {"id": "i", "name": "n", "more": 2}}, {"source": None},
    ]})
    df = spark.createDataFrame([(response,), ("broken",), ('{"articles": []}',)], "value string")
    sent = [json.loads(bytes(r.value)) for r in messages_from_responses(df).collect()]
    assert [(m["title"], m["source"]) for m in sent] == [
        ("a", {"id": None, "name": None}), ("b", {"id": "i", "name": "n"}),
        (None, {"id": None, "name": None}),
    ]


def test_flatten_and_project(spark):
    df = articles(spark, {"author": "a", "source": ("i", "n")}).withColumn("other", F.lit(1))
    assert project_fields(df).columns == ARTICLE.names
    flat = flatten_article(project_fields(df))
    assert flat.columns == ["author", "content", "description", "publishedAt", "source_id",
                            "source_name", "title", "url", "urlToImage"]
    assert flat.first()[4:6] == ("i", "n")


def test_search_terms(spark):
    df = spark.createDataFrame([("In NEPAL", "cnn"), ("nep al", "bbc"), (None, None)],
                               "text string, source string")
    assert keyword_match(df, "text", "Nepal").count() == 1
    assert in_list(df, "source", "cnn,fox").count() == 1


def test_nested_columns_get_dotted_names(spark):
    df = spark.sql("select 'a' author, named_struct('start', 1, 'end', named_struct('x', 2)) w")
    flat = flatten_nested(df)
    assert flat.columns == ["author", "w.start", "w.end.x"]
    assert tuple(flat.first()) == ("a", 1, 2)


def test_concat_fills_absent_columns(spark):
    a = spark.sql("select 1 x, 'a' y")
    b = spark.sql("select 'b' y, 2 z")
    rows = concat_by_name(a, b, a).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(1, "a", None), (None, "b", 2), (1, "a", None)], key=str)


def test_profile_counts_dotted_columns_and_nulls(spark):
    df = spark.sql("select * from values (1, null), (2, 'b') as t(a, `b.c`)")
    got = [tuple(r) for r in profile_columns(df).orderBy("position").collect()]
    assert got == [(0, "a", "int", 2, 2), (1, "b.c", "string", 2, 1)]
