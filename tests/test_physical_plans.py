"""What the planner makes of the operators."""

import re

import pytest
from pyspark.sql import functions as F

from registry import QUERIES
from registry.inputs import messages, written
from tallywire.operators.clean import equals, in_list, keyword_match
from tallywire.operators.nearest import nearest
from tallywire.operators.rollups import top_total, total_per_key
from tallywire.plans.counting import articles_from_messages, author_counts, source_counts
from tallywire.schemas import MESSAGE, SOURCE_COUNTS
from tallywire.sources.directories import parquet_directory


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sent(spark, small):
    return spark.read.schema(MESSAGE).parquet(written(messages(spark, small), "plan-messages"))


def test_json_is_parsed_once_and_only_the_fields_needed(sent):
    for counts, fields in ((source_counts(sent), ("publishedAt", "source")),
                           (author_counts(sent), ("author", "publishedAt"))):
        text = plan(counts)
        assert text.count("from_json(") == 1
        for name in ("content", "title", "urlToImage"):
            assert f"StructField({name}," not in text
        for name in fields:
            assert f"StructField({name}," in text


def test_counts_are_combined_before_their_one_shuffle(sent):
    text = plan(source_counts(sent))
    assert text.count("Exchange") == 1
    assert re.search(r"Exchange.*\n.*HashAggregate\(.*partial_count", text)


def test_a_registered_count_has_one_shuffle(spark, small):
    assert plan(QUERIES["windowed_count_by_source"](spark, small)).count("Exchange") == 1


def test_decoding_needs_no_shuffle_and_no_python(sent):
    text = plan(articles_from_messages(sent))
    assert "Exchange" not in text and "Python" not in text


def test_scans_read_the_columns_in_use(spark, tmp_path):
    path = str(tmp_path)
    spark.sql("""select named_struct('start', timestamp'2024-01-01', 'end', timestamp'2024-01-02')
                 window, 'a' source_id, 1L article_count""").write.mode("append").parquet(path)
    totals = total_per_key(parquet_directory(spark, path, SOURCE_COUNTS),
                           "source_id", "article_count")
    text = plan(totals)
    assert "ReadSchema: struct<source_id:string,article_count:bigint>" in text
    assert "PushedFilters: [IsNotNull(source_id)]" in text
    assert "TakeOrderedAndProject(limit=1" in plan(top_total(totals, "source_id", "article_count"))


def test_search_terms_reach_the_scan(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    text = plan(equals(documents, "lang", "en").select("doc_id"))
    assert "EqualTo(lang,en)" in text and "ReadSchema: struct<doc_id:bigint,lang:string>" in text
    assert "In(source, [src1,src4])" in plan(in_list(documents, "source", "src1,src4"))
    found = keyword_match(documents, "text", "x").select("doc_id")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(found)


def test_neighbours_are_found_without_pairing_rows(spark, small):
    corpus = spark.read.parquet(f"{small}/embeddings.parquet")
    asked = corpus.where(F.col("vec_id") < 3).select(F.col("vec_id").alias("q"), "embedding")
    text = plan(nearest(asked, corpus, question_id="q", corpus_id="vec_id"))
    assert "NestedLoop" not in text and "Cartesian" not in text
    # Both merge levels keep k per group before their shuffle.
    assert text.count("WindowGroupLimit") == 4
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in text
