"""Directories, messages and polls as inputs."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallywire import storage
from tallywire.functions.json_codec import decode_poll_responses
from tallywire.operators.windowed import with_window_bounds
from tallywire.schemas import AUTHOR_COUNTS, SOURCE_COUNTS
from tallywire.sources.directories import json_directory, parquet_directory
from tallywire.sources.messages import (
    kafka_messages, kafka_options, land_messages, landed_messages, publish_messages,
)
from tallywire.sources.polls import landed_articles, poll_source
from tallywire.streaming.sinks import parquet_sink, run_available
from tallywire.plans.ingest import (
    POLL_INTERVAL, at_poll_interval, messages_from_responses, polled_responses,
)

LINE = json.dumps({"author": "a", "window": {"start": "2024-01-01T00:00:00.000Z",
                                             "end": "2024-01-01T00:05:00.000Z"},
                   "article_count_by_author": 2})
NO_AUTHOR = LINE.replace('"author": "a", ', "")


def test_an_empty_directory_is_an_empty_table(spark, tmp_path):
    for read, schema in ((parquet_directory, SOURCE_COUNTS), (json_directory, AUTHOR_COUNTS)):
        df = read(spark, str(tmp_path), schema)
        assert df.count() == 0 and df.schema.names == schema.names


def test_json_files_of_no_one_and_many_lines(spark, tmp_path):
    (tmp_path / "none.json").write_text("")
    (tmp_path / "one.json").write_text(LINE + "\n")
    (tmp_path / "many.json").write_text("\n".join([LINE, NO_AUTHOR, LINE[:-4], "", "[1", LINE]))
    (tmp_path / "other.txt").write_text(LINE)
    df = json_directory(spark, str(tmp_path), AUTHOR_COUNTS)
    rows = with_window_bounds(df).collect()
    assert sorted(str(r.author) for r in rows) == ["None", "a", "a", "a"]
    assert {str(r.window_end) for r in rows} == {"2024-01-01 00:05:00"}
    assert df.count() == 4
    assert df.groupBy("author").count().count() == 2
    assert json_directory(spark, str(tmp_path), AUTHOR_COUNTS, pattern="*.txt").count() == 1


def test_the_same_lines_are_kept_whatever_is_asked_of_them(spark, tmp_path):
    text = LINE.replace('"article_count_by_author": 2', '"article_count_by_author": "two"')
    flat = LINE.replace(LINE[LINE.index('"window": {'):LINE.index("}") + 1], '"window": "noon"')
    assert flat != LINE != text
    (tmp_path / "a.json").write_text("\n".join([LINE, text, flat, "  "]))
    for skip, n in ((True, 1), (False, 3)):
        df = json_directory(spark, str(tmp_path), AUTHOR_COUNTS, skip_malformed=skip)
        assert df.count() == len(df.collect()) == len(df.select("author").collect()) == n
        assert df.groupBy().sum("article_count_by_author").first()[0] in (2, 4)
        assert df.where("window.start is not null").count() <= n


def test_broken_lines_can_be_kept_as_nulls(spark, tmp_path):
    (tmp_path / "a.json").write_text(LINE + "\nbroken\n")
    df = json_directory(spark, str(tmp_path), AUTHOR_COUNTS, skip_malformed=False)
    assert sorted(str(r.author) for r in df.collect()) == ["None", "a"]


def test_only_parquet_files_are_read(spark, tmp_path):
    spark.sql("""select named_struct('start', timestamp'2024-01-01', 'end', timestamp'2024-01-02')
                 window, 'a' source_id, 1L article_count""").write.mode("append").parquet(str(tmp_path))
    (tmp_path / "notes.txt").write_text("not parquet")
    assert parquet_directory(spark, str(tmp_path), SOURCE_COUNTS).count() == 1


def test_landed_messages_have_the_shape_of_a_topic(spark, tmp_path):
    land_messages(spark.sql("select 'x' value"), str(tmp_path))
    land_messages(spark.sql("select cast('y' as binary) value"), str(tmp_path))
    stream = landed_messages(spark, str(tmp_path))
    assert stream.isStreaming and stream.schema.simpleString() == "struct<value:binary>"
    assert spark.read.parquet(str(tmp_path)).count() == 2


def test_kafka_options():
    assert kafka_options("host:1", "news", startingOffsets="earliest") == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "news", "startingOffsets": "earliest"}


def test_kafka_needs_its_connector(spark):
    # Not installed here: Spark itself says so, for the source and the sink.
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        kafka_messages(spark, "host:1", "news")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        publish_messages(spark.sql("select cast('x' as binary) value"), "host:1", "news")


def fetcher():
    # Defined inside a function, hence shipped to the workers with its code.
    def fetch(query, source, language):
        return {"status": "ok", "articles": [
            {"title": f"{query} {source} {language} é", "source": {"id": source}},
            {"title": "[Removed]", "source": {"id": source}},
        ]}

    return fetch


def test_polling_one_task_per_source(spark):
    spark.dataSource.register(poll_source(fetcher(), "fake_poll"))
    responses = (spark.read.format("fake_poll").option("q", "nepal")
                 .option("sources", "cnn,bbc").option("language", "en").load())
    assert responses.rdd.getNumPartitions() == 2
    titles = [r.title for r in decode_poll_responses(responses).collect()]
    assert sorted(titles) == ["[Removed]", "[Removed]", "nepal bbc en é", "nepal cnn en é"]


def test_polling_as_a_stream(spark, tmp_path):
    responses = polled_responses(spark, fetcher(), news_sources="cnn,bbc")
    sent = messages_from_responses(responses)
    writer = parquet_sink(sent, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query = at_poll_interval(writer, "1 second").start()
    try:
        while len(query.recentProgress) < 2 and query.isActive:
            query.awaitTermination(0.2)
    finally:
        query.stop()
    assert query.exception() is None
    values = spark.read.parquet(str(tmp_path / "out")).select(F.col("value").cast("string"))
    # Every poll sends the same two articles again.
    per_title = {r[0]: r[1] for r in values.groupBy(F.get_json_object("value", "$.title"))
                 .count().collect()}
    assert set(per_title) == {"nepal bbc en é", "nepal cnn en é"}
    assert len(set(per_title.values())) == 1 and min(per_title.values()) >= 2


def test_responses_landed_at_intervals(spark, tmp_path):
    landing = tmp_path / "responses"
    landing.mkdir()
    (landing / "1.txt").write_text(json.dumps(fetcher()("q", "a", "en")) + "\n")
    articles = landed_articles(spark, str(landing))
    writer = parquet_sink(articles, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query = at_poll_interval(writer, "1 second").start()
    try:
        query.processAllAvailable()
        (landing / "2.txt").write_text(json.dumps(fetcher()("q", "b", "en")) + "\nbroken\n")
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    assert POLL_INTERVAL == "15 minutes"


def test_run_available_reports_failures(spark, tmp_path):
    land_messages(spark.sql("select 'x' value"), str(tmp_path / "in"))
    bad = landed_messages(spark, str(tmp_path / "in")).select(
        F.raise_error(F.lit("no")).cast("string").alias("value"))
    with pytest.raises(Exception, match="no"):
        run_available(parquet_sink(bad, str(tmp_path / "out"), str(tmp_path / "c")))


def test_the_shared_folder_is_the_one_the_session_names(spark, tmp_path):
    session = spark.newSession()
    preset = session.conf.get("spark.checkpoint.dir", None)
    if preset:
        assert storage.shared_folder(session) == preset.rstrip("/")
    else:
        session.conf.set(storage.SCRATCH_DIR, str(tmp_path))
        assert storage.shared_folder(session) == str(tmp_path)


STOCK = """
import sys
from pyspark.sql import SparkSession
from tallywire import storage
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.sql.warehouse.dir", sys.argv[1] + "/house").getOrCreate())
assert spark.conf.get("spark.checkpoint.dir", None) is None
with storage.scratch_run(spark):
    df = storage.materialize(spark.range(3), "rows")
    print(df.count(), df.inputFiles()[0])
spark.conf.set(storage.SCRATCH_DIR, sys.argv[1] + "/own")
print(storage.shared_folder(spark))
"""


def test_a_stock_session_writes_to_its_warehouse(tmp_path):
    (tmp_path / "conf").mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", STOCK, str(tmp_path)], env=env,
                          capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    counted, own = done.stdout.split("\n")[:2]
    assert counted.startswith("3 ") and f"{tmp_path}/house/_scratch/tallywire/" in counted
    assert own == f"{tmp_path}/own"
    assert not any((tmp_path / "house/_scratch/tallywire").iterdir())


def test_a_cluster_needs_a_folder_that_is_shared(spark, tmp_path, monkeypatch):
    session = spark.newSession()
    # Whatever this session names, as if it named nothing.
    monkeypatch.setattr(storage, "_CHECKPOINT_DIR", "tallywire.no.such.setting")
    session.conf.unset(storage.SCRATCH_DIR)
    monkeypatch.setattr(storage, "_master", lambda spark: "spark://somewhere:7077")
    with pytest.raises(ValueError, match="each machine's own disk"):
        storage.shared_folder(session)
    session.conf.set(storage.SCRATCH_DIR, str(tmp_path))
    assert storage.materialize(session.range(5), "rows").count() == 5
    read = storage._table
    monkeypatch.setattr(storage, "_table", lambda *a: read(*a).where("id <> 3"))
    with pytest.raises(RuntimeError, match="4 of 5 rows"):
        storage.materialize(session.range(5), "rows")
    monkeypatch.setattr(storage, "_master", lambda spark: "local[8]")
    assert storage.materialize(session.range(5), "rows").count() == 4


def test_a_run_deletes_its_own_scratch_tables_only(spark, tmp_path):
    outside = storage.materialize(spark.range(3), "stays")
    with storage.scratch_run(spark):
        inside = storage.materialize(spark.range(4), "goes")
        (path,) = {os.path.dirname(f) for f in inside.inputFiles()}
        assert inside.count() == 4
    assert not os.path.exists(path.removeprefix("file://"))
    assert outside.count() == 3
