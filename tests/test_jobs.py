"""The command line, from responses to answers."""

import json

import pytest
from pyspark.sql import functions as F

from tallywire.jobs import _KINDS, main, parser, wait_for_all
from tallywire.plans.ingest import messages_from_responses
from tallywire.schemas import AUTHOR_COUNTS
from tallywire.streaming.refresh import latest_snapshot

ARTICLES = [
    {"title": "a", "author": "ann", "publishedAt": "2024-01-01T10:01:00Z", "source": {"id": "cnn"}},
    {"title": "b", "author": "ann", "publishedAt": "2024-01-01T10:07:00Z", "source": {"id": "cnn"}},
    {"title": "c", "author": "bob", "publishedAt": "2024-01-01T10:08:00Z", "source": {"id": "bbc"}},
    {"title": "[Removed]", "author": "x", "publishedAt": "2024-01-01T10:08:00Z", "source": {}},
    {"title": "d", "author": None, "publishedAt": "2024-01-01T11:00:00Z", "source": {"id": "fox"}},
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    (folder / "responses").mkdir()
    (folder / "responses" / "1.txt").write_text(json.dumps({"articles": ARTICLES}) + "\n")
    run(spark, folder, "ingest --responses {}/responses --messages {}/messages --checkpoint {}/c0 "
                       "--once")
    return folder


def run(spark, folder, command):
    main(command.replace("{}", str(folder)).split(), spark)


def test_count_by_source_and_ask(spark, folder, capsys):
    run(spark, folder, "count --key source --messages {}/messages --sink {}/parquet "
                       "--checkpoint {}/c1 --once --partitions 2")
    run(spark, folder, "ask --key source --sink {}/parquet")
    shown = capsys.readouterr().out
    assert "Source: cnn, Number of articles: 2" in shown
    assert "|cnn      |2            |" in shown


def test_count_by_author_then_refresh(spark, folder):
    run(spark, folder, "count --key author --messages {}/messages --sink {}/json "
                       "--checkpoint {}/c2 --once --partitions 2")
    run(spark, folder, "refresh --key author --sink {}/json --snapshots {}/snapshots "
                       "--checkpoint {}/c3 --once --partitions 2")
    shape = spark.createDataFrame([], "author string, n_windows long").schema
    rows = latest_snapshot(spark, f"{folder}/snapshots", shape).collect()
    assert sorted(map(tuple, rows)) == [("ann", 2), ("bob", 1)]
    assert AUTHOR_COUNTS.names[0] == "author"


def test_console_shares_the_counts_with_the_sink(spark, folder, capsys):
    run(spark, folder, "count --key source --messages {}/messages --sink {}/both "
                       "--checkpoint {}/c4 --once --console --partitions 2")
    assert "|cnn      |1            |" in capsys.readouterr().out
    run(spark, folder, "ask --key source --sink {}/both")
    assert "Source: bbc, Number of articles: 1" in capsys.readouterr().out


def test_late_messages_are_counted_and_kept(spark, folder, capsys):
    late = [dict(ARTICLES[0], title=title) for title in ("late", "late too")]
    (folder / "responses" / "2.txt").write_text(json.dumps({"articles": late}) + "\n")
    command = ("count --key source --messages {}/waves --sink {}/waves-out --checkpoint {}/c7 --late {}/late "
               "--once --partitions 2")
    messages = spark.read.parquet(f"{folder}/messages")
    messages.write.parquet(f"{folder}/waves")
    run(spark, folder, command)
    assert "|0        |" in capsys.readouterr().out
    messages_from_responses(spark.read.text(f"{folder}/responses/2.txt")).write.mode("append").parquet(
        f"{folder}/waves")
    run(spark, folder, command)
    assert "|1        |" in capsys.readouterr().out
    run(spark, folder, "late --late {}/late --checkpoint {}/c7 --into {}/late-messages")
    assert "|2            |" in capsys.readouterr().out
    rows = spark.read.parquet(f"{folder}/late-messages").collect()
    assert sorted(r.title for r in rows) == ["late", "late too"]


def test_the_console_follows_what_refresh_follows(spark, folder):
    # Nothing counted twice, nothing beside the log.
    run(spark, folder, "refresh --key source --sink {}/both --snapshots {}/both-snapshots "
                       "--checkpoint {}/c5 --once --partitions 2")
    shape = spark.createDataFrame([], "source_id string, n_windows long").schema
    rows = latest_snapshot(spark, f"{folder}/both-snapshots", shape).collect()
    assert sorted(map(tuple, rows)) == [("bbc", 1), ("cnn", 2)]


def test_fetch_polls_a_service(spark, folder, tmp_path, monkeypatch):
    (tmp_path / "fake_service.py").write_text(
        "def fetch(keyword, source, language):\n"
        "    return {'articles': [{'title': f'{keyword} {source} {language}'}]}\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    run(spark, folder, "ingest --fetch fake_service:fetch --messages {}/fetched --checkpoint {}/c6 "
                       "--once")
    titles = {json.loads(r.value)["title"] for r in
              spark.read.parquet(f"{folder}/fetched").selectExpr("string(value)").collect()}
    assert len(titles) == 10 and "nepal cnn en" in titles


def test_a_topic_in_a_folder_serves_the_counts(spark, folder, capsys):
    run(spark, folder, "ingest --responses {}/responses --publish {}/topic --checkpoint {}/c8 --once")
    for _ in range(2):
        run(spark, folder, "count --key source --publish {}/topic --sink {}/from-topic --checkpoint {}/c9 "
                           "--once --partitions 2")
    run(spark, folder, "ask --key source --sink {}/from-topic")
    assert "Source: bbc, Number of articles: 1" in capsys.readouterr().out


@pytest.mark.parametrize("key, fmt", [("source", "parquet"), ("author", "json")])
def test_compaction_keeps_every_row_of_closed_days(spark, tmp_path, key, fmt):
    _, _, schema, _, _, _, read = _KINDS[key]
    start = F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, int(id))")
    window = F.struct(start.alias("start"), (start + F.expr("interval 5 minutes")).alias("end"))
    counts = spark.range(72).repartition(12).select(
        *(window.alias("window") if name == "window" else
          F.col("id").cast(schema[name].dataType).alias(name) for name in schema.names))
    counts.write.format(fmt).save(str(tmp_path / "sink"))

    def compacted(*options):
        main(["compact", "--key", key, "--sink", f"{tmp_path}/sink", "--into",
              f"{tmp_path}/days", *options], spark)
        return sorted(read(spark, f"{tmp_path}/days", schema).collect(), key=str)

    rows = sorted(read(spark, f"{tmp_path}/sink", schema).collect(), key=str)
    assert compacted("--before", "2024-01-03") == [
        row for row in rows if row.window.start.day < 3]
    assert compacted() == rows == compacted()
    for day in (1, 2, 3):
        assert len(list((tmp_path / "days" / f"day=2024-01-0{day}").glob(f"part-*.{fmt}*"))) == 1


def test_a_store_takes_any_question(spark, folder, capsys):
    run(spark, folder, "index --key source --sink {}/both --store {}/store")
    for source in ("cnn", "bbc"):
        main(["ask", "--key", "source", "--store", f"{folder}/store", "--question",
              f"Source: {source}, Number of articles"], spark)
        assert f"|Source: {source}," in capsys.readouterr().out


def test_a_store_is_updated_and_takes_several_questions(spark, folder, capsys):
    for _ in range(2):
        run(spark, folder, "index --key source --sink {}/both --store {}/kept --update")
    main(["ask", "--key", "source", "--store", f"{folder}/kept", "--question", "Source: cnn",
          "--question", "Source: bbc"], spark)
    shown = capsys.readouterr().out
    assert "|source_id 1|" in shown and "|source_id 2|" in shown


def test_what_was_left_out_is_shown_with_its_file(spark, tmp_path, capsys):
    (tmp_path / "responses").mkdir()
    (tmp_path / "responses" / "9.txt").write_text(
        json.dumps({"status": "error", "code": "rateLimited"}) + "\n" + json.dumps({"articles": []}) + "\n")
    run(spark, tmp_path, "rejects --responses {}/responses")
    shown = capsys.readouterr().out
    assert "9.txt" in shown and "rateLimited" in shown and "articles" not in shown
    (tmp_path / "sink").mkdir()
    (tmp_path / "sink" / "a.json").write_text('{"author": "ann"}\n[1]\n')
    run(spark, tmp_path, "rejects --sink {}/sink")
    shown = capsys.readouterr().out
    assert "a.json" in shown and "no object" in shown and "ann" not in shown


def test_an_empty_sink_has_a_status_and_no_answer(spark, folder, capsys):
    (folder / "empty").mkdir()
    run(spark, folder, "ask --key author --sink {}/empty")
    assert "No data available" in capsys.readouterr().out


def test_a_key_is_needed():
    with pytest.raises(SystemExit):
        parser().parse_args(["ask", "--sink", "x"])


def test_a_failing_sink_ends_the_job_and_its_other_queries(spark, folder, tmp_path):
    source = spark.readStream.format("rate").load()
    live = source.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "a")).start()
    bad = (source.select(F.raise_error(F.lit("broken sink")).cast("string").alias("x"))
           .writeStream.format("noop").option("checkpointLocation", str(tmp_path / "b")).start())
    with pytest.raises(Exception, match="broken sink"):
        wait_for_all([live, bad])
    assert not live.isActive and not bad.isActive
