"""Polls that are read again and not fetched again; batches published whole or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from tallywire.commits import CommitLog
from tallywire.plans.ingest import messages_from_responses, polled_responses
from tallywire.sources.messages import land_messages, landed_messages
from tallywire.sources.polls import landed_name, poll_of
from tallywire.streaming.publish import (
    Written, _Writer, committed_messages, committed_sink, discard_uncommitted,
)
from tallywire.streaming.sinks import run_available


def counting_fetch(folder):
    """Answers differ from one call to the next, and every call leaves a file."""
    def fetch(query, source, language):
        import os
        import uuid
        call = uuid.uuid4().hex
        open(os.path.join(folder, call), "w").close()
        return {"articles": [{"title": f"{source} {call}"}]}
    return fetch


def test_a_batch_killed_after_its_polls_reads_them_again(spark, tmp_path):
    calls, landing = tmp_path / "calls", str(tmp_path / "landing")
    calls.mkdir()
    seen, dying = {}, [True]

    def deliver(batch, batch_id):
        # What the batch read is known; then the job dies, before anything is committed.
        titles = sorted(r[0] for r in batch.select(F.get_json_object(
            F.col("value").cast("string"), "$.title")).collect())
        seen.setdefault(batch_id, []).append(titles)
        if dying:
            raise RuntimeError("killed")

    def run():
        responses = polled_responses(spark, counting_fetch(str(calls)), news_sources="cnn,bbc/x",
                                     landing=landing)
        run_available(messages_from_responses(responses).writeStream.foreachBatch(deliver)
                      .option("checkpointLocation", str(tmp_path / "c")))

    with pytest.raises(Exception, match="killed"):
        run()
    assert len(list(calls.iterdir())) == 2
    dying.clear()
    run()
    first, second = seen[0]
    assert first == second and [t.split()[0] for t in first] == ["bbc/x", "cnn"]
    later = [titles for batch, runs in seen.items() if batch > 0 for titles in runs]
    assert all(titles != first for titles in later)
    assert len(list(calls.iterdir())) == 2 + 2 * len(later)
    # Only the responses of polls that may be asked for again are kept.
    run()
    assert len({poll_of(name) for name in os.listdir(landing)}) <= 2


def test_names_of_responses_tell_their_polls():
    assert poll_of(landed_name(1234, "a/b é")) == 1234 == poll_of("." + landed_name(1234, "x") + "-half")
    assert poll_of("notes.txt") > 1 << 60 and "/" not in landed_name(1, "a/b")


def test_batches_are_published_once(spark, tmp_path):
    landing, topic = str(tmp_path / "landing"), str(tmp_path / "topic")
    assert committed_messages(spark, topic).count() == 0

    def send(broken=False):
        stream = landed_messages(spark, landing)
        if broken:
            stream = stream.select(F.when(F.col("value") == b"m7", F.raise_error(F.lit("broken")).cast(
                "binary")).otherwise(F.col("value")).alias("value"))
        run_available(committed_sink(stream, topic, str(tmp_path / "c")))

    def found():
        return sorted(bytes(r.value).decode() for r in committed_messages(spark, topic).collect())

    land_messages(spark.range(5).selectExpr("concat('m', id) value").repartition(3), landing)
    send()
    land_messages(spark.range(5, 10).selectExpr("concat('m', id) value").repartition(5), landing)
    with pytest.raises(Exception, match="broken"):
        send(broken=True)
    assert found() == [f"m{n}" for n in range(5)]
    discard_uncommitted(topic)
    send()
    send()
    assert found() == [f"m{n}" for n in range(10)]
    log = CommitLog.at(topic)
    assert sum(entry["rows"] for entry in log.entries().values()) == 10
    assert discard_uncommitted(topic) == []

    # The same topic as a stream: each batch once, across restarts.
    for _ in range(2):
        run_available(committed_messages(spark, topic, stream=True).writeStream.format("parquet")
                      .option("path", str(tmp_path / "read")).option("checkpointLocation", str(tmp_path / "r")))
    assert spark.read.parquet(str(tmp_path / "read")).count() == 10


def test_a_batch_committed_before_is_not_committed_again(tmp_path):
    path = str(tmp_path)
    (tmp_path / "staged").mkdir()
    for name in ("one", "one more", "two", "three"):
        (tmp_path / "staged" / name).write_text("x")
    writer = _Writer(path)
    with pytest.MonkeyPatch.context() as patch:
        # Broken off between the entry and the first move.
        patch.setattr("tallywire.streaming.publish.bring_forward", lambda path: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            writer.commit([Written("one", 1), None, Written(None, 0), Written("one more", 1)], 0)
    assert not (tmp_path / "messages").exists()
    writer.commit([Written("two", 1)], 0)
    writer.abort([Written("three", 1), None], 1)
    assert CommitLog.at(path).entries() == {0: {"files": ["one", "one more"], "rows": 2}}
    assert os.listdir(tmp_path / "staged") == []
    assert sorted(os.listdir(tmp_path / "messages")) == ["one", "one more"]
