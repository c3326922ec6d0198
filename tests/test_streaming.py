"""Watermarks, late rows, restarts, sinks: small inputs in a fixed order."""

import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallywire.operators.windowed import with_window_bounds
from tallywire.plans.counting import articles_from_messages, author_counts, source_counts
from tallywire.plans.dashboard import live_counts
from tallywire.schemas import AUTHOR_COUNTS, SOURCE_COUNTS
from tallywire.session import shuffle_partitions, stateful
from tallywire.sources.directories import json_directory, parquet_directory
from tallywire.streaming.fanout import console_target, directory_target, fan_out
from tallywire.streaming.late import LateRows, late_messages, recover
from tallywire.streaming.refresh import REFRESH_INTERVAL, latest_snapshot
from tallywire.streaming.sinks import (
    console_sink, json_sink, kafka_sink, parquet_sink, run_available,
)


def message(time, source="cnn", author="ann"):
    return json.dumps({"author": author, "publishedAt": time,
                       "source": {"id": source, "name": source}})


def at(minute, second=0, **fields):
    hour, minute = 10 + minute // 60, minute % 60
    return message(f"2024-01-01T{hour:02d}:{minute:02d}:{second:02d}Z", **fields)


def land(folder, files, start=0):
    """One text file per batch, numbered, a second apart."""
    folder.mkdir(exist_ok=True)
    for number, lines in enumerate(files, start):
        path = folder / f"{number:04d}.txt"
        path.write_text("".join(line + "\n" for line in lines))
        os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def messages(spark, folder):
    return spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder))


def run(spark, writer):
    with stateful(spark, 2):
        return run_available(writer)


def by_source(spark, path):
    rows = with_window_bounds(parquet_directory(spark, str(path), SOURCE_COUNTS)).collect()
    return sorted((f"{r.window_start:%H:%M}", str(r.source_id), r.article_count) for r in rows)


@pytest.fixture
def folders(tmp_path):
    return tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")


def test_late_rows_are_dropped(spark, folders):
    source, out, checkpoint = folders
    land(source, [[at(1)], [at(40)], [at(50)], [at(2)], [at(59)]])
    late = LateRows()
    with stateful(spark, 2):
        query = run_available(
            parquet_sink(source_counts(messages(spark, source)), out, checkpoint), late)
    assert by_source(spark, out) == [("10:00", "cnn", 1), ("10:40", "cnn", 1)]
    assert late.total() == 1
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 2


def test_late_rows_are_counted_beyond_what_a_query_remembers(spark, folders):
    source, out, checkpoint = folders
    land(source, [[at(1)], [at(40)], [at(50)], *([[at(2)]] * 9)])
    late, key = LateRows(), "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, 5)
    try:
        with stateful(spark, 2):
            query = run_available(
                parquet_sink(source_counts(messages(spark, source)), out, checkpoint), late)
    finally:
        spark.conf.unset(key)
    assert len(query.recentProgress) <= 5 and late.total() == 9


def test_every_late_message_of_many_batches_is_found(spark, folders, tmp_path):
    source, out, checkpoint = folders
    files = [[at(1)], [at(40)], [at(50)]]
    files += [[at(2, author=f"late {n}"), at(3, author=f"late {n}, too"), message("no date")] if n % 3 == 0
              else [at(50 + n % 5)] for n in range(150)]
    land(source, files[:80])
    kept = str(tmp_path / "late")

    def counted(late):
        with stateful(spark, 2):
            run_available(parquet_sink(source_counts(messages(spark, source)), out, checkpoint), late)
        return late

    def found():
        read = lambda paths: spark.read.text(paths)
        rows = late_messages(spark, kept, checkpoint, read).collect()
        assert all("10:05" <= f"{r.limit:%H:%M}" <= "10:44" for r in rows)
        assert len({r.batch for r in rows}) == len(rows) // 2
        return sorted(r.author for r in rows)

    def told(end):
        return sorted(f"late {n}{more}" for n in range(0, end, 3) for more in ("", ", too"))

    late = counted(LateRows(spark, kept))
    # The two messages of a file are one row of a partial count.
    assert late.total() == 26 and found() == told(77)
    land(source, files[80:120], start=80)
    assert counted(LateRows()).total() == 13
    # Reports lost with the driver come from the checkpoint.
    recover(spark, kept, checkpoint)
    land(source, files[120:], start=120)
    assert counted(LateRows(spark, kept)).total() == 11
    assert found() == told(150)
    assert late_messages(spark, str(tmp_path / "none"), checkpoint).count() == 0


def test_lateness_is_judged_by_the_previous_batch(spark, folders):
    source, out, checkpoint = folders
    land(source, [
        [at(1), at(2), at(3), at(4, source=None), message("not a date")],
        [at(16)], [at(4), at(6)], [at(30)],
    ])
    run(spark, parquet_sink(source_counts(messages(spark, source)), out, checkpoint))
    assert by_source(spark, out) == [
        ("10:00", "None", 1), ("10:00", "cnn", 4), ("10:05", "cnn", 1), ("10:15", "cnn", 1)]


def test_open_windows_are_held_back_and_restarts_do_not_repeat(spark, folders):
    source, out, checkpoint = folders

    def again():
        run(spark, parquet_sink(source_counts(messages(spark, source)), out, checkpoint))
        return by_source(spark, out)

    land(source, [[at(1), at(3)], [at(14, 59)]])
    assert again() == []
    land(source, [[at(15)]], start=2)
    assert again() == [("10:00", "cnn", 2)]
    assert again() == [("10:00", "cnn", 2)]


def test_json_sink_leaves_out_null_keys(spark, folders):
    source, out, checkpoint = folders
    land(source, [[at(1, author=None), at(2), "broken", at(3)], [at(40)]])
    run(spark, json_sink(author_counts(messages(spark, source)), out, checkpoint))
    lines = [json.loads(line) for r in spark.read.text(out).collect() for line in [r.value]]
    assert sorted(map(sorted, lines)) == [
        ["article_count_by_author", "author", "window"], ["article_count_by_author", "window"]]
    assert {line["window"]["start"] for line in lines} == {"2024-01-01T10:00:00.000Z"}
    rows = json_directory(spark, out, AUTHOR_COUNTS).collect()
    assert {(r.author, r.article_count_by_author) for r in rows} == {("ann", 2), (None, 1)}


def test_console_sinks(spark, folders):
    # The JVM prints past pytest's capture, so only the progress is looked at.
    source, _, _ = folders
    land(source, [[at(1)], [at(40)]])
    raw = console_sink(articles_from_messages(messages(spark, source)))
    counts = console_sink(author_counts(messages(spark, source)), truncate=False)
    for writer in (raw, counts):
        query = run(spark, writer)
        assert query.exception() is None
        assert sum(p["numInputRows"] for p in query.recentProgress) == 2
        assert "Console" in query.lastProgress["sink"]["description"]


def test_fan_out_and_replay(spark, folders, capfd):
    source, out, checkpoint = folders
    land(source, [[at(1), at(2)], [at(40, source="bbc")], [at(59)]])
    targets = [directory_target(f"{out}/p", files=1), directory_target(f"{out}/j", "json"),
               console_target()]
    run(spark, fan_out(source_counts(messages(spark, source)), targets, checkpoint))

    def read(directory, name):
        rows = with_window_bounds(directory(spark, f"{out}/{name}", SOURCE_COUNTS))
        return sorted((f"{r.window_start:%H:%M}", r.source_id, r.article_count)
                      for r in rows.collect())

    expected = [("10:00", "cnn", 2), ("10:40", "bbc", 1)]
    assert read(parquet_directory, "p") == read(json_directory, "j") == expected
    assert "|bbc" in capfd.readouterr().out

    # A batch delivered a second time replaces itself.
    for folder in os.listdir(f"{out}/p"):
        batch = spark.read.schema(SOURCE_COUNTS).parquet(f"{out}/p/{folder}").collect()
        number = int(folder.removeprefix("batch="))
        directory_target(f"{out}/p")(spark.createDataFrame(batch, SOURCE_COUNTS), number)
    assert read(parquet_directory, "p") == expected


def test_refresh_follows_a_growing_sink(spark, folders, tmp_path):
    source, out, checkpoint = folders
    snapshots = str(tmp_path / "snapshots")
    land(source, [[at(1), at(2, source=None)], [at(40, source="bbc")]])
    run(spark, parquet_sink(source_counts(messages(spark, source)), out, checkpoint))
    writer = live_counts(spark, out, SOURCE_COUNTS, "source_id", snapshots,
                         str(tmp_path / "refresh"))
    shape = spark.createDataFrame([], "source_id string, n_windows long").schema

    def refreshed():
        run(spark, writer)
        return sorted(map(tuple, latest_snapshot(spark, snapshots, shape).collect()))

    assert refreshed() == [("cnn", 1)]
    land(source, [[at(46)], [at(120)]], start=2)
    run(spark, parquet_sink(source_counts(messages(spark, source)), out, checkpoint))
    assert refreshed() == [("bbc", 1), ("cnn", 2)]
    land(source, [[at(240)]], start=4)
    run(spark, parquet_sink(source_counts(messages(spark, source)), out, checkpoint))
    assert refreshed() == [("bbc", 1), ("cnn", 3)]
    # A refresh that was broken off is not served.
    spark.range(1).selectExpr("'half' source_id", "id n_windows").write.parquet(
        f"{snapshots}/delta=9-half")
    assert latest_snapshot(spark, snapshots, shape).count() == 2
    assert latest_snapshot(spark, str(tmp_path / "none"), shape).count() == 0
    assert REFRESH_INTERVAL == "2 minutes"


def test_kafka_sink_needs_its_connector(spark, folders):
    source, _, checkpoint = folders
    land(source, [[at(1)]])
    writer = kafka_sink(messages(spark, source), "host:1", "news", checkpoint)
    with pytest.raises(Exception, match="(?i)kafka"):
        run(spark, writer)


def test_settings_are_put_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with stateful(spark, 3):
        assert spark.conf.get(key) == "3"
        assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get(key) == before


def test_shuffle_partitions_fill_whole_waves():
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(10 << 30, 8) == 80
    assert shuffle_partitions(100 << 40, 4000) == 820_000 // 4000 * 4000


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 90), st.sampled_from(["a", "b", None])),
                min_size=1, max_size=40))
def test_stream_and_open_windows_make_up_the_batch(spark, tmp_path_factory, events):
    """In time order nothing is late: what the stream holds back is all it leaves out."""
    folder = tmp_path_factory.mktemp("property")
    events.sort(key=lambda e: e[0])
    lines = [at(minute, source=source) for minute, source in events]
    third = len(lines) // 3 + 1
    land(folder / "in", [lines[i:i + third] for i in range(0, len(lines), third)])
    run(spark, parquet_sink(source_counts(messages(spark, folder / "in")),
                            str(folder / "out"), str(folder / "checkpoint")))
    batch = with_window_bounds(source_counts(spark.read.text(str(folder / "in")))).collect()
    newest = max(minute for minute, _ in events)
    closed = sorted(
        (f"{r.window_start:%H:%M}", str(r.source_id), r.article_count) for r in batch
        if (r.window_end.hour - 10) * 60 + r.window_end.minute <= newest - 10)
    assert by_source(spark, folder / "out") == closed
    assert sum(r.article_count for r in batch) == len(events)
