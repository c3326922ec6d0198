"""Commit logs, fan-outs that count in all targets or none, refreshes that write what changed."""

import os

import pytest
from pyspark.sql import functions as F

from tallywire import commits
from tallywire.commits import ArrowFolder, CommitLog
from tallywire.session import stateful
from tallywire.streaming.fanout import CommittedBatches
from tallywire.streaming.refresh import delta_sink, latest_snapshot, running_counts
from tallywire.streaming.sinks import run_available


@pytest.mark.parametrize("make", [
    lambda spark, path: CommitLog.of(spark, path), lambda spark, path: CommitLog.at(path)])
def test_a_log_keeps_every_entry_in_few_files(spark, tmp_path, make, monkeypatch):
    monkeypatch.setattr(commits, "FOLD", 8)
    log = make(spark, str(tmp_path / "out"))
    assert log.last() == -1 and log.latest() is None and log.entries() == {}
    for number in [*range(50), 57]:
        log.put(number, {"rows": number * number, "name": "é"})
        log.put(number, {"rows": -1})
        log.put(max(0, number - 5), {"rows": -1})
    again = CommitLog.of(spark, str(tmp_path / "out"))
    want = {n: {"rows": n * n, "name": "é"} for n in [*range(50), 57]}
    assert again.entries() == want and again.last() == 57 and again.latest() == want[57]
    assert len([n for n in os.listdir(tmp_path / "out/_commits") if not n.startswith(".")]) < 25


def test_an_entry_that_was_broken_off_is_none(tmp_path):
    log = CommitLog.at(str(tmp_path))
    log.put(0, {"a": 1})
    (tmp_path / "_commits" / ".00000000000000000001.json-half").write_text('{"a"')
    assert log.entries() == {0: {"a": 1}}
    folder = ArrowFolder(str(tmp_path / "more"))
    folder.write("x", b"1")
    folder.remove("x")
    folder.remove("x")
    assert folder.names() == []
    folder.write("y", b"2")
    for uri in (f"file:{tmp_path}/more", f"file://{tmp_path}/more", os.path.relpath(tmp_path / "more")):
        assert ArrowFolder(uri).read("y") == b"2"


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v long")


def test_a_batch_counts_in_all_targets_or_in_none(spark, tmp_path):
    root, schema, failing = str(tmp_path / "fan"), frame(spark).schema, [True]
    shown = []

    def also(batch, batch_id):
        if batch_id == 1 and failing:
            raise OSError("disk full")
        shown.append(batch_id)

    def read(batches):
        return [sorted(r.v for r in batches.read(name, schema).collect()) for name in ("p", "j")]

    batches = CommittedBatches(spark, root, {"p": "parquet", "j": "json"}, [also], files=1)
    assert read(batches) == [[], []]
    batches.deliver(frame(spark, 1, 2), 0)
    with pytest.raises(OSError):
        batches.deliver(frame(spark, 3), 1)
    # Both targets have been written and neither counts.
    assert len(os.listdir(f"{root}/p")) == 2 and read(batches) == [[1, 2]] * 2
    failing.clear()
    later = CommittedBatches(spark, root, {"p": "parquet", "j": "json"}, [also])
    later.deliver(frame(spark, 3), 1)
    later.deliver(frame(spark, 3), 1)
    later.deliver(frame(spark, 9), 0)
    assert read(later) == [[1, 2, 3]] * 2 and shown == [0, 1]
    assert len(os.listdir(f"{root}/p")) == len(os.listdir(f"{root}/j")) == 2


SINK = "k string, n long"


@pytest.fixture
def refresher(spark, tmp_path):
    sink = str(tmp_path / "sink")

    def again(rows, **options):
        rows.write.mode("append").parquet(sink)
        counts = running_counts(spark, sink, rows.schema, "k")
        with stateful(spark, 4):
            run_available(delta_sink(counts, str(tmp_path / "counts"), str(tmp_path / "c"), **options))
        return CommitLog.of(spark, str(tmp_path / "counts")).latest(), counts.schema
    return again


def keys(spark, first, end):
    return spark.range(first, end).select(F.concat(F.lit("key"), "id").alias("k"), F.col("id").alias("n"))


def test_a_refresh_writes_what_it_changed(spark, tmp_path, refresher):
    path = str(tmp_path / "counts")
    entry, schema = refresher(keys(spark, 0, 2000))
    assert (entry["written"], entry["base_rows"], entry["deltas"]) == (2000, 2000, [])
    entry, _ = refresher(keys(spark, 0, 20))
    assert (entry["written"], entry["delta_rows"]) == (20, 20)
    files = [f for f in os.listdir(f"{path}/{entry['deltas'][0]}") if f.endswith(".parquet")]
    assert sum(spark.read.parquet(f"{path}/{entry['deltas'][0]}/{f}").count() for f in files) == 20
    entry, _ = refresher(keys(spark, 10, 30).unionByName(keys(spark, 5000, 5005)))
    assert entry["written"] == 25 and len(entry["deltas"]) == 2
    got = {r.k: r.n_windows for r in latest_snapshot(spark, path, schema).collect()}
    want = {f"key{n}": 1 + (n < 20) + (10 <= n < 30) for n in [*range(2000), *range(5000, 5005)]}
    assert got == want
    # The base takes no part in a shuffle while changes are few.
    plan = latest_snapshot(spark, path, schema)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_changes_are_folded_and_old_folders_go(spark, tmp_path, refresher):
    path = str(tmp_path / "counts")
    for round_ in range(6):
        entry, schema = refresher(keys(spark, 0, 40), fold_share=0.5, keep=1, fold_rows=0)
        got = {r.n_windows for r in latest_snapshot(spark, path, schema).collect()}
        assert got == {round_ + 1} and entry["delta_rows"] <= 20
    folders = [f for f in os.listdir(path) if not f.startswith("_")]
    assert entry["base"] in folders and len(folders) <= 4
    # Few rows are folded only when they are in too many folders.
    for _ in range(3):
        entry, _ = refresher(keys(spark, 0, 1))
    assert len(entry["deltas"]) == 3 and entry["delta_rows"] == 3
    assert {r.n_windows for r in latest_snapshot(spark, path, schema).collect()} == {6, 9}
    # Without news nothing is written.
    before = CommitLog.of(spark, path).last()
    entry, _ = refresher(keys(spark, 0, 0), keep=1)
    assert entry["written"] in (0, 1) and CommitLog.of(spark, path).last() >= before
    assert latest_snapshot(spark, path, schema).count() == 40
