"""Versions of a store: what is embedded again, and what a search sees meanwhile."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywire.commits import CommitLog
from tallywire.plans import store as module
from tallywire.plans.store import DocumentStore

SCHEMA = "d int, page_content string, metadata map<string, string>"


@pytest.fixture
def kept(spark, tmp_path):
    seen = tmp_path / "seen"
    seen.write_text("")

    def make_predict():
        def predict(texts):
            with open(seen, "a") as file:
                file.writelines(f"{t}\n" for t in texts)
            return np.array([[len(t), t.count("y")] for t in texts], dtype=np.float32)

        return predict

    def frame(sizes, note="n", text="x"):
        return spark.createDataFrame([(i, text * n if n else None, {"note": note}) for i, n in sizes.items()],
                                     SCHEMA).repartition(3)

    store = DocumentStore(spark, str(tmp_path / "store"), "d", make_predict=make_predict)

    def calls():
        lines = seen.read_text().split("\n")[:-1]
        seen.write_text("")
        return sorted(lines)

    return store, frame, calls


def nearest_to(store, size):
    asked = store.spark.createDataFrame([(1, "x" * size)], "q int, question string")
    return [(r.d, r.distance, r.metadata["note"]) for r in store.search(asked, "q", k=1).collect()]


def test_only_changed_texts_are_embedded(spark, kept):
    store, frame, calls = kept
    store.update(frame({n: n for n in range(1, 31)}))
    assert len(calls()) == 30
    # Of 30 one goes, one is new, two change their text, one its note alone.
    sizes = {n: n for n in range(2, 31)} | {50: 50, 7: 70, 8: 80}
    changed = frame(sizes).withColumn("metadata", F.when(F.col("d") == 9, F.create_map(
        F.lit("note"), F.lit("changed"))).otherwise(F.col("metadata")))
    store.update(changed)
    assert calls() == sorted("x" * n for n in (50, 70, 80))
    assert CommitLog.of(spark, store.path).latest()["embedded"] == 3
    assert sorted((r.d, len(r.page_content)) for r in store.documents().collect()) == sorted(sizes.items())
    for d, size, note in ((50, 50, "n"), (7, 70, "n"), (9, 9, "changed"), (2, 2, "n")):
        assert nearest_to(store, size) == [(d, 0.0, note)]
    assert nearest_to(store, 1)[0][0] == 2 and nearest_to(store, 7)[0][0] == 6
    calls()
    store.update(changed)
    assert calls() == []


def test_a_part_can_be_added(kept):
    store, frame, calls = kept
    store.build(frame({1: 1, 2: 2}))
    store.update(frame({2: 20, 3: 30, 4: 0}, note="later"), whole=False)
    assert calls() == sorted(["x", "xx", "x" * 20, "x" * 30, ""])
    assert {r.d: r.metadata["note"] for r in store.documents().collect()} == {
        1: "n", 2: "later", 3: "later", 4: "later"}


def test_a_search_during_a_rebuild_sees_the_old_version(spark, kept):
    store, frame, calls = kept
    with pytest.raises(FileNotFoundError):
        store.documents()
    store.build(frame({n: n for n in range(1, 11)}))
    asked = spark.createDataFrame([(1, "xxx")], "q int, question string")
    planned = store.search(asked, "q", k=2)
    seen = []

    class Rebuilding(DocumentStore):
        def _publish(self, entry):
            # Everything of the new version has been written, and it doesn't count yet.
            seen.append(nearest_to(store, 3))
            super()._publish(entry)

    again = Rebuilding(spark, store.path, "d", make_predict=store.make_predict)
    again.build(frame({n + 100: n for n in range(1, 11)}))
    assert seen == [[(3, 0.0, "n")]] and nearest_to(store, 3) == [(103, 0.0, "n")]
    assert sorted(r.d for r in planned.collect()) == [2, 3]

    def broken(entry):
        raise OSError("no space")

    object.__setattr__(again, "_publish", broken)
    with pytest.raises(OSError):
        again.build(frame({1: 3}))
    assert nearest_to(store, 3) == [(103, 0.0, "n")]


def test_many_updates_make_few_segments_and_leave_no_folders(spark, kept, monkeypatch):
    monkeypatch.setattr(module, "MOST_SEGMENTS", 3)
    store, frame, calls = kept
    sizes = {n: n for n in range(1, 41)}
    store.build(frame(sizes))
    for round_ in range(6):
        sizes[round_ + 1] = 100 + round_
        store.update(frame(sizes))
        entry = CommitLog.of(spark, store.path).latest()
        assert len(entry["segments"]) <= 3
    assert {r.d: len(r.page_content) for r in store.documents().collect()} == sizes
    assert len(calls()) == 40 + 6
    named = {*entry["segments"], entry["dead"]} | {folder for _, folder in entry["leaving"]}
    assert {f for f in os.listdir(store.path) if not f.startswith("_")} == named - {None}


def test_the_default_embedder_stays_as_fitted(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s"), "d", "t")
    rows = [(n, f"word{n} common word{n % 3}") for n in range(20)]
    first = spark.createDataFrame(rows, "d int, t string")
    store.build(first, dimensions=64)
    whole = {r.d: r.embedding for r in store._alive("vectors", store._current()).collect()}
    store.update(first.where("d > 4"))
    store.update(first)
    assert {r.d: r.embedding for r in store._alive("vectors", store._current()).collect()} == whole
    asked = spark.createDataFrame([(1, "word7 common word1")], "q int, question string")
    assert store.search(asked, "q", k=1).first().d == 7
