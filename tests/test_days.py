"""Sinks by day, totals by day, lines left out, windows held back."""

import os

import pytest

from tallywire.jobs import main
from tallywire.plans.counting import author_counts, source_counts
from tallywire.plans.totals import DayTotals
from tallywire.schemas import AUTHOR_COUNTS, SOURCE_COUNTS
from tallywire.session import stateful
from tallywire.sources.directories import day_rows, json_directory, json_lines, json_rejects, parquet_directory
from tallywire.streaming.sinks import json_sink, parquet_sink, run_available
from tallywire.streaming.state import open_windows, whole_counts


def article(day, hour, source="cnn", author="ann"):
    return (f'{{"author": "{author}", "publishedAt": "2024-01-{day:02d}T{hour:02d}:00:00Z", '
            f'"source": {{"id": "{source}"}}}}')


@pytest.fixture
def streamed(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def again(lines, plan, sink, **options):
        name = f"{len(os.listdir(folder)):03d}.txt"
        (folder / name).write_text("".join(line + "\n" for line in lines))
        with stateful(spark, 2):
            run_available(sink(plan(spark.readStream.text(str(folder))), str(tmp_path / "out"),
                               str(tmp_path / "c"), **options))
        return str(tmp_path / "out"), str(tmp_path / "c")
    return again


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("plan, sink, schema, fmt", [
    (source_counts, parquet_sink, SOURCE_COUNTS, "parquet"), (author_counts, json_sink, AUTHOR_COUNTS, "json")])
def test_a_stream_writes_by_day_and_a_day_is_all_that_is_read(spark, streamed, plan, sink, schema, fmt):
    lines = [article(day, hour) for day in (1, 2, 3) for hour in (1, 5)]
    out, _ = streamed([*lines, article(4, 1)], plan, sink, by_day=True)
    assert sorted(f for f in os.listdir(out) if f.startswith("day=")) == [
        "day=2024-01-01", "day=2024-01-02", "day=2024-01-03"]
    one = day_rows(spark, out, schema, ["2024-01-02"], fmt)
    assert "PartitionFilters: [isnotnull(day" in plan_of(one)
    assert {f"{r.window.start:%d %H}" for r in one.collect()} == {"02 01", "02 05"}
    assert day_rows(spark, out, schema, fmt=fmt).count() == 6
    # Readers that know of no days see the same rows.
    read = json_directory if fmt == "json" else parquet_directory
    assert read(spark, out, schema).count() == 6


def test_totals_read_the_days_that_changed(spark, tmp_path):
    sink = str(tmp_path / "sink")

    def add(day, source, n):
        spark.sql(f"""select named_struct('start', timestamp'2024-01-{day:02d} 10:00:00',
            'end', timestamp'2024-01-{day:02d} 10:05:00') window, {source} source_id, {n}L article_count,
            date'2024-01-{day:02d}' day""").write.mode("append").partitionBy("day").parquet(sink)

    kept = DayTotals(spark, sink, str(tmp_path / "kept"), SOURCE_COUNTS, "source_id", "article_count")
    nowhere = DayTotals(spark, str(tmp_path / "none"), str(tmp_path / "k2"), SOURCE_COUNTS, "source_id",
                        "article_count")
    assert kept.totals().count() == 0 and nowhere.refresh() == []
    for day in (1, 2, 3):
        add(day, "'cnn'", day)
        add(day, "cast(null as string)", 50)
    add(4, "cast(null as string)", 1)
    assert kept.refresh() == [f"2024-01-0{d}" for d in (1, 2, 3, 4)]
    assert [tuple(r) for r in kept.totals().collect()] == [("cnn", 6)]
    assert kept.refresh() == []
    add(2, "'bbc'", 7)
    assert kept.changed() == ["2024-01-02"]
    text = plan_of(kept.rows(kept.changed()))
    assert "PartitionFilters: [isnotnull(day" in text and "2024-01-02" in text
    assert kept.refresh() == ["2024-01-02"]
    assert sorted(map(tuple, kept.totals().collect())) == [("bbc", 7), ("cnn", 6)]
    # A day that goes takes its totals with it.
    spark._jvm.org.apache.hadoop.fs.Path(f"{sink}/day=2024-01-03").getFileSystem(
        spark._jsc.hadoopConfiguration()).delete(
        spark._jvm.org.apache.hadoop.fs.Path(f"{sink}/day=2024-01-03"), True)
    assert kept.refresh() == ["2024-01-03"]
    assert sorted(map(tuple, kept.totals().collect())) == [("bbc", 7), ("cnn", 3)]


def test_lines_left_out_have_a_place_and_a_reason(spark, tmp_path):
    good = '{"author": "a", "window": {"start": "2024-01-01T10:00:00.000Z"}, "article_count_by_author": 1}'
    bad = {"broken": "no json", '{"author": "a"': "no json", "[1, 2]": "no object", "7": "no object",
           '{"author": "a", "article_count_by_author": "many"}': "other type"}
    (tmp_path / "a.json").write_text("\n".join([good, "", *bad, good]) + "\n")
    (tmp_path / "b.json").write_text(good + "\n" + "broken\n")
    lines = json_lines(spark, str(tmp_path), AUTHOR_COUNTS)
    assert lines.where("reject is null").count() == 3 == json_directory(spark, str(tmp_path), AUTHOR_COUNTS).count()
    got = sorted((r.file.rsplit("/", 1)[1], r.line, r.reject)
                 for r in json_rejects(spark, str(tmp_path), AUTHOR_COUNTS).collect())
    assert got == sorted([("a.json", line, kind) for line, kind in bad.items()] + [("b.json", "broken", "no json")])
    kept = lines.where("reject is null").first()
    assert kept.author == "a" and kept.line is None and kept.article_count_by_author == 1
    assert all(r.author is None for r in lines.where("reject is not null").collect())
    assert json_lines(spark, [], AUTHOR_COUNTS).count() == 0


@pytest.mark.parametrize("plan, sink, schema", [
    (source_counts, parquet_sink, SOURCE_COUNTS), (author_counts, json_sink, AUTHOR_COUNTS)])
def test_windows_held_back_are_read_from_the_state(spark, streamed, plan, sink, schema, tmp_path, capsys):
    out, checkpoint = streamed([article(1, 1), article(1, 1), article(1, 5), article(1, 9)], plan, sink)
    read = json_directory if sink is json_sink else parquet_directory
    count = schema.names[2]

    def told(df):
        return sorted((f"{r.window.start:%H}", r[count]) for r in df.collect())

    assert told(read(spark, out, schema)) == [("01", 2), ("05", 1)]
    assert told(open_windows(spark, checkpoint, schema)) == [("09", 1)]
    assert open_windows(spark, checkpoint, schema).schema.names == schema.names
    streamed([article(1, 9), article(1, 12)], plan, sink)
    assert told(open_windows(spark, checkpoint, schema)) == [("12", 1)]
    both = whole_counts(spark, read(spark, out, schema), checkpoint, schema)
    assert told(both) == [("01", 2), ("05", 1), ("09", 2), ("12", 1)]
    assert both.where("is_open").count() == 1
    key = "source" if schema is SOURCE_COUNTS else "author"
    main(["windows", "--key", key, "--sink", out, "--checkpoint", checkpoint], spark)
    assert "true" in capsys.readouterr().out


def test_totals_from_the_command_line(spark, streamed, tmp_path, capsys):
    out, _ = streamed([article(1, 1), article(2, 1), article(3, 1)], author_counts, json_sink, by_day=True)
    for _ in range(2):
        main(["totals", "--key", "author", "--sink", out, "--kept", str(tmp_path / "kept")], spark)
        assert "|ann   |2 " in capsys.readouterr().out
