"""The index of cells: the same neighbours as without it, and most cells not read."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywire.operators import cells as module
from tallywire.operators.cells import CellIndex
from tallywire.operators.nearest import nearest

ID = "cid long, embedding array<float>"
ASKED = "qid long, embedding array<float>"


def clustered(rng, n, middles):
    """Points around a few middles, a third of them copies of one, some not numbers."""
    points = middles[rng.integers(0, len(middles), n)] + rng.normal(scale=0.05, size=(n, middles.shape[1]))
    points[::3] = points[0]
    rows = [(i, [float(v) for v in p.astype(np.float32)]) for i, p in enumerate(points)]
    rows += [(n + i, [x] + [0.0] * (middles.shape[1] - 1)) for i, x in enumerate([math.nan, math.inf, None])]
    return [*rows, (n + 9, None), (None, rows[0][1])]


def same(index, asked, corpus, k=4):
    got = index.search(asked, "qid", k)
    want = nearest(asked, corpus, question_id="qid", corpus_id="cid", k=k)
    assert got.columns == want.columns
    rows = [sorted(map(str, df.collect())) for df in (got, want)]
    assert rows[0] == rows[1]
    return rows[0]


@pytest.fixture(scope="module")
def clusters(spark, tmp_path_factory):
    rng = np.random.default_rng(7)
    middles = rng.normal(scale=10, size=(40, 8))
    corpus = spark.createDataFrame(clustered(rng, 3000, middles), ID).repartition(5).cache()
    index = CellIndex(spark, str(tmp_path_factory.mktemp("cells") / "index"), "cid").build(corpus, cells=40)
    return middles, corpus, index


def test_few_cells_are_read_for_a_question_near_some_vectors(spark, clusters):
    middles, corpus, index = clusters
    asked = spark.createDataFrame([(1, [float(v) for v in middles[3] + 0.01])], ASKED)
    assert len(same(index, asked, corpus)) == 4
    read = index.read[-1]
    assert read["of_rows"] == 3003 and read["cells"] <= 4 and read["cells"] < read["of_cells"] / 5
    plan = index._nearest(asked, [1, 2], "qid", 4)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan


@pytest.mark.parametrize("k", [1, 4, 1500])
def test_the_same_neighbours_wherever_the_question(spark, clusters, k):
    middles, corpus, index = clusters
    rng = np.random.default_rng(k)
    points = np.concatenate([middles[:5], rng.normal(scale=10, size=(6, 8)), np.zeros((1, 8)), [[1e6] * 8]])
    asked = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(points)], ASKED)
    same(index, asked, corpus, k)


def test_blocks_of_questions(spark, clusters, monkeypatch):
    middles, corpus, index = clusters
    monkeypatch.setattr(module, "_FEW", 7)
    asked = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(middles[:20])], ASKED)
    assert len(same(index, asked, corpus)) == 80


def test_vectors_that_are_not_numbers_come_last(spark, clusters, tmp_path):
    _, corpus, _ = clusters
    few = corpus.where("cid in (1, 2) or cid >= 3000 or cid is null")
    index = CellIndex(spark, str(tmp_path / "few"), "cid").build(few)
    asked = spark.createDataFrame([(1, [0.0] * 8)], ASKED)
    assert len(same(index, asked, few)) == 4


def test_copies_nothing_and_wrong_widths(spark, tmp_path, clusters):
    copies = spark.range(500).select(F.col("id").alias("cid"), F.expr("array(float(1), float(2))").alias("embedding"))
    index = CellIndex(spark, str(tmp_path / "copies"), "cid").build(copies)
    asked = spark.createDataFrame([(1, [1.0, 2.0])], ASKED)
    assert len(same(index, asked, copies)) == 4
    assert index.search(asked.where("false"), "qid").count() == 0
    with pytest.raises(ValueError, match="numbers"):
        index.search(spark.createDataFrame([(1, [1.0])], ASKED), "qid")
    with pytest.raises(ValueError, match="1 to 2 numbers"):
        CellIndex(spark, str(tmp_path / "bad"), "cid").build(
            copies.unionByName(spark.createDataFrame([(9, [1.0])], ID)))
    none = CellIndex(spark, str(tmp_path / "none"), "cid").build(copies.where("false"))
    assert none.search(asked, "qid").count() == 0


def test_every_vector_is_in_one_cell(clusters):
    _, corpus, index = clusters
    rows = index._vectors()
    assert rows.count() == rows.select("cid").distinct().count() == 3003
    assert rows.where("cell = -1").count() == 3
