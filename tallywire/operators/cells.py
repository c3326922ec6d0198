"""Exact neighbours from an index of cells, most of which a question need not read.

Every vector belongs to the cell of a centroid. By the triangle inequality no vector of a cell
is nearer to a question than the centroid is, less the cell's radius; cells farther than the
k-th neighbour found so far are not read. Centroids decide what is read, never what is found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallywire.operators.nearest import (
    DEFAULT_K, DISTANCE_DECIMALS, _FEW, _checked, _merge, nearest, vector_table,
)
from tallywire.operators.ranking import with_rank
from tallywire.storage import materialize, scratch_path

# Centroids are fitted on at most so many vectors, chosen by a hash of their ids.
FIT_SAMPLE = 50_000
MOST_CELLS = 4096
_CENTROID_BYTES = 32 << 20
_FIT_ROUNDS = 8
# The cell of vectors with NaN, infinity or null: after all others, whatever the question.
_NOWHERE = -1


@dataclass
class CellIndex:
    """A folder with vectors by cell, and a table of the cells.

    ``read`` tells of each search since the index was opened how many cells and rows it read.
    """

    spark: SparkSession
    path: str
    vector_id: str
    vector: str = "embedding"
    read: list[dict[str, int]] = field(default_factory=list)

    def build(self, vectors: DataFrame, cells: int | None = None, sample: int = FIT_SAMPLE) -> CellIndex:
        """Write every vector with an id to its cell; by default as many cells as the root of their number.

        Vectors must be of one width. The cells' number is bounded, so that the centroids fit
        in every task. A cell that holds very many vectors is written by several tasks.
        """
        table = vector_table(vectors, self.vector_id, self.vector).where(
            F.col(self.vector_id).isNotNull())
        finite = F.forall(self.vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        width = F.size(self.vector)
        about = table.agg(F.count_if(finite).alias("n"), F.min(width).alias("narrow"),
                          F.max(width).alias("wide")).first()
        if about["narrow"] != about["wide"]:
            raise ValueError(f"vectors have {about['narrow']} to {about['wide']} numbers")
        n, wide = about["n"], about["wide"] or 1
        cells = min(max(2, cells or math.isqrt(n)), MOST_CELLS, max(2, _CENTROID_BYTES // (8 * wide)))
        million = 1_000_000
        chosen = F.pmod(F.xxhash64(self.vector_id), F.lit(million)) < math.ceil(million * min(1, sample / max(1, n)))
        fitted = table.where(finite).where(chosen).select(array_to_vector(self.vector).alias("features"))
        centroids = self._fitted(fitted, cells, wide) if n else np.zeros((1, wide))
        shared = self.spark.sparkContext.broadcast(centroids)
        placed = self._placed(table, shared)
        self.spark.createDataFrame([], placed.schema).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/shape")
        # Dealt out by cell, as many tasks for each as its size asks for.
        (placed.hint("rebalance", "cell")
         .write.mode("overwrite").partitionBy("cell").parquet(f"{self.path}/vectors"))
        sizes = self._vectors().groupBy("cell").agg(F.max("gap").alias("radius"), F.count("*").alias("rows"))
        known = self.spark.createDataFrame(
            [(number, point.tolist()) for number, point in enumerate(centroids)],
            "cell int, centroid array<double>")
        (sizes.join(known, "cell", "left").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/cells"))
        return self

    def _fitted(self, sample: DataFrame, cells: int, width: int) -> np.ndarray:
        rows = materialize(sample, "cells-sample")
        n = rows.count()
        if n <= cells:
            points = [row.features.toArray() for row in rows.collect()]
            return np.array(points) if points else np.zeros((1, width))
        model = KMeans(k=cells, maxIter=_FIT_ROUNDS, seed=1).fit(rows)
        return np.array(model.clusterCenters())

    def _vectors(self) -> DataFrame:
        # With the declared columns, as there may be no file.
        shape = self.spark.read.parquet(f"{self.path}/shape").schema
        return self.spark.read.schema(shape).parquet(f"{self.path}/vectors")

    def _placed(self, table: DataFrame, shared) -> DataFrame:
        """Each vector with its cell and its distance from the centroid, a little rounded up."""
        shape = T.StructType([*table.schema.fields, T.StructField("cell", T.IntegerType()),
                              T.StructField("gap", T.DoubleType())])
        schema = to_arrow_schema(shape)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centroids = shared.value
            square = (centroids * centroids).sum(axis=1)
            for batch in batches:
                if not batch.num_rows:
                    continue
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                x = flat.astype(np.float64).reshape(batch.num_rows, -1)
                usable = np.isfinite(x).all(axis=1)
                x = np.where(usable[:, None], x, 0.0)
                cell = np.argmin(square - 2 * (x @ centroids.T), axis=1)
                gap = np.sqrt(((x - centroids[cell]) ** 2).sum(axis=1)) * (1 + 1e-9)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.where(usable, cell, _NOWHERE), pa.int32()),
                     pa.array(np.where(usable, gap, 0.0))], schema=schema)

        return table.mapInArrow(place, shape)

    def search(self, questions: DataFrame, question_id: str, k: int = DEFAULT_K) -> DataFrame:
        """The ``k`` nearest rows of each question: question, row, distance, rank, as ``nearest`` has them.

        First the cells around each question are read, as many as hold k vectors; then those that
        may hold nearer ones than these. Questions are taken in blocks of bounded number.
        """
        cells = self.spark.read.parquet(f"{self.path}/cells").orderBy("cell").collect()
        asked = questions.where(F.col(self.vector).isNotNull()).select(question_id, self.vector)
        rows = asked.limit(_FEW + 1).toArrow()
        if rows.num_rows <= _FEW:
            return self._searched(asked, rows, cells, question_id, k)
        numbered = materialize(with_rank(asked, [F.col(question_id)], "_rank").withColumn(
            "_block", F.expr(f"int((_rank - 1) div {_FEW})")).drop("_rank"), "question-blocks",
            partition_by="_block")
        answers = scratch_path(self.spark, "cells")
        last = numbered.agg(F.max("_block")).first()[0]
        for block in range(last + 1):
            part = numbered.where(F.col("_block") == block).drop("_block")
            found = self._searched(part, part.toArrow(), cells, question_id, k)
            found.write.mode("overwrite").parquet(f"{answers}/block={block}")
        return self.spark.read.schema(found.schema).parquet(answers).drop("block")

    def _searched(self, asked: DataFrame, rows: pa.Table, cells: list, question_id: str, k: int) -> DataFrame:
        ids, points = _checked(rows, question_id, self.vector)
        spots = [cell for cell in cells if cell["cell"] != _NOWHERE]
        every = [cell["cell"] for cell in cells]
        if not ids or not spots:
            return self._nearest(asked, every, question_id, k)
        centroids = np.array([cell["centroid"] for cell in spots])
        if centroids.shape[1] != points.shape[1]:
            raise ValueError(f"corpus vectors have {centroids.shape[1]} numbers, "
                             f"question vectors {points.shape[1]}")
        number = np.array([cell["cell"] for cell in spots])
        size = np.array([cell["rows"] for cell in spots])
        far = np.stack([np.sqrt(((centroids - point) ** 2).sum(axis=1)) for point in points])
        bound = far * (1 - 1e-9) - np.array([cell["radius"] for cell in spots])
        if size.sum() < k:
            return self._noted(every, cells, self._nearest(asked, every, question_id, k))
        order = np.argsort(far, axis=1, kind="stable")
        enough = np.cumsum(size[order], axis=1) >= k
        first = np.zeros(len(spots), bool)
        for row, places in zip(enough, order):
            first[places[:int(row.argmax()) + 1]] = True
        found = materialize(self._nearest(asked, number[first].tolist(), question_id, k), "cells")
        reach = dict(found.where(F.col("rank") == k).select(question_id, "distance").toArrow().to_pandas()
                     .itertuples(index=False, name=None))
        limit = np.array([reach[i] for i in ids]) + 2 * 10.0 ** -DISTANCE_DECIMALS
        more = (bound <= limit[:, None]).any(axis=0) & ~first
        self._noted(number[first | more].tolist(), cells, found)
        if not more.any():
            return found
        rest = self._nearest(asked, number[more].tolist(), question_id, k)
        return _merge(found.unionByName(rest).drop("rank"), question_id, self.vector_id, k)

    def _noted(self, chosen: list[int], cells: list, found: DataFrame) -> DataFrame:
        self.read.append({"cells": len(chosen), "of_cells": len(cells),
                          "rows": sum(c["rows"] for c in cells if c["cell"] in set(chosen)),
                          "of_rows": sum(c["rows"] for c in cells)})
        return found

    def _nearest(self, asked: DataFrame, chosen: list[int], question_id: str, k: int) -> DataFrame:
        rows = self._vectors().where(F.col("cell").isin(chosen)).select(self.vector_id, self.vector)
        return nearest(asked, rows, question_id=question_id, corpus_id=self.vector_id,
                       vector=self.vector, k=k)
