"""Exact nearest neighbours by Euclidean distance."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallywire.operators.ranking import with_rank
from tallywire.storage import materialize, scratch_path

# Fixed value: documents handed to an answer.
DEFAULT_K = 4
# Distances are compared after rounding, equal ones by id, so that summation
# order cannot decide between neighbours.
DISTANCE_DECIMALS = 6

_BLOCK_BYTES = 16 << 20
# So many questions are taken without measuring them first.
_FEW = 512
_MERGE_GROUPS = 64


def vector_table(vectors: DataFrame, vector_id: str, vector: str) -> DataFrame:
    """The searchable table: an id and an ``array<float>`` per row, null vectors left out."""
    return vectors.where(F.col(vector).isNotNull()).select(
        vector_id, F.col(vector).cast("array<float>").alias(vector)
    )


def nearest(
    questions: DataFrame,
    corpus: DataFrame,
    *,
    question_id: str,
    corpus_id: str,
    vector: str = "embedding",
    k: int = DEFAULT_K,
    block_bytes: int = _BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` corpus rows closest to each question: question, row, distance, rank.

    Question ids must be unique, and question vectors finite and of one width, which corpus
    vectors must share; anything else raises, whatever the sizes. A corpus vector with a
    NaN, an infinity or a null element (taken as NaN) has that distance, and comes after all
    finite ones; corpus rows without an id or a vector are left out.

    The corpus stays where it is: each task holds a block of question vectors, runs once
    over its own rows and keeps k per question, so no (question, row) pair is ever a Spark
    row and only k rows per task and question are shuffled. The block is broadcast, so its
    size is measured first; more questions than fit in ``block_bytes`` are answered in
    several blocks, each a further run over the corpus whose result is written before the
    next begins. A pass over a full block costs far more in products than in reading, so
    fewer passes would gain little and the memory of a task stays bounded by the block.
    A few hundred questions of a bounded size are read once, checked where they are, and not
    written.
    """
    spark = corpus.sparkSession
    asked = questions.where(F.col(vector).isNotNull()).select(question_id, vector)
    searched = corpus.where(F.col(vector).isNotNull() & F.col(corpus_id).isNotNull()).select(
        corpus_id, vector)
    output = T.StructType([
        T.StructField(question_id, asked.schema[question_id].dataType),
        T.StructField(corpus_id, searched.schema[corpus_id].dataType),
        T.StructField("distance", T.DoubleType()),
    ])

    rows = asked.limit(_FEW + 1).toArrow()
    if rows.num_rows <= _FEW and rows.nbytes <= block_bytes // 2:
        shared = spark.sparkContext.broadcast(_checked(rows, question_id, vector))
        return _merge(_search(shared, searched, output, k), question_id, corpus_id, k)

    asked = materialize(asked, "questions")
    width, id_bytes = F.size(vector), F.octet_length(F.col(question_id).cast("string"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x.cast("double")) < float("inf")))
    size = asked.agg(
        F.count("*").alias("n"), F.count_if(~finite).alias("unusable"),
        F.min(width).alias("narrow"), F.max(width).alias("wide"),
        F.max(id_bytes).alias("id_bytes"),
    ).first()
    if size["narrow"] != size["wide"]:
        raise ValueError(f"question vectors have {size['narrow']} to {size['wide']} numbers")
    if size["unusable"]:
        raise ValueError(f"{size['unusable']} question vectors hold NaN, infinity or null")
    if not asked.groupBy(question_id).count().where("count > 1").isEmpty():
        raise ValueError(f"{question_id} is not unique")
    row_bytes = 8 * (size["wide"] or 0) + (size["id_bytes"] or 0) + 1
    per_block = max(1, block_bytes // row_bytes)

    if size["n"] <= per_block:
        shared = _share(asked, question_id, vector)
        found = _search(shared, searched, output, k)
        return _merge(found, question_id, corpus_id, k)

    # Blocks of equal size by position, so that there are no more passes than the bound asks for.
    blocks = math.ceil(size["n"] / per_block)
    ranked = with_rank(asked, [F.col(question_id)], "_rank")
    asked = materialize(
        ranked.withColumn("_block", F.expr(f"int((_rank - 1) div {per_block})")).drop("_rank"),
        "question-blocks", partition_by="_block")
    answers = scratch_path(spark, "nearest")
    for number in range(blocks):
        shared = _share(asked.where(F.col("_block") == number), question_id, vector)
        found = _search(shared, searched, output, k)
        _merge(found, question_id, corpus_id, k).write.mode("overwrite").parquet(
            f"{answers}/block={number}"
        )
        shared.destroy()
    ranked = output.add("rank", T.IntegerType())
    return spark.read.schema(ranked).parquet(answers).drop("block")


def _checked(rows, question_id: str, vector: str) -> tuple:
    """Ids and vectors of a few questions, which are refused as many would be."""
    import numpy as np

    ids = rows.column(question_id).to_pylist()
    vectors = rows.column(vector).combine_chunks()
    widths = np.unique(vectors.value_lengths().to_numpy(zero_copy_only=False))
    if len(widths) > 1:
        raise ValueError(f"question vectors have {widths[0]} to {widths[-1]} numbers")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    points = flat.reshape(len(ids), -1) if ids else flat
    unusable = int((~np.isfinite(points)).any(axis=1).sum()) if ids else 0
    if unusable:
        raise ValueError(f"{unusable} question vectors hold NaN, infinity or null")
    if len(set(ids)) < len(ids):
        raise ValueError(f"{question_id} is not unique")
    return ids, points


def _share(block: DataFrame, question_id: str, vector: str) -> Broadcast:
    """Ids and vectors of a block whose size has been checked, on every executor."""
    rows = block.select(question_id, F.col(vector).cast("array<double>")).toArrow()
    ids = rows.column(question_id).to_pylist()
    flat = rows.column(vector).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    points = flat.reshape(len(ids), -1) if ids else flat
    return block.sparkSession.sparkContext.broadcast((ids, points))


def _search(shared: Broadcast, corpus: DataFrame, output: T.StructType, k: int) -> DataFrame:
    """Per task, the best k rows for every question of the block."""
    decimals = DISTANCE_DECIMALS
    schema = to_arrow_schema(output)

    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        asked_ids, q = shared.value
        if not asked_ids:
            return
        q_norm = (q * q).sum(axis=1)
        best: list[list[tuple]] = [[] for _ in asked_ids]
        reach = np.full(len(asked_ids), np.inf)
        # Two distances that round alike differ by less than this.
        slack = 2 * 10.0 ** -decimals
        # Bound on the relative error of a squared distance taken from products.
        unsure = 4 * (q.shape[1] + 8) * np.finfo(np.float64).eps

        def keep_far(ids, x) -> None:
            """Rows at no finite distance; only questions short of k keep them."""
            nan = np.isnan(x).any(axis=1)
            order = np.lexsort((ids, nan))[:k]
            fresh = [(float("nan") if nan[i] else float("inf"), ids[i]) for i in order]
            far[:] = sorted(far + fresh, key=lambda hit: (hit[0] != hit[0], hit[1]))[:k]

        far: list[tuple] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            widths = np.unique(batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
            if widths.tolist() != [q.shape[1]]:
                raise ValueError(f"corpus vectors have {widths.min()} to {widths.max()} numbers, "
                                 f"question vectors {q.shape[1]}")
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            x = flat.astype(np.float64).reshape(len(ids), q.shape[1])
            finite = np.isfinite(x).all(axis=1)
            if not finite.all():
                keep_far(ids[~finite], x[~finite])
                ids, x = ids[finite], x[finite]
                if not len(ids):
                    continue
            x_norm = (x * x).sum(axis=1)
            error = unsure * (q_norm + x_norm.max())
            step = max(1, (4 << 20) // len(ids))
            for start in range(0, len(asked_ids), step):
                part = slice(start, start + step)
                # Squared distances by matrix product: fast, but inexact where they are
                # small, so they only tell which rows are worth an exact distance.
                rough = q_norm[part, None] + x_norm[None, :] - 2.0 * (q[part] @ x.T)
                limit = reach[part]
                if len(ids) > k:
                    kth = np.partition(rough, k - 1, axis=1)[:, k - 1]
                    limit = np.minimum(limit, np.sqrt(np.maximum(kth, 0.0) + error[part]))
                limit = (limit + slack) ** 2 + error[part]
                for row in np.flatnonzero(rough.min(axis=1) <= limit):
                    at = start + row
                    close = np.flatnonzero(rough[row] <= limit[row])
                    gap = x[close] - q[at]
                    exact = np.round(np.sqrt((gap * gap).sum(axis=1)), decimals)
                    order = np.lexsort((ids[close], exact))[:k]
                    fresh = [(float(exact[i]), ids[close[i]]) for i in order]
                    best[at] = sorted(best[at] + fresh)[:k]
                    if len(best[at]) == k:
                        reach[at] = best[at][-1][0]

        for at in range(len(asked_ids) if far else 0):
            best[at] = best[at] + far[:k - len(best[at])]
        for start in range(0, len(asked_ids), 4096):
            hits = [
                (asked_ids[at], row_id, distance)
                for at in range(start, min(start + 4096, len(asked_ids)))
                for distance, row_id in best[at]
            ]
            if hits:
                arrays = [pa.array(list(values), type=field.type)
                          for values, field in zip(zip(*hits), schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return corpus.mapInArrow(search, output)


def _merge(found: DataFrame, question_id: str, corpus_id: str, k: int) -> DataFrame:
    """Best k per question out of the tasks' best k.

    Merged in two levels: with very many tasks the rows for one question would
    otherwise all meet in one reducer.
    """
    nearest_first = [F.col("distance"), F.col(corpus_id)]
    group = (F.spark_partition_id() % _MERGE_GROUPS).alias("_group")
    within = Window.partitionBy(question_id, "_group").orderBy(*nearest_first)
    overall = Window.partitionBy(question_id).orderBy(*nearest_first)
    return (
        found.select("*", group)
        .withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= k)
        .drop("_group")
        .withColumn("rank", F.row_number().over(overall)).where(F.col("rank") <= k)
    )
