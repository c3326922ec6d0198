"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.storage import materialize


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, label`` of every node with an edge to another; the label is its least node.

    Large-star and small-star steps alternate until nothing changes. Both only look at a
    node's least neighbour, which is a grouped minimum joined back, so a node with very
    many edges is no task of its own. Each round is a stored table.
    """
    pairs = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
        .distinct(), "components")
    before = _state(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"),
                                                            F.col("m").alias("v")).distinct()
        large = materialize(large, "components")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        pairs = materialize(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.withColumnRenamed("m", "v")).distinct(), "components")
        after = _state(pairs)
        if after == before:
            break
        before = after
    stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("label"))
    centers = pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return stars.unionByName(centers)
