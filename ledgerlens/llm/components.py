"""Connected components of a graph given by its edges, by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Nothing is collected: each round is joins and
aggregates over the edges, written to the shared folder, until the edges no longer change. A node may be the centre of a star of
most edges, so its edges are dealt over ``SALTS`` parts in every join; the smallest neighbours, one row a node, are repeated for each part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, shared_dir, written


SALTS = 16


def _with_least(edges: DataFrame, low: DataFrame, node: str, other: str) -> DataFrame:
    """edges with the column m that low has for node."""
    parts = low.select(F.col(node).alias("at_"), "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part_"))
    dealt = edges.withColumn("salt_", F.pmod(F.xxhash64(F.lit("salt"), other), F.lit(SALTS)).cast("int"))
    return dealt.join(parts, (F.col(node) == F.col("at_")) & (F.col("salt_") == F.col("part_"))).drop("at_", "part_", "salt_")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("x", "y"))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has an edge to another node; root is the smallest node of the component.

    Null ends and loops are ignored; repeated edges count once; no edges give an empty result.
    """
    spark = edges.sparkSession
    folder, k = f"{shared_dir(spark)}/components-{uuid.uuid4().hex}", 0
    ends = edges.select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).where("x <> y")
    now = written(ends.distinct(), f"{folder}/{k}")
    state = _state(now)
    while state[0]:
        both = now.select(F.explode(F.array(F.struct(F.col("x").alias("u"), F.col("y").alias("v")), F.struct(F.col("y").alias("u"), F.col("x").alias("v")))).alias("e")).select("e.*")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _with_least(both.where("v > u"), low, "u", "v").select(F.col("v").alias("x"), F.col("m").alias("y"))
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = _with_least(large, low, "x", "y").select(F.explode(F.array(F.struct("x", F.col("m").alias("y")), F.struct(F.col("y").alias("x"), F.col("m").alias("y")))).alias("e")).select("e.*")
        now = written(small.where("x <> y").distinct(), f"{folder}/{k + 1}")
        remove(spark, f"{folder}/{k}")
        before, state, k = state, _state(now), k + 1
        if before == state:
            break
    return now.select(F.col("x").alias("node"), F.col("y").alias("root"))
