"""Numbers without gaps inside each key, without a task that holds a whole key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh


def numbered(rows: DataFrame, keys: list[str], order: list[Column], out: str, per_block: int = 1_000) -> DataFrame:
    """rows with a long column ``out``: 0, 1, 2 .. inside each combination of keys, the same at every run.

    A key's rows are spread over blocks by a hash of the order columns, about ``per_block`` rows in each; a row's number is its place
    in its block plus the sizes of the blocks before. Only rows that agree in all order columns may swap numbers.
    """
    block, first, n = fresh(rows, "block_", "first_", "n_")
    sizes = rows.groupBy(*keys).agg(F.count("*").alias(n)).select(*[F.col(k).alias(f"{k}_s") for k in keys], n)
    same = lambda a, b: reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{k}{b}")) for k in keys])  # noqa: E731, ARG005
    spread = rows.join(sizes, same("", "_s")).drop(*[f"{k}_s" for k in keys])
    # Hashes of the order columns are unlike those that deal rows to tasks, as they start from another seed.
    spread = spread.withColumn(block, F.pmod(F.xxhash64(F.lit("block"), *order), F.greatest(F.ceil(F.col(n) / per_block), F.lit(1)))).drop(n)
    counts = spread.groupBy(*keys, block).agg(F.count("*").alias(n))
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(*[F.col(k).alias(f"{k}_f") for k in keys], F.col(block).alias(f"{block}_f"), F.coalesce(F.sum(n).over(before), F.lit(0)).alias(first))
    place = F.row_number().over(Window.partitionBy(*keys, block).orderBy(*order))
    placed = spread.withColumn(out, place).join(firsts, same("", "_f") & (F.col(block) == F.col(f"{block}_f")))
    return placed.withColumn(out, (F.col(out) - 1 + F.col(first)).cast("long")).drop(first, block, f"{block}_f", *[f"{k}_f" for k in keys])
