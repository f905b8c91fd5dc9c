"""Helpers shared by the corpus operators."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read through Spark so that any store works; a file of fewer splits than cores is dealt over the cores."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it.

    Where the session names none, a temporary one is made if all runs in this process (a local master); on a cluster that is an
    error, as each machine would write to a folder of its own.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="ckpt-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder, once, and go on from the files."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, folder: str) -> DataFrame:
    """Write df as Parquet to a folder, and go on from the files.

    For loops: a checkpoint keeps the planner's estimate of its size, and estimates of joins are products, so after some rounds
    they have more digits than the planner can multiply; files have their own size.
    """
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder that ``written`` made, in whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also where body uses it inside other lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Array of the maximal runs of non-separators in the whole text; null gives an empty array."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\t-\r]", " ")
    return F.array_remove(F.split(spaced, " "), "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like names that df does not use yet (comparison ignores case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def refuse(df: DataFrame, out: str) -> None:
    """An error where df has a column of this name already (comparison ignores case), which the result would hide."""
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the column {out} exists already; choose another name by out=")


def bounded_batches(spark: SparkSession, rows: int = 256) -> None:
    """Hold Arrow batches to so many rows, so that a batch of very long texts still fits a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
