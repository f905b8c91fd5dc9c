"""Scorecard counters over a stream of new panel rows.

Fill counts and rule counts are sums, so a stream of quarterly deliveries keeps them up to date with a grouped aggregate; late rows are
accepted for as long as the watermark says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.scorecard import annotate, filled
from ..schema import FUND, MANDATORY


def landing(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def fill_counters(rows: DataFrame, arrived: str, lateness: str = "90 days") -> DataFrame:
    """By fund and month of arrival: scorable rows, filled cells and all cells. arrived may be a timestamp without zone."""
    timed = annotate(rows).where("is_scorable").withColumn("arrived_", F.col(arrived).cast("timestamp")).withWatermark("arrived_", lateness)
    out = timed.groupBy(F.window("arrived_", "30 days").alias("w"), FUND).agg(F.count("*").alias("n_rows"), F.sum(filled()).alias("filled_cells"))
    return out.select(FUND, F.col("w.start").alias("from"), "n_rows", "filled_cells", (F.col("n_rows") * len(MANDATORY)).alias("cells"))
