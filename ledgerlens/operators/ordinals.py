"""Running totals over all values of a column, without a task that holds them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(values: DataFrame, value: str, weight: Column, out: str, ranges: int = 256) -> DataFrame:
    """values (distinct numbers, no nulls) with ``out``: the sum of weight over all rows up to and with this one, by value ascending.

    The values are cut into ranges at approximate quantiles, which only have to be about equal: each range is a window of its own, and
    what lies below it is one sum a range. The row of quantiles and the row of sums are broadcast; both have ``ranges`` entries at most.
    """
    cuts = values.agg(F.percentile_approx(F.col(value).cast("double"), [i / ranges for i in range(1, ranges)], 10 * ranges).alias("cuts_"))
    dealt = values.withColumn("weight_", weight).crossJoin(F.broadcast(cuts)).withColumn("range_", F.size(F.filter("cuts_", lambda c: c < F.col(value)))).drop("cuts_")
    sums = dealt.groupBy("range_").agg(F.sum("weight_").alias("s")).agg(F.collect_list(F.struct("range_", "s")).alias("sums_"))
    inside = F.sum("weight_").over(Window.partitionBy("range_").orderBy(value))
    below = F.aggregate(F.filter("sums_", lambda r: r["range_"] < F.col("range_")), F.lit(0).cast("long"), lambda t, r: t + r["s"])
    return dealt.withColumn(out, inside).crossJoin(F.broadcast(sums)).withColumn(out, F.col(out) + below).drop("weight_", "range_", "sums_")
