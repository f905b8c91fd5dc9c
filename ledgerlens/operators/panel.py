"""Reporting cadence and gaps of panel series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import AS_AT, ASSET, FUND


def calendars(real: DataFrame) -> DataFrame:
    """(fund, dates): the dates on which a fund reported, ascending."""
    return real.where(F.col(FUND).isNotNull()).groupBy(FUND).agg(F.sort_array(F.collect_set(AS_AT)).alias("dates"))


def _median_gap(dates: Column) -> Column:
    """Median days between neighbours; null for one date."""
    gaps = F.sort_array(F.transform(F.slice(dates, 2, F.greatest(F.size(dates) - 1, F.lit(0))), lambda d, i: F.datediff(d, F.get(dates, i))))
    n = F.size(gaps)
    middle = lambda k: F.get(gaps, k.cast("int"))
    return F.when(n > 0, (middle(F.floor((n - 1) / 2)) + middle(F.floor(n / 2))) / 2)


def cadence(real: DataFrame, quarterly: int = 100, semi_annual: int = 200) -> DataFrame:
    gap = F.col("median_gap")
    kind = F.when(gap.isNull(), "single-period").when(gap <= quarterly, "quarterly").when(gap <= semi_annual, "semi-annual").otherwise("annual")
    return calendars(real).select(FUND, F.size("dates").alias("n_dates"), _median_gap(F.col("dates")).alias("median_gap")).withColumn("cadence", kind)


def with_cadence(real: DataFrame) -> DataFrame:
    """real with n_dates, median_gap and cadence of its fund; null for rows without a fund."""
    return real.join(cadence(real), FUND, "left")


def series(real: DataFrame) -> DataFrame:
    rows = real.where(F.col(FUND).isNotNull() & F.col(ASSET).isNotNull())
    return rows.groupBy(FUND, ASSET).agg(F.min(AS_AT).alias("first"), F.max(AS_AT).alias("last"), F.countDistinct(AS_AT).alias("n_periods"))


def reporting_gaps(real: DataFrame) -> DataFrame:
    """Series that miss dates of their own fund's calendar between their first and last date."""
    expected = F.size(F.filter("dates", lambda d: (d >= F.col("first")) & (d <= F.col("last"))))
    out = series(real).join(calendars(real), FUND).withColumn("expected", expected).withColumn("gap_periods", F.col("expected") - F.col("n_periods"))
    return out.where("gap_periods > 0").drop("dates")


def date_rank(real: DataFrame) -> DataFrame:
    """Ordinal of each date among all dates of the panel. The window is over the dates, which are few."""
    return real.select(AS_AT).where(F.col(AS_AT).isNotNull()).distinct().withColumn("date_rank", F.row_number().over(Window.orderBy(AS_AT)) - 1)


def naive_grid_gaps(real: DataFrame) -> DataFrame:
    """Series that a grid of all dates would call incomplete."""
    ranks = F.broadcast(date_rank(real))
    first, last = (ranks.select(F.col(AS_AT).alias(c), F.col("date_rank").alias(f"r_{c}")) for c in ("first", "last"))
    missing = (F.col("r_last") - F.col("r_first") + 1 - F.col("n_periods")).alias("missing_periods")
    return series(real).join(first, "first").join(last, "last").select(FUND, ASSET, missing).where("missing_periods > 0")
