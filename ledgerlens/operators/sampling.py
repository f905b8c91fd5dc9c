"""Diverse validation samples of funds: eligibility, greedy selection, groups and their diagnostics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import PREFIX_ONLY, WIDE, truthy
from ..schema import AS_AT, ASSET, FUND, MANAGER
from .ordinals import running_total
from .scorecard import completeness, count_if, investment_key


@dataclass(frozen=True)
class SampleParams:
    least: int = 6
    most: int = 30
    wind_down: float = 0.30
    size_ratio: float = 10.0
    shortlist: int = 5
    n_high: int = 6
    n_low: int = 6
    n_random: int = 5
    seed: int = 42


def real_by_prefix(panel: DataFrame) -> DataFrame:
    """Rows whose name hasn't the prefix of a balance sheet line; this population is wider than that of the classifier."""
    return panel.where(~truthy(F.col(ASSET).rlike(WIDE + PREFIX_ONLY)))


def fund_stats(panel: DataFrame, date, p: SampleParams = SampleParams()) -> DataFrame:  # noqa: ANN001
    """Statistics of each fund at a date, with its greatest number of investments at any date and whether it winds down."""
    real = ~truthy(F.col(ASSET).rlike(WIDE + PREFIX_ONLY))
    key = F.when(real, investment_key())
    by_date = panel.where(F.col(FUND).isNotNull()).groupBy(FUND, AS_AT).agg(F.countDistinct(key).alias("n"), F.count("*").alias("rows"), count_if(real).alias("real"))
    peak = by_date.groupBy(FUND).agg(F.max("n").alias("peak_investments"), *[F.coalesce(F.max(F.when(F.col(AS_AT) == date, F.col(c))), F.lit(0)).alias(o) for c, o in (("n", "n_real_investments"), ("rows", "n_total_rows"), ("real", "n_real_rows"))])
    now = panel.where((F.col(AS_AT) == date) & real & F.col(FUND).isNotNull()).groupBy(FUND).agg(F.mode(MANAGER, True).alias(MANAGER), F.mode("type_of_investment", True).alias("type_of_investment"), F.round(F.sum("total_value"), 2).alias("portfolio_total_value"), completeness().alias("completeness"))
    out = peak.join(now, FUND, "left")
    return out.withColumn("wind_down", (F.col("peak_investments") > 0) & (F.col("n_real_investments") < F.col("peak_investments") * p.wind_down))


def eligible(stats: DataFrame, p: SampleParams = SampleParams()) -> DataFrame:
    return stats.where((F.col("n_real_rows") >= 1) & F.col("n_real_investments").between(p.least, p.most))


def eligibility_funnel(stats: DataFrame, p: SampleParams = SampleParams()) -> DataFrame:
    n, real = F.col("n_real_investments"), F.col("n_real_rows") >= 1
    ok = real & n.between(p.least, p.most)
    return stats.agg(count_if(F.col("n_total_rows") > 0).alias("on_date"), count_if(real).alias("with_real"), count_if(ok).alias("eligible"), count_if(real & (n < p.least)).alias("too_few"), count_if(real & (n > p.most)).alias("too_many"), count_if(ok & F.col("wind_down")).alias("winding_down"))


def tiers(funds: DataFrame) -> DataFrame:
    """Funds with their tier: distinct scores from the best. The scores are counted in ranges, no task sorts them all; none, no tier."""
    scores = running_total(funds.where("completeness is not null").select((-F.col("completeness")).alias("below")).distinct(), "below", F.lit(1), "tier")
    return funds.join(scores.select((-F.col("below")).alias("completeness"), F.col("tier").cast("int").alias("tier")), "completeness")


def select_diverse(candidates: pd.DataFrame, n: int, taken: pd.DataFrame | None = None, p: SampleParams = SampleParams()) -> pd.DataFrame:
    """Greedy choice in the order given: one fund of a manager over all groups; funds that wind down come last; in each tier of equal scores
    first those of a new type and a size near the median of the chosen, then the rest."""
    used = set() if taken is None else set(taken[FUND])
    managers = set() if taken is None else set(taken[MANAGER].dropna())
    pool = candidates[~candidates[FUND].isin(used)]
    pool = pool.sort_values("wind_down", kind="stable") if len(pool) else pool
    short: list = []
    for row in pool.itertuples(index=False):
        who = getattr(row, MANAGER)
        if pd.notna(who) and who in managers:
            continue
        if row.completeness != pool.iloc[0]["completeness"] and len(short) >= n * p.shortlist:
            break
        short.append(row)
        managers.add(who)
    chosen: list = []
    types: set = set()
    sizes: list[float] = []

    def fits(row) -> bool:  # noqa: ANN001
        if pd.notna(row.type_of_investment) and row.type_of_investment in types:
            return False
        size = row.portfolio_total_value
        if pd.isna(size) or size <= 0 or not sizes or (middle := float(np.median(sizes))) <= 0:
            return True
        return max(size / middle, middle / size) <= p.size_ratio

    def take(row) -> None:  # noqa: ANN001
        chosen.append(row)
        if pd.notna(row.type_of_investment):
            types.add(row.type_of_investment)
        if pd.notna(row.portfolio_total_value) and row.portfolio_total_value > 0:
            sizes.append(float(row.portfolio_total_value))

    for score in dict.fromkeys(r.completeness for r in short):
        tier, later = [r for r in short if r.completeness == score], []
        for row in tier:
            if len(chosen) < n and fits(row):
                take(row)
            else:
                later.append(row)
        for row in later[: max(0, n - len(chosen))]:
            take(row)
    return pd.DataFrame(chosen[:n], columns=candidates.columns)


def diverse_sample(funds: DataFrame, p: SampleParams = SampleParams(), most_funds: int = 100_000) -> DataFrame:
    """High, low and random groups of the eligible funds, chosen on the driver one after another.

    Greedy choice is sequential. It runs on one row for each eligible fund; more than ``most_funds`` of them raise an error instead of filling the
    driver. Where a shuffle is asked for, funds are ordered by a hash of the seed and the fund.
    """
    rows = funds.withColumn("shuffle", F.xxhash64(F.lit(p.seed), FUND)).limit(most_funds + 1).toPandas()
    if len(rows) > most_funds:
        raise ValueError(f"more than {most_funds} eligible funds")
    rows["completeness"] = rows["completeness"].astype(float)
    by = lambda *c, up: rows.sort_values([*c, FUND], ascending=[*up, True], kind="stable")
    high = select_diverse(by("completeness", "n_real_investments", up=[False, False]), p.n_high, None, p).assign(sample_group="high")
    low = select_diverse(by("completeness", "n_real_investments", up=[True, False]), p.n_low, high, p).assign(sample_group="low")
    taken = pd.concat([high, low])
    rest = rows[~rows[FUND].isin(taken[FUND])]
    chance = rest.iloc[:0].assign(sample_group="random")
    for a, b in ((0.25, 0.75), (0.1, 0.9), (0.0, 1.0)):
        if not len(rest):
            break
        band = rest[rest["completeness"].between(rest["completeness"].quantile(a), rest["completeness"].quantile(b))].sort_values("shuffle")
        chance = select_diverse(band, p.n_random, taken, p).assign(sample_group="random")
        if len(chance) >= p.n_random:
            break
    all_of = pd.concat([high, low, chance]).drop(columns="shuffle")
    return funds.sparkSession.createDataFrame(all_of.astype(object).where(all_of.notna(), None), funds.withColumn("sample_group", F.lit("")).schema)


def sample_diagnostics(sample: DataFrame) -> DataFrame:
    return sample.groupBy("sample_group").agg(F.count("*").alias("funds"), F.min("completeness").alias("least"), F.max("completeness").alias("greatest"), F.countDistinct(MANAGER).alias("managers"), count_if(F.col("wind_down")).alias("winding_down"))


def sample_checks(sample: DataFrame, n: int) -> DataFrame:
    """Whether the sample has n funds, each once, no manager twice, all scores within 0 and 1."""
    return sample.agg((F.count("*") == n).alias("complete"), (F.countDistinct(FUND) == F.count("*")).alias("unique_funds"), (F.countDistinct(MANAGER) == F.count(MANAGER)).alias("unique_managers"), truthy(F.min("completeness").between(0, 1) & F.max("completeness").between(0, 1)).alias("in_range"))
