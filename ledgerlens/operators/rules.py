"""Consistency rules: applicable rows and violations of every rule from one aggregate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import truthy
from ..schema import AS_AT, ASSET, DEFAULTS, FUND, STATUS, STATUS_RANK, Params
from .scorecard import count_if


@dataclass(frozen=True)
class Rule:
    """violated counts only where applies; a null condition is false, so a negated one holds for missing values."""

    name: str
    violated: Column
    applies: Column


def counted(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, applicable_rows, violations, rate in percent); a rule without applicable rows has no rate."""
    stats = [x for i, r in enumerate(rules) for x in (count_if(r.applies).alias(f"a{i}"), count_if(truthy(r.applies) & truthy(r.violated)).alias(f"v{i}"))]
    parts = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"a{i}").alias("applicable_rows"), F.col(f"v{i}").alias("violations")) for i, r in enumerate(rules)])
    out = rows.agg(*stats).select(F.explode(parts).alias("x")).select("x.*")
    return out.withColumn("rate", F.round(100 * F.try_divide(F.col("violations").cast("double"), F.col("applicable_rows")), 2))


def catalogue(columns: list[str], p: Params = DEFAULTS) -> list[Rule]:
    c = F.col
    ci, cc, uv, rp, tv, st = (c(x) for x in ("capital_invested", "current_cost", "unrealized_value", "realized_proceeds", "total_value", STATUS))
    out = [Rule(f"{f} >= 0", c(f) < 0, c(f).isNotNull()) for f in ("capital_invested", "current_cost")]
    out.append(Rule("realized_proceeds < 0 (count only)", rp < 0, rp.isNotNull()))
    if "ownership" in columns:
        out += [Rule(f"ownership in [0, {top}]", (c("ownership") < 0) | (c("ownership") > top), c("ownership").isNotNull()) for top in (1, 100)]
    out.append(Rule("initial_investment_date <= as_at_date", c("initial_investment_date") > c(AS_AT), c("initial_investment_date").isNotNull()))
    calc = F.coalesce(uv, F.lit(0.0)) + F.coalesce(rp, F.lit(0.0))
    out.append(Rule("total_value = unrealized + realized", F.try_divide(F.abs(tv - calc), F.abs(tv)) > p.tolerance, tv.isNotNull() & (uv.isNotNull() | rp.isNotNull())))
    out.append(Rule("current_cost <= capital_invested", cc > ci * (1 + p.tolerance), cc.isNotNull() & ci.isNotNull()))
    near = lambda x: truthy(F.abs(x) <= p.eps)
    over = lambda x: truthy(x > p.eps)
    for status, name, bad in (
        ("Current", "unrealized > 0", ~over(uv)),
        ("Current", "realized <= 0 or blank", over(rp)),
        ("Partially Exited", "unrealized > 0 and realized > 0", ~(over(uv) & over(rp))),
        ("Fully Exited", "unrealized = 0 or blank", truthy(F.abs(uv) > p.eps)),
        ("Fully Exited", "realized or total present", rp.isNull() & tv.isNull()),
        ("Written Off", "nothing left, no cost", ~(near(uv) & near(rp) & (near(cc) | cc.isNull()))),
        ("Written Down", "nothing left, cost", ~(near(uv) & near(rp) & over(cc))),
    ):
        out.append(Rule(f"{status} => {name}", bad, st == status))
    return out


def consistency_rules(real: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    return counted(real, catalogue(real.columns, p))


def with_changes(real: DataFrame, order: list[str]) -> DataFrame:
    """real with the change of each tracked value against the row before in its series (fund, asset); null keys are left out.

    Series need not be unique by date: order names the columns that break ties.
    """
    w = Window.partitionBy(FUND, ASSET).orderBy(AS_AT, *order)
    rank = F.create_map(*[x for k, v in STATUS_RANK.items() for x in (F.lit(k), F.lit(v))])
    rows = real.where(F.col(FUND).isNotNull() & F.col(ASSET).isNotNull()).withColumn("status_rank", F.try_element_at(rank, F.col(STATUS)))
    change = lambda f: F.col(f) - F.lag(f).over(w)
    return rows.withColumns({"d_realized_proceeds": change("realized_proceeds"), "d_capital_invested": change("capital_invested"), "d_status_rank": change("status_rank")})


def temporal_rules(real: DataFrame, order: list[str], p: Params = DEFAULTS) -> DataFrame:
    """Three rules over time. rate divides by applicable rows, rate_all_rows by all rows."""
    rules = [Rule(f"{f} does not decrease", F.col(f"d_{f}") < -p.eps, F.col(f"d_{f}").isNotNull()) for f in ("realized_proceeds", "capital_invested")]
    rules.append(Rule("deal_status does not regress", F.col("d_status_rank") < 0, F.col("d_status_rank").isNotNull()))
    n = real.agg(F.count("*").alias("n"))
    out = counted(with_changes(real, order), rules).crossJoin(F.broadcast(n))
    return out.withColumn("rate_all_rows", F.round(100 * F.try_divide(F.col("violations").cast("double"), F.col("n")), 2)).drop("n")


def public_private_crosstab(real: DataFrame) -> DataFrame:
    kind = F.coalesce(F.col("type_of_investment"), F.lit("MISSING"))
    return real.groupBy(kind.alias("type_of_investment")).agg(count_if(F.col("ticker").isNotNull()).alias("with_ticker"), count_if(F.col("ticker").isNull()).alias("without_ticker"))
