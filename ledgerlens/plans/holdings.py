"""A deterministic holdings panel over the order tables, with the same expressions in both engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import PATTERNS, REVIEW
from ..sources.readers import spread

SPARK_QUARTER = "last_day(add_months(trunc(cast(l_shipdate as date), 'QUARTER'), 2))"
DUCK_QUARTER = "cast(last_day(date_trunc('quarter', l_shipdate) + interval 2 month) as date)"

BASE = {
    "k1": "l_orderkey",
    "k2": "l_linenumber",
    "fund_id": "concat('F', lpad(cast(l_suppkey as string), 6, '0'))",
    "manager_id": "case when s_nationkey % 25 = 3 then '3.95E+42' else concat('M', lpad(cast(s_nationkey as string), 6, '0')) end",
    "source_asset_id": "cast(l_partkey as string)",
    "source_asset": "case (l_orderkey * 31 + l_linenumber * 17) % 40 when 0 then 'Non-Investment Assets - Cash' when 1 then 'Quarterly Unrealized Gain/Loss' when 2 then 'Other Investments' when 3 then 'Total Portfolio Investments' when 4 then null when 5 then 'Edge Investments' when 6 then 'Non-Investment Asset reserve' else p_name end",
    "as_at_date": "{quarter}",
    "capital_invested": "case when (l_orderkey + l_linenumber) % 7 = 0 then null else l_extendedprice end",
    "current_cost": "case when l_orderkey % 11 = 0 then null when l_orderkey % 4 = 1 then 0.0 else l_extendedprice * (1 - l_discount) end",
    "unrealized_value": "case when l_orderkey % 13 = 0 then null when l_orderkey % 5 in (1, 2) then 0.0 when l_orderkey % 97 = 5 then -l_extendedprice else l_extendedprice * (1 + l_tax) end",
    "realized_proceeds": "case when l_orderkey % 6 = 0 then null when l_orderkey % 3 = 1 then 0.0 else l_extendedprice * l_discount end",
    "sector": "case when (l_orderkey + l_linenumber) % 9 = 0 then null else p_brand end",
    "geographic_focus": "n_name",
    "type_of_investment": "case when l_orderkey % 8 = 0 then 'Public' else c_mktsegment end",
    "initial_investment_date": "cast(o_orderdate as date)",
    "ticker": "case when l_partkey % 12 = 0 then 'TCK' else null end",
    "reporting_currency": "case when l_orderkey % 40 = 0 then 'USD' else null end",
}
TOTAL = "case when k1 % 17 = 0 then null when k1 % 71 = 0 then (coalesce(unrealized_value, 0) + coalesce(realized_proceeds, 0)) * 1.02 else coalesce(unrealized_value, 0) + coalesce(realized_proceeds, 0) end"
REPORTED = """case when (k1 + k2) % 10 = 0 then null when k1 % 53 = 0 then 'Current'
  when unrealized_value = 0 and realized_proceeds = 0 and (current_cost = 0 or current_cost is null) then 'Written Off'
  when unrealized_value = 0 and realized_proceeds = 0 and current_cost > 0 then 'Written Down'
  when unrealized_value = 0 and realized_proceeds > 0 and current_cost > 0 then 'Partially Exited, Remainder Written Down'
  when unrealized_value > 0 and realized_proceeds > 0 then 'Partially Exited'
  when unrealized_value > 0 and (realized_proceeds is null or realized_proceeds <= 0) then 'Current'
  when (unrealized_value = 0 or unrealized_value is null) and (realized_proceeds is not null or total_value is not null) then 'Fully Exited' end"""
#: Some funds report once or twice a year.
KEPT = "not (l_suppkey % 5 = 0 and month({quarter}) <> 12) and not (l_suppkey % 5 = 1 and month({quarter}) not in (6, 12))"
COLUMNS = [*BASE, "total_value", "deal_status"]


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel; the small tables are left to the optimizer to broadcast by their size."""
    t = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    joined = spread(t("lineitem")).join(t("orders"), _on("l_orderkey", "o_orderkey")).join(t("supplier"), _on("l_suppkey", "s_suppkey")).join(t("nation"), _on("s_nationkey", "n_nationkey")).join(t("part"), _on("l_partkey", "p_partkey")).join(t("customer"), _on("o_custkey", "c_custkey"))
    rows = joined.where(KEPT.format(quarter=SPARK_QUARTER)).selectExpr(*[f"{e.format(quarter=SPARK_QUARTER)} as {c}" for c, e in BASE.items()])
    return rows.selectExpr("*", f"{TOTAL} as total_value").selectExpr("*", f"{REPORTED} as deal_status")


def _on(a: str, b: str) -> Column:
    return F.col(a) == F.col(b)


def sql() -> str:
    """The panel as CTEs ``h`` (all rows) and ``real`` (scorable rows with their class), for the other engine."""
    base = ", ".join(f"{e.format(quarter=DUCK_QUARTER)} as {c}" for c, e in BASE.items())
    cases = " ".join(f"when {' or '.join(f"regexp_matches(source_asset, '{p}')" for p in patterns)} then '{kind}'" for kind, patterns in PATTERNS.items())
    return f"""h0 as (select {base} from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey
    join nation on s_nationkey = n_nationkey join part on l_partkey = p_partkey join customer on o_custkey = c_custkey
    where {KEPT.format(quarter=DUCK_QUARTER)}),
  h1 as (select *, {TOTAL} as total_value from h0),
  h2 as (select *, {REPORTED} as deal_status from h1),
  h as (select *, case when source_asset is null or not regexp_matches(source_asset, '\\S') then 'accounting_entry' {cases} else 'holding' end as cls,
    coalesce(regexp_matches(source_asset, '{REVIEW}'), false) as review from h2),
  real as (select * from h where cls in ('holding', 'unnamed_aggregate'))"""
