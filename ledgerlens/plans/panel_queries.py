"""Queries of the scorecard half, over the holdings panel."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import PREFIX_ONLY
from ..operators import panel as P
from ..operators import rules as R
from ..operators import scorecard as S
from ..operators import status as T
from ..schema import CLASSES, DEFAULTS, EXPECTED, FINANCIAL, MANDATORY, STATUS_RANK, STATUSES
from .holdings import holdings, sql

KEYS = ["k1", "k2"]
PROFILED = [*MANDATORY, "total_value", "source_asset", "ticker", "reporting_currency", "type_of_investment"]
DATE = "1998-12-31"
GRAIN = ["fund_id", "source_asset_id", "as_at_date"]
IDS = ["manager_id", "fund_id"]

_real = lambda h: S.scorable(h)


def _nav(h: DataFrame) -> DataFrame:
    return S.size_quality(_real(h))


QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "source_asset_summary": S.source_asset_summary,
    "newly_excluded": lambda h: S.newly_excluded(h, PREFIX_ONLY),
    "review_queue": S.review_queue,
    "excluded_rows": lambda h: S.excluded_rows(h).select(*KEYS, "source_asset", "source_asset_class"),
    "attribute_missingness": lambda h: S.attribute_missingness(h, PROFILED),
    "missingness_histogram": lambda h: S.missingness_histogram(h, PROFILED),
    "drop_empty_and_unit_columns": lambda h: S.drop_empty_and_unit_columns(h.select(*KEYS, "sector", "current_cost").withColumn("nothing", F.lit(None).cast("string")).withColumn("Current Cost Unit", F.lit("USD"))),
    "full_row_duplicates": lambda h: S.full_row_duplicates(h.select("fund_id", "source_asset", "as_at_date", "sector")),
    "grain_duplicates": lambda h: S.grain_duplicates(h, GRAIN),
    "identifier_integrity": lambda h: S.identifier_integrity(h, IDS),
    "manager_blast_radius": S.manager_blast_radius,
    "fund_manager_cardinality": S.fund_manager_cardinality,
    "value_distribution": lambda h: S.value_distribution(_real(h), "deal_status"),
    "structural_missing_effect": lambda h: S.structural_missing_effect(h, "sector"),
    "field_fill_rate": lambda h: S.field_fill_rate(_real(h), PROFILED),
    "fund_completeness": lambda h: S.fund_completeness(_real(h)),
    "manager_scorecard": lambda h: S.manager_scorecard(_real(h)),
    "manager_score_described": lambda h: S.described(S.manager_scorecard(_real(h)).where("evidence = 'reliable'"), "completeness"),
    "manager_field_fill": lambda h: S.group_field_fill(_real(h), "manager_id"),
    "manager_worst_field": lambda h: S.manager_worst_field(_real(h)),
    "manager_fund_spread": lambda h: S.manager_fund_spread(_real(h)),
    "fill_by_type": lambda h: S.group_completeness(_real(h), "type_of_investment"),
    "type_field_fill": lambda h: S.group_field_fill(_real(h), "type_of_investment"),
    "fill_by_geography": lambda h: S.group_completeness(_real(h), "geographic_focus").where(F.col("n_rows") >= DEFAULTS.min_rows_geography),
    "low_evidence_split": lambda h: S.low_evidence_split(_real(h), "geographic_focus", DEFAULTS.min_rows_geography),
    "top_sectors": lambda h: S.portfolio_concentration(_real(h), "sector", 15),
    "portfolio_concentration": lambda h: S.portfolio_concentration(_real(h), "sector", 5),
    "cross_fund_assets": lambda h: S.cross_fund_assets(_real(h)),
    "aggregation_buckets": S.aggregation_buckets,
    "name_id_cardinality": lambda h: S.name_id_cardinality(_real(h)),
    "resolution_scope": S.resolution_scope,
    "crosstab": lambda h: S.crosstab(_real(h), "type_of_investment", "deal_status", STATUSES),
    "field_polarisation": lambda h: S.field_polarisation(_real(h)),
    "fund_outliers": lambda h: S.fund_outliers(_real(h)),
    "z_scores": lambda h: S.z_scores(S.fund_completeness(_real(h)), "completeness"),
    "score_histogram": lambda h: S.score_histogram(S.fund_completeness(_real(h)), "completeness"),
    "size_quality": _nav,
    "size_quality_corr": lambda h: S.size_quality_correlation(_nav(h)),
    "average_ranks": lambda h: S.average_ranks(_nav(h).select("fund_id", "quality"), ["quality"]),
    "nav_quartiles": lambda h: S.quartile_profile(_nav(h).where("nav > 0")),
    "latest_cross_section": lambda h: S.latest_cross_section(_real(h)).select(*KEYS, "as_at_date"),
    "target_date_slice": lambda h: _real(h).where(F.col("as_at_date") == F.lit(DATE).cast("date")).select(*KEYS),
    "unconditional_flags": lambda h: S.unconditional_flags(_real(h), KEYS),
    "any_null_mask": lambda h: h.select(*KEYS, (len(MANDATORY) - S.filled()).alias("n_missing")).where("n_missing > 0"),
    "missing_fields_list": lambda h: h.select(*KEYS, S.missing_list(MANDATORY).alias("missing_fields")),
    "investment_key": lambda h: h.select(*KEYS, S.investment_key().alias("investment_key")),
    "semi_anti_funds": lambda h: h.join(h.where("manager_id = '3.95E+42'").select("fund_id").distinct(), "fund_id", "left_semi").groupBy("fund_id").agg(F.count("*").alias("rows")).withColumn("side", F.lit("semi")).unionByName(h.join(h.where("manager_id = '3.95E+42'").select("fund_id").distinct(), "fund_id", "left_anti").groupBy("fund_id").agg(F.count("*").alias("rows")).withColumn("side", F.lit("anti"))),
    "excluded_by_regex": lambda h: h.where(~F.coalesce(F.col("source_asset").rlike("(?i)cash|total"), F.lit(False))).select(*KEYS),
    "data_state_summary": S.data_state_summary,
    "validation_checks": lambda h: S.validation_checks(h, GRAIN),
    "derived_status": lambda h: T.derived_counts(_real(h)),
    "rule_overlap": lambda h: T.rule_overlap(_real(h)),
    "derivation_coverage": lambda h: T.derivation_coverage(_real(h)),
    "imputable_blanks": lambda h: T.imputable_blanks(_real(h)),
    "imputed_labels": lambda h: T.imputed_labels(_real(h)),
    "status_crosstab": lambda h: T.status_crosstab(_real(h)),
    "conformance_exceptions": lambda h: T.conformance_exceptions(_real(h)),
    "conformance_rate": lambda h: T.conformance_rate(_real(h)),
    "sixth_category_profile": lambda h: T.sixth_category_profile(_real(h)),
    "glossary_gap": lambda h: T.glossary_gap(_real(h)),
    "dictionary_status": lambda h: _real(h).groupBy(T.dictionary_status(F.col("unrealized_value"), F.col("realized_proceeds")).alias("status")).agg(F.count("*").alias("rows")),
    "row_scores": lambda h: T.row_scores(_real(h), KEYS),
    "conditional_by_field": lambda h: T.conditional_by_field(_real(h)),
    "conditional_by_fund": lambda h: T.conditional_by_fund(_real(h)),
    "conditional_by_manager": lambda h: T.conditional_by_manager(_real(h)),
    "fund_scores": lambda h: T.fund_scores(_real(h)),
    "score_comparison": lambda h: T.score_comparison(_real(h)),
    "conditional_cell_accounting": lambda h: T.conditional_cell_accounting(_real(h)),
    "conditional_flags": lambda h: T.conditional_flags(_real(h), KEYS),
    "zero_vs_blank": lambda h: T.zero_vs_blank(_real(h)),
    "consistency_rules": lambda h: R.consistency_rules(_real(h)),
    "temporal_rules": lambda h: R.temporal_rules(_real(h), KEYS),
    "status_rank_diff": lambda h: R.with_changes(_real(h), KEYS).where("d_status_rank is not null").select(*KEYS, "d_status_rank"),
    "public_private_crosstab": lambda h: R.public_private_crosstab(_real(h)),
    "cadence": lambda h: P.cadence(_real(h)),
    "calendar_gaps": lambda h: P.calendars(_real(h)).select("fund_id", F.size("dates").alias("n_dates"), F.array_min("dates").alias("first"), F.array_max("dates").alias("last")),
    "reporting_gaps": lambda h: P.reporting_gaps(_real(h)),
    "naive_grid_gaps": lambda h: P.naive_grid_gaps(_real(h)),
    "rows_by_cadence": lambda h: P.with_cadence(_real(h)).groupBy("cadence").agg(F.count("*").alias("n_rows"), F.countDistinct("fund_id").alias("n_funds")),
    "date_rank": lambda h: P.date_rank(_real(h)),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(f: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: f(holdings(spark, sf_dir))

    return {k: bound(f) for k, f in QUERIES.items()}


# ---- the same in SQL

_M = MANDATORY
_N = len(_M)
_filled = " + ".join(f"({f} is not null)::int" for f in _M)
_comp = f"round(sum({_filled}) / (count(*) * {_N}), 6)"
_class_order = "list_position([" + ", ".join(f"'{c}'" for c in CLASSES) + "], cls)"
_derived = """case when unrealized_value = 0 and realized_proceeds = 0 and (current_cost = 0 or current_cost is null) then 'Written Off'
  when unrealized_value = 0 and realized_proceeds = 0 and current_cost > 0 then 'Written Down'
  when unrealized_value = 0 and realized_proceeds > 0 and current_cost > 0 then 'Partially Exited, Remainder Written Down'
  when unrealized_value > 0 and realized_proceeds > 0 then 'Partially Exited'
  when unrealized_value > 0 and (realized_proceeds is null or realized_proceeds <= 0) then 'Current'
  when (unrealized_value = 0 or unrealized_value is null) and (realized_proceeds is not null or total_value is not null) then 'Fully Exited'
  else 'Unclassifiable' end"""
_overlap = " + ".join(
    f"coalesce(({c})::int, 0)"
    for c in (
        "unrealized_value = 0 and realized_proceeds = 0 and (current_cost is null or current_cost = 0)",
        "unrealized_value = 0 and realized_proceeds = 0 and current_cost > 0",
        "unrealized_value = 0 and realized_proceeds > 0 and current_cost > 0",
        "unrealized_value > 0 and realized_proceeds > 0",
        "unrealized_value > 0 and (realized_proceeds is null or realized_proceeds <= 0)",
        "(unrealized_value is null or unrealized_value = 0) and (realized_proceeds is not null or total_value is not null)",
    )
)
_missing = lambda fields: "array_to_string(list_filter([" + ", ".join(f"case when {f} is null then '{f}' end" for f in fields) + "], lambda x: x is not null), ', ')"


def _unpivot(source: str, fields: list[str], parts: dict[str, str], name: str = "field", tail: str = "") -> str:
    return " union all ".join(f"select '{f}' as {name}, " + ", ".join(f"{e.format(f=f)} as {o}" for o, e in parts.items()) + f" from {source}{tail}" for f in fields)


def _expected(f: str) -> str:
    if f not in FINANCIAL:
        return "true"
    i = FINANCIAL.index(f)
    cases = " ".join(f"when '{s}' then {bool(v[i])}" for s, v in EXPECTED.items() if s)
    out = f"case st {cases} else {bool(EXPECTED[''][i])} end"
    return f"({out} or st = 'Fully Exited')" if f == "realized_proceeds" else out


_app = ", ".join(f"{_expected(f)} as a_{f}" for f in _M) + ", " + ", ".join(f"{f} is not null as p_{f}" if f != "realized_proceeds" else "case when st = 'Fully Exited' then realized_proceeds is not null or total_value is not null else realized_proceeds is not null end as p_realized_proceeds" for f in _M)
_APP = f"der as (select *, {_derived} as derived_status from real), st as (select *, coalesce(deal_status, nullif(derived_status, 'Unclassifiable'), '') as st from der), app as (select *, {_app} from st)"
_DER = f"der as (select *, {_derived} as derived_status from real)"
_den = " + ".join(f"a_{f}::int" for f in _M)
_num = " + ".join(f"(a_{f} and p_{f})::int" for f in _M)
_FUNDS = f"f as (select fund_id, count(*) as n_rows, {_comp} as completeness from real where fund_id is not null group by fund_id)"
_NAV = f"nv as (select fund_id, round(coalesce(sum(total_value), 0), 2) as nav, round(avg((total_value is not null)::int), 6) as nav_coverage, count(*) as n_rows, {_comp} as quality from real where as_at_date = (select max(as_at_date) from real) group by fund_id)"
_rank = "case deal_status " + " ".join(f"when '{k}' then {v}" for k, v in STATUS_RANK.items()) + " end"
_LAG = f"""w as (select *, {_rank} as rk from real where fund_id is not null and source_asset is not null),
  d as (select *, realized_proceeds - lag(realized_proceeds) over s as drp, capital_invested - lag(capital_invested) over s as dci, rk - lag(rk) over s as drk from w
    window s as (partition by fund_id, source_asset order by as_at_date, k1, k2))"""
_E, _TOL = DEFAULTS.eps, DEFAULTS.tolerance
_RULES = [
    ("capital_invested >= 0", "capital_invested < 0", "capital_invested is not null"),
    ("current_cost >= 0", "current_cost < 0", "current_cost is not null"),
    ("realized_proceeds < 0 (count only)", "realized_proceeds < 0", "realized_proceeds is not null"),
    ("initial_investment_date <= as_at_date", "initial_investment_date > as_at_date", "initial_investment_date is not null"),
    ("total_value = unrealized + realized", f"abs(total_value - (coalesce(unrealized_value, 0) + coalesce(realized_proceeds, 0))) / nullif(abs(total_value), 0) > {_TOL}", "total_value is not null and (unrealized_value is not null or realized_proceeds is not null)"),
    ("current_cost <= capital_invested", f"current_cost > capital_invested * (1 + {_TOL})", "current_cost is not null and capital_invested is not null"),
    ("Current => unrealized > 0", f"not coalesce(unrealized_value > {_E}, false)", "deal_status = 'Current'"),
    ("Current => realized <= 0 or blank", f"realized_proceeds > {_E}", "deal_status = 'Current'"),
    ("Partially Exited => unrealized > 0 and realized > 0", f"not coalesce(unrealized_value > {_E} and realized_proceeds > {_E}, false)", "deal_status = 'Partially Exited'"),
    ("Fully Exited => unrealized = 0 or blank", f"abs(unrealized_value) > {_E}", "deal_status = 'Fully Exited'"),
    ("Fully Exited => realized or total present", "realized_proceeds is null and total_value is null", "deal_status = 'Fully Exited'"),
    ("Written Off => nothing left, no cost", f"not coalesce(abs(unrealized_value) <= {_E} and abs(realized_proceeds) <= {_E} and (abs(current_cost) <= {_E} or current_cost is null), false)", "deal_status = 'Written Off'"),
    ("Written Down => nothing left, cost", f"not coalesce(abs(unrealized_value) <= {_E} and abs(realized_proceeds) <= {_E} and current_cost > {_E}, false)", "deal_status = 'Written Down'"),
]


def _rule_sql(rules: list[tuple[str, str, str]], source: str) -> str:
    return " union all ".join(f"select '{n}' as rule, count(*) filter ({a}) as applicable_rows, count(*) filter (({a}) and ({v})) as violations, round(100.0 * count(*) filter (({a}) and ({v})) / nullif(count(*) filter ({a}), 0), 2) as rate from {source}" for n, v, a in rules)


def _bucket(q: str) -> str:
    return f"(select quantile_cont(nav, {q}) from nv where nav > 0)"


_BAD = "(manager_id is not null and not regexp_matches(manager_id, '^[0-9A-Za-z]{6,8}$'))"


def _identifiers() -> str:
    bad = lambda i: f"({i} is not null and not regexp_matches({i}, '^[0-9A-Za-z]{{6,8}}$'))"
    return " union all ".join(f"select '{i}' as identifier, count(distinct {i}) as distinct_values, count(*) filter ({bad(i)}) as malformed_rows, count(distinct {i}) filter ({bad(i)}) as malformed_distinct, count(distinct fund_id) filter ({bad(i)}) as funds_affected, round(count(*) filter ({bad(i)}) / count(*), 6) as malformed_share from h" for i in IDS)


SQL: dict[str, str] = {
    "source_asset_summary": f"select cls as source_asset_class, {_class_order} as class_order, count(*) as rows, count(distinct source_asset) as distinct_names, round(count(*) / (select count(*) from h), 6) as share_of_rows from h group by cls",
    "newly_excluded": f"select cls as source_asset_class, source_asset, count(*) as rows from h where cls not in ('holding', 'unnamed_aggregate') and not coalesce(regexp_matches(source_asset, '{PREFIX_ONLY}'), false) group by all",
    "review_queue": "select source_asset, count(*) as rows, count(distinct fund_id) as funds from h where review group by 1",
    "excluded_rows": "select k1, k2, source_asset, cls as source_asset_class from h where cls not in ('holding', 'unnamed_aggregate')",
    "attribute_missingness": "select * from (" + _unpivot("h", PROFILED, {"missing_cnt": "count(*) filter ({f} is null)", "missing_pnt": "round(100.0 * count(*) filter ({f} is null) / count(*), 4)"}, "column_name") + ") where missing_cnt > 0",
    "missingness_histogram": "select missing_pnt, count(*) as columns from (" + _unpivot("h", PROFILED, {"missing_pnt": "round(100.0 * count(*) filter ({f} is null) / count(*), 4)"}, "c") + ") group by 1",
    "drop_empty_and_unit_columns": "select k1, k2, sector, current_cost from h",
    "full_row_duplicates": "select sum(c)::bigint as rows, sum(c - 1)::bigint as duplicates from (select count(*) as c from h group by fund_id, source_asset, as_at_date, sector)",
    "grain_duplicates": "select *, round(duplicated_rows / (select count(*) from h), 6) as share from (select fund_id, source_asset_id, as_at_date, count(*) as rows, (select coalesce(sum(c), 0)::bigint from (select count(*) as c from h group by fund_id, source_asset_id, as_at_date) where c > 1) as duplicated_rows from h group by 1, 2, 3 having count(*) > 1 order by 4 desc, 1, 2, 3 limit 5)",
    "identifier_integrity": _identifiers(),
    "manager_blast_radius": f"select count(*) as funds_touched, count(*) filter (good > 0) as funds_also_valid, case when count(*) filter (good > 0) > 0 then 'SPLIT' else 'self-contained' end as verdict from (select fund_id, count(*) filter ({_BAD}) as bad, count(*) filter (not {_BAD} and manager_id is not null) as good from h group by 1) where bad > 0",
    "fund_manager_cardinality": "select fund_id, count(distinct manager_id) as managers from h group by 1",
    "value_distribution": "select coalesce(deal_status, 'MISSING') as value, count(*) as rows, round(count(*) / (select count(*) from real), 6) as share from real group by 1",
    "structural_missing_effect": "select *, round(missing_all - missing_real, 6) as effect from (select round((select avg((sector is null)::int) from h), 6) as missing_all, round((select avg((sector is null)::int) from real), 6) as missing_real)",
    "field_fill_rate": "select *, case fill_rate when 0 then 'empty' when 1 then 'full' else 'partial' end as kind from (" + _unpivot("real", PROFILED, {"fill_rate": "round(avg(({f} is not null)::int), 6)"}) + ")",
    "fund_completeness": f"select fund_id, count(*) as n_rows, {_comp} as completeness from real group by 1",
    "manager_scorecard": f"select manager_id, count(*) as n_rows, count(distinct fund_id) as n_funds, count(distinct source_asset) as n_companies, {_comp} as completeness, case when count(*) >= 10 then 'reliable' else 'low' end as evidence from real where manager_id is not null group by 1",
    "manager_score_described": f"select count(c) as n, round(avg(c), 6) as mean, round(stddev_samp(c), 6) as std, min(c) as min, round(quantile_cont(c, 0.25), 6) as p25, round(quantile_cont(c, 0.5), 6) as p50, round(quantile_cont(c, 0.75), 6) as p75, max(c) as max from (select {_comp} as c from real group by manager_id having count(*) >= 10)",
    "manager_field_fill": "select m.manager_id, m.n_rows, field, fill_rate from (select manager_id, count(*) as n_rows from real group by 1) m join (" + " union all ".join(f"select manager_id, '{f}' as field, round(avg(({f} is not null)::int), 6) as fill_rate from real group by 1" for f in _M) + ") using (manager_id)",
    "manager_worst_field": "select manager_id, field as worst_field, rate as fill_rate from (" + " union all ".join(f"select manager_id, {i} as i, '{f}' as field, round(avg(({f} is not null)::int), 6) as rate from real group by 1" for i, f in enumerate(_M)) + ") qualify row_number() over (partition by manager_id order by rate, i) = 1",
    "manager_fund_spread": f"select manager_id, max(c) as best, min(c) as worst, count(*) as n_funds, round(max(c) - min(c), 6) as spread from (select manager_id, fund_id, {_comp} as c from real group by 1, 2) group by 1 having count(*) > 1",
    "fill_by_type": f"select type_of_investment, count(*) as n_rows, {_comp} as completeness from real where type_of_investment is not null group by 1",
    "type_field_fill": "select m.type_of_investment, m.n_rows, field, fill_rate from (select type_of_investment, count(*) as n_rows from real group by 1) m join (" + " union all ".join(f"select type_of_investment, '{f}' as field, round(avg(({f} is not null)::int), 6) as fill_rate from real group by 1" for f in _M) + ") using (type_of_investment)",
    "fill_by_geography": f"select geographic_focus, count(*) as n_rows, {_comp} as completeness from real group by 1 having count(*) >= 100",
    "low_evidence_split": "select count(*) filter (n >= 100) as ranked, count(*) filter (n < 100) as low_evidence from (select count(*) as n from real where geographic_focus is not null group by geographic_focus)",
    "top_sectors": "select sector, count(*) as rows, round(count(*) / (select count(*) from real), 6) as share from real where sector is not null group by 1 order by 2 desc, 1 limit 15",
    "portfolio_concentration": "select sector, count(*) as rows, round(count(*) / (select count(*) from real), 6) as share from real where sector is not null group by 1 order by 2 desc, 1 limit 5",
    "cross_fund_assets": "select source_asset, count(distinct fund_id) as n_funds from real where cls = 'holding' group by 1 having count(distinct fund_id) > 1",
    "aggregation_buckets": "select source_asset, count(distinct fund_id) as n_funds, count(*) as rows from real where cls = 'unnamed_aggregate' group by 1 having count(distinct fund_id) > 1",
    "name_id_cardinality": "with p as (select distinct source_asset, source_asset_id from real where source_asset is not null and source_asset_id is not null) select * from (select count(*) as names, count(*) filter (c > 1) as names_with_many_ids, max(c) as most_ids from (select count(*) as c from p group by source_asset)), (select count(*) as ids, count(*) filter (c > 1) as ids_with_many_names, max(c) as most_names from (select count(*) as c from p group by source_asset_id))",
    "resolution_scope": "select count(*) as rows, count(distinct source_asset) as distinct_names, count(distinct as_at_date) as periods, round(count(*) / count(distinct source_asset), 6) as rows_per_name from h where cls = 'holding'",
    "crosstab": "select type_of_investment, " + ", ".join(f"count(*) filter (deal_status = '{s}') as n_{s.lower().replace(' ', '_').replace(',', '')}" for s in STATUSES) + " from real group by 1",
    "field_polarisation": "select field, count(*) as n_funds, count(*) filter (r = 0) as at_zero, count(*) filter (r > 0 and r <= 0.5) as low, count(*) filter (r > 0.5 and r < 1) as high, count(*) filter (r = 1) as at_one, round(100 * quantile_cont(r, 0.5), 1) as median_pct, round(100 * avg(r), 1) as mean_pct, round(100.0 * count(*) filter (r = 0 or r = 1) / count(*), 1) as polarised_pct from (" + " union all ".join(f"select fund_id, '{f}' as field, avg(({f} is not null)::int) as r from real group by 1" for f in _M) + ") group by 1",
    "fund_outliers": f"with {_FUNDS}, s as (select avg(completeness) as mu, stddev_samp(completeness) as sd from f) select round(quantile_cont(completeness, 0.1), 6) as p10, round(quantile_cont(completeness, 0.5), 6) as median, count(*) filter (completeness < 0.85) as below_threshold, count(*) filter (completeness >= 0.999) as \"full\", count(*) filter ((completeness - mu) / sd > 2) as z_above_2, count(*) filter ((completeness - mu) / sd < -2) as z_below_2 from f, s",
    "z_scores": f"with {_FUNDS} select fund_id, n_rows, completeness, round((completeness - (select avg(completeness) from f)) / (select stddev_samp(completeness) from f), 6) as z from f",
    "score_histogram": f"with {_FUNDS}, e as (select min(completeness) as lo, max(completeness) as hi from f) select case when hi = lo then 0 else least(floor((completeness - lo) / (hi - lo) * 20), 19) end::int as bin, count(*) as n from f, e group by 1",
    "size_quality": f"with {_NAV} select * from nv",
    "size_quality_corr": f"with {_NAV}, r as (select *, rank() over (order by nav) + (count(*) over (partition by nav) - 1) / 2 as ra, rank() over (order by quality) + (count(*) over (partition by quality) - 1) / 2 as rb, rank() over (order by n_rows) + (count(*) over (partition by n_rows) - 1) / 2 as rc from nv where nav > 0), c as (select corr(nav, quality) as p, corr(ra, rb) as xy, corr(ra, rc) as xz, corr(rb, rc) as yz from r) select round(p, 6) as pearson, round(xy, 6) as spearman, round((xy - xz * yz) / sqrt((1 - xz * xz) * (1 - yz * yz)), 6) as partial_spearman from c",
    "average_ranks": f"with {_NAV} select fund_id, quality, rank() over (order by quality) + (count(*) over (partition by quality) - 1) / 2 as r_quality from nv",
    "nav_quartiles": f"with {_NAV} select case when nav <= {_bucket('0.25')} then 1 when nav <= {_bucket('0.5')} then 2 when nav <= {_bucket('0.75')} then 3 else 4 end as quartile, count(*) as n, round(avg(quality), 6) as mean_quality, round(quantile_cont(quality, 0.5), 6) as median_quality from nv where nav > 0 group by 1",
    "latest_cross_section": "select k1, k2, as_at_date from real where as_at_date = (select max(as_at_date) from real)",
    "target_date_slice": f"select k1, k2 from real where as_at_date = date '{DATE}'",
    "unconditional_flags": "select k1, k2, n_missing, missing_fields from (select k1, k2, " + " + ".join(f"({f} is null)::int" for f in ("capital_invested", "current_cost", "deal_status", "sector", "geographic_focus")) + f" as n_missing, {_missing(['capital_invested', 'current_cost', 'deal_status', 'sector', 'geographic_focus'])} as missing_fields from real) where n_missing > 0",
    "any_null_mask": f"select k1, k2, {_N} - ({_filled}) as n_missing from h where {_N} - ({_filled}) > 0",
    "missing_fields_list": f"select k1, k2, {_missing(_M)} as missing_fields from h",
    "investment_key": "select k1, k2, coalesce(source_asset_id, source_asset) as investment_key from h",
    "semi_anti_funds": "select fund_id, count(*) as rows, case when fund_id in (select fund_id from h where manager_id = '3.95E+42') then 'semi' else 'anti' end as side from h group by 1",
    "excluded_by_regex": "select k1, k2 from h where not coalesce(regexp_matches(source_asset, '(?i)cash|total'), false)",
    "data_state_summary": f"with {_FUNDS} select * from (select count(*) as rows, count(*) filter (cls in ('holding', 'unnamed_aggregate')) as scorable, count(*) filter (cls = 'holding') as resolvable, count(distinct fund_id) as funds, count(distinct manager_id) as managers, count(distinct as_at_date) as dates, count(distinct reporting_currency) as currencies from h), (select round(avg(completeness), 6) as mean_fund_completeness, count(*) filter (completeness >= 0.999) as funds_full, count(*) filter (completeness < 0.85) as funds_below, min(completeness) as least_completeness from f)",
    "validation_checks": f"with {_FUNDS} select 'scores within 0 and 1' as check_name, 'hard' as severity, min(completeness) >= 0 and max(completeness) <= 1 as holds from f union all select 'no unit columns', 'hard', true union all select 'unique grain', 'soft', (select max(c) = 1 from (select count(*) as c from h group by fund_id, source_asset_id, as_at_date)) union all select 'one reporting currency', 'soft', (select count(distinct reporting_currency) <= 1 from h)",
    "derived_status": f"select {_derived} as derived_status, count(*) as rows from real group by 1",
    "rule_overlap": f"select {_overlap} as rules_matched, count(*) as rows from real group by 1",
    "derivation_coverage": f"with {_DER}, x as (select derived_status = 'Unclassifiable' as u, unrealized_value is null and realized_proceeds is null and current_cost is null and total_value is null as b, coalesce(unrealized_value < 0, false) as n from der) select count(*) filter (not u) as classified, count(*) filter (u and b) as all_blank, count(*) filter (u and not b and n) as negative_value, count(*) filter (u and not b and not n) as other from x",
    "imputable_blanks": f"with {_DER} select count(*) filter (deal_status is null and derived_status <> 'Unclassifiable') as imputable, count(*) filter (deal_status is null and derived_status = 'Unclassifiable') as not_imputable, count(*) filter (deal_status is null and unrealized_value is not null and realized_proceeds is not null) as blank_with_values from der",
    "imputed_labels": f"with {_DER} select derived_status, count(*) as rows from der where deal_status is null and derived_status <> 'Unclassifiable' group by 1",
    "status_crosstab": f"with {_DER} select deal_status, " + ", ".join(f"count(*) filter (derived_status = '{s}') as n{i}" for i, s in enumerate(STATUSES)) + " from der where deal_status is not null and derived_status <> 'Unclassifiable' group by 1",
    "conformance_exceptions": f"with {_DER} select deal_status, derived_status, count(*) as rows, count(distinct fund_id) as funds from der where deal_status is not null and derived_status <> 'Unclassifiable' and deal_status <> derived_status group by 1, 2",
    "conformance_rate": f"with {_DER} select count(*) as comparable_rows, round(avg((deal_status = derived_status)::int), 6) as agreement from der where deal_status is not null and derived_status <> 'Unclassifiable'",
    "sixth_category_profile": "select count(*) as rows, round(avg(coalesce(unrealized_value = 0, false)::int), 6) as value_zero, round(avg(coalesce(realized_proceeds > 0, false)::int), 6) as proceeds_positive, round(avg(coalesce(current_cost > 0, false)::int), 6) as cost_positive, round(avg(coalesce(unrealized_value = 0 and realized_proceeds > 0 and current_cost > 0, false)::int), 6) as all_three from real where deal_status = 'Partially Exited, Remainder Written Down'",
    "glossary_gap": "select *, no_proceeds - neither as difference from (select count(*) as rows, count(*) filter (realized_proceeds is null) as no_proceeds, count(*) filter (realized_proceeds is null and total_value is null) as neither from real where deal_status = 'Fully Exited')",
    "dictionary_status": "select case when u > 0 and r <= 0 then 'Current' when u > 0 and r > 0 then 'Partially Exited' else 'Fully Exited' end as status, count(*) as rows from (select coalesce(unrealized_value, 0) as u, coalesce(realized_proceeds, 0) as r from real) group by 1",
    "row_scores": f"with {_APP} select k1, k2, round(({_num}) / ({_den}), 6) as row_score from app",
    "conditional_by_field": f"with {_APP} " + _unpivot("app", _M, {"uncond_fill": "round(avg(p_{f}::int), 6)", "applicable_share": "round(avg(a_{f}::int), 6)", "cond_fill": "round(count(*) filter (a_{f} and p_{f}) / count(*) filter (a_{f}), 6)", "expected_blanks": "count(*) filter (not a_{f} and not p_{f})", "true_gaps": "count(*) filter (a_{f} and not p_{f})"}),
    "conditional_by_fund": f"with {_APP} select fund_id, count(*) as n_rows, round(sum({_num}) / sum({_den}), 6) as conditional from app group by 1",
    "conditional_by_manager": f"with {_APP} select manager_id, count(*) as n_rows, round(sum({_num}) / sum({_den}), 6) as conditional from app where manager_id is not null group by 1",
    "fund_scores": f"with {_APP} select *, round(conditional - unconditional, 6) as delta from (select fund_id, {_comp} as unconditional, round(sum({_num}) / sum({_den}), 6) as conditional from app group by 1)",
    "score_comparison": f"with {_APP}, s as (select fund_id, {_comp} as u, round(sum({_num}) / sum({_den}), 6) as c from app group by 1) select count(*) as funds, count(*) filter (u < 0.85) as below_unconditional, count(*) filter (c < 0.85) as below_conditional, count(*) filter (u < 0.85 and c < 0.85) as below_both, count(*) filter (round(c - u, 6) < 0) as lower, round(max(c - u), 6) as greatest_delta from s",
    "conditional_cell_accounting": f"with {_APP} select *, cells - applicable as removed from (select count(*) * {_N} as cells, sum({_den})::bigint as applicable, round(sum({' + '.join(f'p_{f}::int' for f in _M)}) / (count(*) * {_N}), 6) as uncond_rate, round(sum({_num}) / sum({_den}), 6) as cond_rate from app)",
    "conditional_flags": f"with {_APP} select k1, k2, ({_den}) - ({_num}) as n_missing, array_to_string(list_filter([" + ", ".join(f"case when a_{f} and not p_{f} then '{f}' end" for f in _M) + f"], lambda x: x is not null), ', ') as missing_fields from app where ({_den}) - ({_num}) > 0",
    "zero_vs_blank": _unpivot("real", FINANCIAL, {"blank": "round(avg(({f} is null)::int), 6)", "zero": f"round(avg(coalesce(abs({{f}}) <= {_E}, false)::int), 6)", "non_zero": f"round(avg(coalesce(abs({{f}}) > {_E}, false)::int), 6)"}),
    "consistency_rules": _rule_sql(_RULES, "real"),
    "temporal_rules": f"with {_LAG} select *, round(100.0 * violations / (select count(*) from real), 2) as rate_all_rows from (" + _rule_sql([("realized_proceeds does not decrease", f"drp < -{_E}", "drp is not null"), ("capital_invested does not decrease", f"dci < -{_E}", "dci is not null"), ("deal_status does not regress", "drk < 0", "drk is not null")], "d") + ")",
    "status_rank_diff": f"with {_LAG} select k1, k2, drk as d_status_rank from d where drk is not null",
    "public_private_crosstab": "select coalesce(type_of_investment, 'MISSING') as type_of_investment, count(ticker) as with_ticker, count(*) - count(ticker) as without_ticker from real group by 1",
    "cadence": "with d as (select distinct fund_id, as_at_date from real), g as (select fund_id, as_at_date, date_diff('day', lag(as_at_date) over (partition by fund_id order by as_at_date), as_at_date) as gap from d), m as (select fund_id, count(*) as n_dates, quantile_cont(gap, 0.5) as median_gap from g group by 1) select *, case when median_gap is null then 'single-period' when median_gap <= 100 then 'quarterly' when median_gap <= 200 then 'semi-annual' else 'annual' end as cadence from m",
    "rows_by_cadence": "with d as (select distinct fund_id, as_at_date from real), g as (select fund_id, as_at_date, date_diff('day', lag(as_at_date) over (partition by fund_id order by as_at_date), as_at_date) as gap from d), m as (select fund_id, count(*) as n_dates, quantile_cont(gap, 0.5) as median_gap from g group by 1) select cadence, count(*) as n_rows, count(distinct fund_id) as n_funds from real left join (select fund_id, case when median_gap is null then 'single-period' when median_gap <= 100 then 'quarterly' when median_gap <= 200 then 'semi-annual' else 'annual' end as cadence from m) using (fund_id) group by 1",
    "calendar_gaps": "select fund_id, count(distinct as_at_date) as n_dates, min(as_at_date) as first, max(as_at_date) as last from real group by 1",
    "reporting_gaps": "with s as (select fund_id, source_asset, min(as_at_date) as first, max(as_at_date) as last, count(distinct as_at_date) as n_periods from real where source_asset is not null group by 1, 2), d as (select distinct fund_id, as_at_date from real), e as (select s.fund_id, source_asset, first, last, n_periods, count(*) as expected from s join d on d.fund_id = s.fund_id and as_at_date between first and last group by all) select *, expected - n_periods as gap_periods from e where expected > n_periods",
    "naive_grid_gaps": "with r as (select as_at_date, row_number() over (order by as_at_date) - 1 as k from (select distinct as_at_date from real)), s as (select fund_id, source_asset, min(as_at_date) as first, max(as_at_date) as last, count(distinct as_at_date) as n_periods from real where source_asset is not null group by 1, 2) select fund_id, source_asset, b.k - a.k + 1 - n_periods as missing_periods from s join r a on a.as_at_date = first join r b on b.as_at_date = last where b.k - a.k + 1 > n_periods",
    "date_rank": "select as_at_date, row_number() over (order by as_at_date) - 1 as date_rank from (select distinct as_at_date from real)",
}


def oracle_sql() -> dict[str, str]:
    """Each query with the panel before it."""
    out = {}
    for k, q in SQL.items():
        head = f"with {sql()}"
        out[k] = f"{head}, {q[5:]}" if q.startswith("with ") else f"{head} {q}"
    return out
