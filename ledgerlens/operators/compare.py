"""Comparison of statement figures with a vendor extract: metrics, gates, amounts, spot checks, batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import truthy
from .scorecard import count_if
from .status import dictionary_status

# What a mapping may call the relation of two fields; the amounts that are compared.
MAPPING_TYPES = ["exact", "derived", "approximate", "ambiguous", "not_disclosed", "not_applicable"]
AMOUNT_FIELDS = ["capital_invested", "current_cost", "unrealized_value", "realized_proceeds", "total_value"]
WRITTEN_DOWN_RATIO = 0.25


def _dec(c: Column) -> Column:
    return c.cast("decimal(38,6)")


def prefer_reported_or_lot_sum(reported: Column, calculated: Column, field: str, tolerance: float = 1.0) -> Column:
    """struct(value, source): the printed figure, unless it is missing or the lots add up to more than it by over the tolerance."""
    r, c, at = _dec(reported), _dec(calculated), "pdf_investments"
    value = F.when(r.isNull() & c.isNull(), _dec(F.lit(0))).when(r.isNull(), c).when(c.isNull(), r).when(F.abs(r - c) <= tolerance, r).when(c > r, c).otherwise(r)
    source = (
        F.when(r.isNull() & c.isNull(), f"assumed_zero_missing_{field}")
        .when(r.isNull(), f"{at}_{field}_lot_sum")
        .when(c.isNull() | truthy(F.abs(r - c) <= tolerance), f"{at}_{field}_reported")
        .when(c > r, f"{at}_{field}_lot_sum_exceeds_printed_subtotal")
        .otherwise(f"{at}_{field}_reported_lot_sum_incomplete")
    )
    return F.struct(value.alias("value"), source.alias("source"))


def infer_statuses(companies: DataFrame, realized_names: DataFrame) -> DataFrame:
    """companies (canonical, cost, fair_value, ..) with the status inferred from presence in both schedules and the ratio of value to cost.

    realized_names is (canonical). A cost that is missing or not positive leaves the ratio unknown.
    """
    known = realized_names.select(F.col("canonical").alias("rc")).where("rc is not null").distinct()
    rows = companies.join(known, F.col("canonical") == F.col("rc"), "left").withColumn("in_realized", F.col("rc").isNotNull()).drop("rc")
    usable = truthy(F.col("cost") > 0) & F.col("fair_value").isNotNull()
    ratio = F.col("fair_value") / F.nullif(F.col("cost"), F.lit(0))
    level = F.when(~usable, "no_fmv").when(F.col("fair_value") == 0, "zero").when(ratio < WRITTEN_DOWN_RATIO, "low").otherwise("normal")
    # Status and rule by schedule and level of the remaining value.
    table = {
        (True, "zero"): ("Partially Exited, Remainder Written Down", "in_both_schedules_remainder_fmv_zero"),
        (True, "low"): ("Partially Exited, Remainder Written Down", "in_both_schedules_remainder_below_threshold"),
        (True, "normal"): ("Partially Exited", "in_both_schedules"),
        (True, "no_fmv"): ("Partially Exited", "in_both_schedules_no_fmv"),
        (False, "zero"): ("Written Off", "investments_only_fmv_zero"),
        (False, "low"): ("Written Down", "investments_only_fmv_below_threshold"),
        (False, "normal"): ("Current", "investments_only"),
        (False, "no_fmv"): ("Current", "investments_only_no_fmv"),
    }
    rows = rows.withColumn("level", level)
    pick = lambda i: reduce(lambda c, kv: c.when((F.col("in_realized") == kv[0][0]) & (F.col("level") == kv[0][1]), kv[1][i]), table.items(), F)
    return rows.withColumn("deal_status_inferred", pick(0)).withColumn("inference_rule", pick(1)).withColumn("inference_confidence", F.lit(0.9)).drop("level")


def infer_realized_statuses(lots: DataFrame, investment_names: DataFrame) -> DataFrame:
    known = investment_names.select(F.col("canonical").alias("ic")).where("ic is not null").distinct()
    rows = lots.join(known, F.col("canonical") == F.col("ic"), "left")
    held = F.col("ic").isNotNull()
    return rows.withColumn("deal_status_inferred", F.when(held, "Partially Exited").otherwise("Fully Exited")).withColumn("inference_rule", F.when(held, "in_both_schedules").otherwise("realized_only")).drop("ic")


def comparable_metrics(mappings: DataFrame, summary: DataFrame, realized: DataFrame) -> DataFrame:
    """One row for each confirmed mapping (name, realized_name, vendor_name, confirmed).

    summary is (company_name, cost_reported, cost_calculated, fair_value_reported, fair_value_calculated), realized is (company, cost, proceeds, gain),
    both with a row for each company. What a schedule doesn't have counts as zero.
    """
    m = mappings.where("confirmed").withColumn("sold_name", F.coalesce("realized_name", "name"))
    rows = m.join(summary, m["name"] == summary["company_name"], "left").join(realized.select(F.col("company").alias("sold"), F.col("cost").alias("r_cost"), F.col("proceeds").alias("r_proceeds"), F.col("gain").alias("r_gain")), F.col("sold_name") == F.col("sold"), "left")
    held, sold = F.col("company_name").isNotNull(), F.col("sold").isNotNull()
    none = F.struct(_dec(F.lit(0)).alias("value"), F.lit("assumed_zero_fully_exited").alias("source"))
    rows = rows.withColumn("c", F.when(held, prefer_reported_or_lot_sum(F.col("cost_reported"), F.col("cost_calculated"), "cost")).otherwise(none))
    rows = rows.withColumn("u", F.when(held, prefer_reported_or_lot_sum(F.col("fair_value_reported"), F.col("fair_value_calculated"), "fair_value")).otherwise(none))
    zero = lambda c: F.coalesce(_dec(F.col(c)), _dec(F.lit(0)))
    cc, uv, rc, rp = F.col("c.value"), F.col("u.value"), zero("r_cost"), zero("r_proceeds")
    return rows.select(
        "vendor_name",
        "name",
        F.when(sold, F.col("sold_name")).alias("realized_name"),
        held.alias("has_unrealized_schedule"),
        sold.alias("has_realized_schedule"),
        cc.alias("current_cost"),
        F.col("c.source").alias("current_cost_source"),
        uv.alias("unrealized_value"),
        F.col("u.source").alias("unrealized_value_source"),
        rc.alias("realized_cost"),
        rp.alias("realized_proceeds"),
        zero("r_gain").alias("realized_gain_loss"),
        _dec(cc + rc).alias("capital_invested"),
        _dec(uv + rp).alias("total_value"),
        dictionary_status(uv, rp).alias("deal_status_derived"),
    )


def amount_comparison(metrics: DataFrame, vendor: DataFrame, has_realized_schedule: bool = True, tolerance: float = 1.0) -> DataFrame:
    """(vendor_name, logical_field, ours, theirs, difference, status) for each mapped company and field, and a row for each unmapped vendor name.

    vendor is (source_asset, row_id, deal_status, amounts); of rows with one name the last counts. Vendor figures are compared as decimals.
    """
    cells = [*AMOUNT_FIELDS, "deal_status"]
    one = vendor.where("source_asset is not null").groupBy("source_asset").agg(F.max_by(F.struct(*cells), "row_id").alias("v"))
    both = metrics.join(one, metrics["vendor_name"] == one["source_asset"], "left")
    found = F.col("source_asset").isNotNull()
    text = lambda c: c.cast("string")

    def amount(f: str) -> Column:
        ours, theirs = _dec(F.col(f)), _dec(text(F.col(f"v.{f}")))
        status = F.when(ours.isNull() & theirs.isNull(), "both_missing").when(theirs.isNull(), "csv_missing").when(ours.isNull(), "pdf_missing").when(F.abs(theirs - ours) <= tolerance, "match").otherwise("mismatch")
        return F.struct(F.lit(f).alias("logical_field"), text(ours).alias("ours"), text(theirs).alias("theirs"), _dec(theirs - ours).alias("difference"), status.alias("status"))

    ds = F.struct(F.lit("deal_status").alias("logical_field"), F.col("deal_status_derived").alias("ours"), F.col("v.deal_status").alias("theirs"), F.lit(None).cast("decimal(38,6)").alias("difference"), F.when(F.col("deal_status_derived").eqNullSafe(F.col("v.deal_status")), "match").otherwise("mismatch").alias("status"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("logical_field", "string"), ("ours", "string"), ("theirs", "string"), ("difference", "decimal(38,6)"))]
    unresolved = F.array(F.struct(*nothing, F.lit("entity_unresolved").alias("status")))
    fields = F.array(*([ds] if has_realized_schedule else []), *[amount(f) for f in AMOUNT_FIELDS])
    compared = both.select("vendor_name", F.explode(F.when(found, fields).otherwise(unresolved)).alias("x")).select("vendor_name", "x.*")
    only = one.join(metrics, one["source_asset"] == metrics["vendor_name"], "left_anti").select(F.col("source_asset").alias("vendor_name"), *nothing, F.lit("vendor_only_unmapped").alias("status"))
    return compared.unionByName(only)


def vendor_only(metrics: DataFrame, vendor: DataFrame) -> DataFrame:
    names = vendor.select("source_asset").where("source_asset is not null").distinct()
    return names.join(metrics, names["source_asset"] == metrics["vendor_name"], "left_anti")


def without_noise(vendor: DataFrame, exclude: str) -> DataFrame:
    """Vendor rows whose asset doesn't match the pattern; a null asset stays."""
    return vendor.where(~truthy(F.col("source_asset").rlike(exclude)))


def amount_tallies(compared: DataFrame) -> DataFrame:
    return compared.agg(count_if(F.col("status") == "match").alias("matches"), count_if(F.col("status") == "mismatch").alias("mismatches"), count_if(~F.col("status").isin("match", "mismatch")).alias("other"))


def gates(documents: DataFrame) -> DataFrame:
    """The nine comparability gates of each document, as rows (doc_id, position, gate, status, blocks_amounts).

    documents has extraction_mode, quality_status, aggregate_ok, comparison_grain, vendor_fund_id, require_fund_id, as_of, vendor_dates (array),
    currency, unit (null if not disclosed), currency_field, unit_field (whether the vendor has them), currency_waiver, unit_waiver, critical_unresolved
    and confirmed_entities. A waiver stands in for a currency or unit that isn't disclosed.
    """
    c = F.col
    mode, quality = c("extraction_mode"), c("quality_status")
    fund = ~F.coalesce(c("require_fund_id"), F.lit(True)) | truthy(F.trim(c("vendor_fund_id")) != "")
    dated = fund & truthy(F.array_contains("vendor_dates", c("as_of")))
    extraction = (
        F.when(mode.isin("blocked_narrative", "manual_review"), False)
        .when(mode == "position_level_inferred", ~F.coalesce(quality.isin("FAIL", "REVIEW_REQUIRED", "BLOCKED"), F.lit(True)))
        .when(mode == "fund_aggregate_only", truthy(c("aggregate_ok")))
        .otherwise(quality.isNull() | truthy(quality == "PASS"))
    )
    waived = lambda f: fund & ((c(f).isNotNull() & truthy(c(f"{f}_field"))) | truthy(c(f"{f}_waiver")))
    grain = F.when(mode == "fund_aggregate_only", dated).otherwise(dated & truthy(c("confirmed_entities") > 0) & (mode == "position_level"))
    held = [
        ("extraction_quality", extraction, True),
        ("schedule_grain", ~mode.isin("blocked_narrative", "manual_review"), None),
        ("metric_availability", F.lit(True), False),
        ("fund_identity", fund, True),
        ("as_of_date", dated, True),
        ("currency", waived("currency"), True),
        ("unit", waived("unit"), True),
        ("field_semantics", dated & (fund | ~truthy(c("critical_unresolved"))), True),
        ("data_grain", grain, True),
    ]
    parts = []
    for i, (name, ok, blocks) in enumerate(held):
        blocked = ~ok if blocks is None else F.lit(blocks)
        parts.append(F.struct(F.lit(i).alias("position"), F.lit(name).alias("gate"), F.when(ok, "PASS").otherwise("FAIL").alias("status"), blocked.alias("blocks_amounts")))
    return documents.select("doc_id", F.explode(F.array(*parts)).alias("x")).select("doc_id", "x.*")


def comparability(gate_rows: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc_id, comparability_status, blocking_gates): comparable unless a blocking gate fails."""
    failed = (F.col("status") == "FAIL") & F.col("blocks_amounts")
    names = gate_rows.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.when(failed, F.struct("position", "gate")))).alias("f"))
    rows = names.join(documents.select("doc_id", "extraction_mode"), "doc_id")
    ok = F.size("f") == 0
    status = F.when(~ok, "not_comparable").when(F.col("extraction_mode") == "fund_aggregate_only", "aggregate_only_comparable").otherwise("comparable")
    return rows.select("doc_id", status.alias("comparability_status"), F.array_join(F.transform("f", lambda x: x["gate"]), ",").alias("blocking_gates"))


def field_dictionary(rows: DataFrame) -> DataFrame:
    """rows unchanged; an unknown mapping_type raises when they are read."""
    known = F.coalesce(F.col("mapping_type").isin(MAPPING_TYPES), F.lit(False))
    return rows.withColumn("mapping_type", F.when(known, F.col("mapping_type")).otherwise(F.raise_error(F.concat(F.lit("unknown mapping_type: "), F.coalesce("mapping_type", F.lit("null"))))))


def spot_checks(gate_rows: DataFrame, dictionary: DataFrame, compared: DataFrame) -> DataFrame:
    """(kind, item, status): gates, fields (match if all their amounts match, mismatch if any doesn't) and amounts."""
    g = gate_rows.select(F.lit("gate").alias("kind"), F.col("gate").alias("item"), "status")
    by = compared.where("logical_field is not null").groupBy(F.col("logical_field").alias("lf")).agg(F.bool_and(F.col("status") == "match").alias("every"), F.bool_or(F.col("status") == "mismatch").alias("any"))
    f = dictionary.join(by, F.col("logical_field") == F.col("lf"), "left").select(F.lit("field").alias("kind"), F.col("logical_field").alias("item"), F.when(F.col("any"), "mismatch").when(F.col("every"), "match").otherwise("not_compared").alias("status"))
    a = compared.select(F.lit("amount").alias("kind"), F.concat_ws("/", "vendor_name", "logical_field").alias("item"), "status")
    return g.unionByName(f).unionByName(a)


def aggregate_rows(aggregates: DataFrame) -> DataFrame:
    """Cost and fair value of documents without positions, for information only."""
    parts = F.array(*[F.struct(F.lit(f).alias("logical_field"), F.col(c).alias("ours"), F.lit("informational").alias("status")) for f, c in (("current_cost", "cost"), ("unrealized_value", "fair_value"))])
    return aggregates.select("doc_id", F.explode(parts).alias("x")).select("doc_id", "x.*")


def onboarding(documents: DataFrame) -> DataFrame:
    """Inferred documents may not be compared; two review tasks each."""
    rows = documents.where("extraction_mode = 'position_level_inferred'")
    tasks = F.array(*map(F.lit, ["approve_inferred_schema", "confirm_entity_mappings"]))
    return rows.select("doc_id", F.lit(False).alias("compare_allowed"), F.explode(tasks).alias("task"))


def batch_summary(results: DataFrame) -> DataFrame:
    """Documents by mode and outcome; a failure is a row with an error, not an exception."""
    return results.groupBy("extraction_mode").agg(F.count("*").alias("documents"), count_if(F.col("error").isNotNull()).alias("errors"), count_if(F.col("comparability_status") == "comparable").alias("comparable"), count_if(F.col("comparability_status") == "not_comparable").alias("not_comparable"))


def last_by_key(rows: DataFrame, key: str, value: str, position: str) -> DataFrame:
    """The last value of each key: what writing rows into a map one after another leaves."""
    return rows.groupBy(key).agg(F.max_by(value, position).alias(value))


def first_claims(rows: DataFrame, key: str, position: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(position)
    return rows.withColumn("claim_", F.row_number().over(w)).where("claim_ = 1").drop("claim_")
