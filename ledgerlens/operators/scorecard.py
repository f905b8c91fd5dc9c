"""Completeness and cleanliness of a holdings panel.

Every function is one or two aggregates over the panel; scores of several fields are computed side by side in one pass and
only the aggregated rows are unpivoted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import malformed, needs_review, source_asset_class, truthy
from ..schema import AS_AT, ASSET, ASSET_ID, CHECKED, CLASSES, DEFAULTS, FUND, MANAGER, MANDATORY, Params
from ..sources.shared import settled
from .ordinals import running_total

long = lambda c: c.cast("long")


def required(rows: DataFrame, columns: list[str]) -> DataFrame:
    """rows, if they have all the columns; else an error that names the missing ones."""
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return rows


def count_if(condition: Column) -> Column:
    return F.count(F.when(truthy(condition), 1))


def share(condition: Column) -> Column:
    """Share of rows; 6 digits are kept, so that engines agree."""
    return F.round(F.avg(truthy(condition).cast("double")), 6)


def filled(fields: list[str] = MANDATORY) -> Column:
    """How many of the fields a row fills."""
    return sum((F.col(f).isNotNull().cast("int") for f in fields[1:]), F.col(fields[0]).isNotNull().cast("int"))


def ratio(part: Column, whole: Column) -> Column:
    """Null where there is no whole, as over an empty table."""
    return F.try_divide(part.cast("double"), whole)


def completeness(fields: list[str] = MANDATORY) -> Column:
    return F.round(F.sum(filled(fields)) / (F.count("*") * len(fields)), 6)


def unpivoted(row: DataFrame, names: list[str], keys: list[str], measures: dict[str, str], name: str = "field") -> DataFrame:
    """Turns columns <measure>_<name> of an aggregated frame into rows; measures are column prefix -> output name."""
    parts = F.array(*[F.struct(F.lit(n).alias(name), *[F.col(f"{prefix}_{n}").alias(out) for prefix, out in measures.items()]) for n in names])
    return row.select(*keys, F.explode(parts).alias("x")).select(*keys, "x.*")


# ---- rows


def annotate(panel: DataFrame) -> DataFrame:
    kind = panel.withColumn("source_asset_class", source_asset_class(F.col(ASSET)))
    return kind.withColumn("is_scorable", F.col("source_asset_class").isin("holding", "unnamed_aggregate")).withColumn("is_resolvable", F.col("source_asset_class") == "holding").withColumn("needs_name_review", needs_review(F.col(ASSET)))


def scorable(panel: DataFrame) -> DataFrame:
    """Annotated rows that are scored. The class decides first, so that the other marks are computed for rows that stay."""
    return annotate(panel.where(source_asset_class(F.col(ASSET)).isin("holding", "unnamed_aggregate")))


def excluded_rows(panel: DataFrame) -> DataFrame:
    return annotate(panel).where("not is_scorable")


def source_asset_summary(panel: DataFrame) -> DataFrame:
    kinds = annotate(panel).groupBy("source_asset_class").agg(F.count("*").alias("rows"), F.countDistinct(ASSET).alias("distinct_names"))
    total = kinds.agg(F.sum("rows").alias("total"))
    order = F.array_position(F.array(*map(F.lit, CLASSES)), F.col("source_asset_class")).alias("class_order")
    return kinds.crossJoin(F.broadcast(total)).select("source_asset_class", order, "rows", "distinct_names", F.round(F.col("rows") / F.col("total"), 6).alias("share_of_rows"))


def newly_excluded(panel: DataFrame, prefix: str) -> DataFrame:
    """Rows that the classifier excludes and a filter on the prefix alone kept."""
    rows = annotate(panel).where(~F.col("is_scorable") & ~truthy(F.col(ASSET).rlike(prefix)))
    return rows.groupBy("source_asset_class", ASSET).agg(F.count("*").alias("rows"))


def review_queue(panel: DataFrame) -> DataFrame:
    return annotate(panel).where("needs_name_review").groupBy(ASSET).agg(F.count("*").alias("rows"), F.countDistinct(FUND).alias("funds"))


# ---- profile


def attribute_missingness(panel: DataFrame, fields: list[str]) -> DataFrame:
    row = panel.agg(F.count("*").alias("n"), *[F.count(F.when(F.col(f).isNull(), 1)).alias(f"missing_{f}") for f in fields])
    out = unpivoted(row, fields, ["n"], {"missing": "missing_cnt"}, "column_name")
    return out.where("missing_cnt > 0").select("column_name", "missing_cnt", F.round(ratio(100 * F.col("missing_cnt"), F.col("n")), 4).alias("missing_pnt"))


def missingness_histogram(panel: DataFrame, fields: list[str]) -> DataFrame:
    row = panel.agg(F.count("*").alias("n"), *[F.count(F.when(F.col(f).isNull(), 1)).alias(f"missing_{f}") for f in fields])
    out = unpivoted(row, fields, ["n"], {"missing": "k"}, "column_name").select(F.round(ratio(100 * F.col("k"), F.col("n")), 4).alias("missing_pnt"))
    return out.groupBy("missing_pnt").agg(F.count("*").alias("columns"))


def drop_empty_and_unit_columns(panel: DataFrame) -> DataFrame:
    """Without the columns that are null in all rows and those whose name ends in Unit. The profile is one aggregate."""
    kept = [c for c in panel.columns if not c.lower().endswith("unit")]
    counts = panel.agg(*[F.count(c).alias(c) for c in kept]).first()
    return panel.select(*[c for c in kept if counts[c]])


def full_row_duplicates(panel: DataFrame) -> DataFrame:
    """Rows equal to an earlier one in all columns."""
    copies = panel.groupBy(*panel.columns).count()
    return copies.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))


def grain_duplicates(panel: DataFrame, keys: list[str], top: int = 5) -> DataFrame:
    """The keys of most rows among those that occur more than once, with the number of all such rows and its share."""
    groups = panel.groupBy(*keys).agg(F.count("*").alias("rows"))
    total = groups.agg(F.sum("rows").alias("n"), F.coalesce(F.sum(F.when(F.col("rows") > 1, F.col("rows"))), F.lit(0)).alias("duplicated_rows"))
    first = groups.where("rows > 1").orderBy(F.desc("rows"), *keys).limit(top)
    return first.crossJoin(F.broadcast(total)).select(*keys, "rows", "duplicated_rows", F.round(F.col("duplicated_rows") / F.col("n"), 6).alias("share"))


def identifier_integrity(panel: DataFrame, identifiers: list[str]) -> DataFrame:
    stats = [x for i in identifiers for x in (F.countDistinct(i).alias(f"distinct_{i}"), count_if(malformed(F.col(i))).alias(f"bad_{i}"), F.countDistinct(F.when(malformed(F.col(i)), F.col(i))).alias(f"badd_{i}"), F.countDistinct(F.when(malformed(F.col(i)), F.col(FUND))).alias(f"funds_{i}"))]
    out = unpivoted(panel.agg(F.count("*").alias("n"), *stats), identifiers, ["n"], {"distinct": "distinct_values", "bad": "malformed_rows", "badd": "malformed_distinct", "funds": "funds_affected"}, "identifier")
    return out.withColumn("malformed_share", F.round(ratio(F.col("malformed_rows"), F.col("n")), 6)).drop("n")


def manager_blast_radius(panel: DataFrame) -> DataFrame:
    """Funds under a malformed manager id, and whether they also have a well-formed one."""
    bad = malformed(F.col(MANAGER))
    funds = panel.groupBy(FUND).agg(count_if(bad).alias("bad"), count_if(~bad & F.col(MANAGER).isNotNull()).alias("good")).where("bad > 0")
    out = funds.agg(F.count("*").alias("funds_touched"), count_if(F.col("good") > 0).alias("funds_also_valid"))
    return out.withColumn("verdict", F.when(F.col("funds_also_valid") > 0, "SPLIT").otherwise("self-contained"))


def fund_manager_cardinality(panel: DataFrame) -> DataFrame:
    return panel.groupBy(FUND).agg(F.countDistinct(MANAGER).alias("managers"))


def value_distribution(rows: DataFrame, field: str) -> DataFrame:
    counts = rows.groupBy(F.coalesce(F.col(field), F.lit("MISSING")).alias("value")).agg(F.count("*").alias("rows"))
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("rows").alias("n")))).select("value", "rows", F.round(F.col("rows") / F.col("n"), 6).alias("share"))


def structural_missing_effect(panel: DataFrame, field: str) -> DataFrame:
    gone = F.col(field).isNull().cast("double")
    out = annotate(panel).agg(F.round(F.avg(gone), 6).alias("missing_all"), F.round(F.avg(F.when(F.col("is_scorable"), gone)), 6).alias("missing_real"))
    return out.withColumn("effect", F.round(F.col("missing_all") - F.col("missing_real"), 6))


def field_fill_rate(real: DataFrame, fields: list[str]) -> DataFrame:
    row = real.agg(*[F.round(F.avg(F.col(f).isNotNull().cast("double")), 6).alias(f"fill_{f}") for f in fields])
    kind = F.when(F.col("fill_rate") == 0, "empty").when(F.col("fill_rate") == 1, "full").otherwise("partial")
    return unpivoted(row, fields, [], {"fill": "fill_rate"}).withColumn("kind", kind)


# ---- groups


def group_completeness(real: DataFrame, key: str) -> DataFrame:
    return real.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"), completeness().alias("completeness"))


def fund_completeness(real: DataFrame) -> DataFrame:
    return group_completeness(real, FUND)


def manager_scorecard(real: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    out = real.where(F.col(MANAGER).isNotNull()).groupBy(MANAGER).agg(F.count("*").alias("n_rows"), F.countDistinct(FUND).alias("n_funds"), F.countDistinct(ASSET).alias("n_companies"), completeness().alias("completeness"))
    return out.withColumn("evidence", F.when(F.col("n_rows") >= p.min_rows, "reliable").otherwise("low"))


def described(rows: DataFrame, value: str) -> DataFrame:
    q = [F.round(F.percentile(value, x), 6).alias(n) for x, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]
    return rows.agg(F.count(value).alias("n"), F.round(F.avg(value), 6).alias("mean"), F.round(F.stddev_samp(value), 6).alias("std"), F.min(value).alias("min"), *q, F.max(value).alias("max"))


def group_field_fill(real: DataFrame, key: str) -> DataFrame:
    """One row for each group and field."""
    wide = real.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"), *[F.round(F.avg(F.col(f).isNotNull().cast("double")), 6).alias(f"fill_{f}") for f in MANDATORY])
    return unpivoted(wide, MANDATORY, [key, "n_rows"], {"fill": "fill_rate"})


def manager_worst_field(real: DataFrame) -> DataFrame:
    """The field a manager fills least, the first in MANDATORY's order on a tie."""
    wide = real.where(F.col(MANAGER).isNotNull()).groupBy(MANAGER).agg(*[F.round(F.avg(F.col(f).isNotNull().cast("double")), 6).alias(f) for f in MANDATORY])
    worst = F.array_min(F.array(*[F.struct(F.col(f).alias("rate"), F.lit(i).alias("i"), F.lit(f).alias("field")) for i, f in enumerate(MANDATORY)]))
    return wide.select(MANAGER, worst.alias("w")).select(MANAGER, F.col("w.field").alias("worst_field"), F.col("w.rate").alias("fill_rate"))


def manager_fund_spread(real: DataFrame) -> DataFrame:
    funds = real.where(F.col(MANAGER).isNotNull() & F.col(FUND).isNotNull()).groupBy(MANAGER, FUND).agg(completeness().alias("c"))
    out = funds.groupBy(MANAGER).agg(F.max("c").alias("best"), F.min("c").alias("worst"), F.count("*").alias("n_funds")).where("n_funds > 1")
    return out.withColumn("spread", F.round(F.col("best") - F.col("worst"), 6))


def low_evidence_split(real: DataFrame, key: str, least: int) -> DataFrame:
    groups = real.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
    return groups.agg(count_if(F.col("n_rows") >= least).alias("ranked"), count_if(F.col("n_rows") < least).alias("low_evidence"))


def portfolio_concentration(real: DataFrame, field: str = "sector", top: int = 5) -> DataFrame:
    """The most frequent values with their share of all rows, those without a value included."""
    counts = real.groupBy(field).agg(F.count("*").alias("rows"))
    first = counts.where(F.col(field).isNotNull()).orderBy(F.desc("rows"), field).limit(top)
    return first.crossJoin(F.broadcast(counts.agg(F.sum("rows").alias("n")))).select(field, "rows", F.round(F.col("rows") / F.col("n"), 6).alias("share"))


def cross_fund_assets(real: DataFrame) -> DataFrame:
    return real.where(F.col("is_resolvable")).groupBy(ASSET).agg(F.countDistinct(FUND).alias("n_funds")).where("n_funds > 1")


def aggregation_buckets(panel: DataFrame) -> DataFrame:
    return annotate(panel).where("is_scorable and not is_resolvable").groupBy(ASSET).agg(F.countDistinct(FUND).alias("n_funds"), F.count("*").alias("rows")).where("n_funds > 1")


def name_id_cardinality(real: DataFrame) -> DataFrame:
    """How many names have several ids, and ids several names."""
    pairs = real.where(F.col(ASSET).isNotNull() & F.col(ASSET_ID).isNotNull()).select(ASSET, ASSET_ID).distinct()
    names = pairs.groupBy(ASSET).count().agg(F.count("*").alias("names"), count_if(F.col("count") > 1).alias("names_with_many_ids"), F.max("count").alias("most_ids"))
    ids = pairs.groupBy(ASSET_ID).count().agg(F.count("*").alias("ids"), count_if(F.col("count") > 1).alias("ids_with_many_names"), F.max("count").alias("most_names"))
    return names.crossJoin(F.broadcast(ids))


def resolution_scope(panel: DataFrame) -> DataFrame:
    rows = annotate(panel).where("is_resolvable")
    out = rows.agg(F.count("*").alias("rows"), F.countDistinct(ASSET).alias("distinct_names"), F.countDistinct(AS_AT).alias("periods"))
    return out.withColumn("rows_per_name", F.round(F.try_divide(F.col("rows").cast("double"), F.col("distinct_names")), 6))


def crosstab(rows: DataFrame, a: str, b: str, domain: list) -> DataFrame:
    """Counts of a by the values of domain; missing combinations are 0."""
    return rows.groupBy(a).agg(*[count_if(F.col(b) == v).alias(f"n_{str(v).lower().replace(' ', '_').replace(',', '')}") for v in domain])


# ---- distributions of fund scores


def field_polarisation(real: DataFrame) -> DataFrame:
    """For each field: funds at 0, up to a half, below 1, at 1; median, mean and share at the ends, in percent."""
    wide = real.where(F.col(FUND).isNotNull()).groupBy(FUND).agg(*[F.avg(F.col(f).isNotNull().cast("double")).alias(f"fill_{f}") for f in MANDATORY])
    funds = unpivoted(wide, MANDATORY, [FUND], {"fill": "r"})
    r = F.col("r")
    out = funds.groupBy("field").agg(
        F.count("*").alias("n_funds"),
        count_if(r == 0).alias("at_zero"),
        count_if((r > 0) & (r <= 0.5)).alias("low"),
        count_if((r > 0.5) & (r < 1)).alias("high"),
        count_if(r == 1).alias("at_one"),
        F.round(100 * F.percentile("r", 0.5), 1).alias("median_pct"),
        F.round(100 * F.avg("r"), 1).alias("mean_pct"),
    )
    return out.withColumn("polarised_pct", F.round(100 * (F.col("at_zero") + F.col("at_one")) / F.col("n_funds"), 1))


def fund_outliers(real: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    funds = fund_completeness(real)
    stats = funds.agg(F.avg("completeness").alias("mu"), F.stddev_samp("completeness").alias("sd"))
    z = (F.col("completeness") - F.col("mu")) / F.nullif(F.col("sd"), F.lit(0.0))
    return (
        funds.crossJoin(F.broadcast(stats))
        .withColumn("z", z)
        .agg(
            F.round(F.percentile("completeness", 0.1), 6).alias("p10"),
            F.round(F.percentile("completeness", 0.5), 6).alias("median"),
            count_if(F.col("completeness") < p.fill_threshold).alias("below_threshold"),
            count_if(F.col("completeness") >= p.full).alias("full"),
            count_if(F.col("z") > 2).alias("z_above_2"),
            count_if(F.col("z") < -2).alias("z_below_2"),
        )
    )


def z_scores(funds: DataFrame, value: str) -> DataFrame:
    stats = funds.agg(F.avg(value).alias("mu"), F.stddev_samp(value).alias("sd"))
    return funds.crossJoin(F.broadcast(stats)).withColumn("z", F.round((F.col(value) - F.col("mu")) / F.nullif(F.col("sd"), F.lit(0.0)), 6)).drop("mu", "sd")


def score_histogram(funds: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width bins from the least to the greatest value; the last bin holds the greatest."""
    ends = funds.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    at = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)))
    return funds.crossJoin(F.broadcast(ends)).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def size_quality(real: DataFrame) -> DataFrame:
    """By fund at the latest date: value (0 if none is known), its coverage, rows and completeness."""
    latest = latest_cross_section(real)
    return latest.groupBy(FUND).agg(F.round(F.coalesce(F.sum("total_value"), F.lit(0.0)), 2).alias("nav"), F.round(F.avg(F.col("total_value").isNotNull().cast("double")), 6).alias("nav_coverage"), F.count("*").alias("n_rows"), completeness().alias("quality"))


def latest_cross_section(rows: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(rows.agg(F.max(AS_AT).alias(AS_AT))), AS_AT, "left_semi")


def average_ranks(rows: DataFrame, columns: list[str]) -> DataFrame:
    """rows with r_<column>: rank from 1, ties share the mean rank.

    The ranks come from counts by value, in ranges of values: no task sorts them all. Columns are numbers; a null has no rank. rows are
    read several times for each column, so they are settled first.
    """
    rows = settled(rows)
    for c in columns:
        counts = rows.groupBy(F.col(c).alias("v_")).agg(F.count("*").alias("k_")).where("v_ is not null")
        ranked = running_total(counts, "v_", F.col("k_"), "total_").select("v_", (F.col("total_") - (F.col("k_") - 1) / 2).alias(f"r_{c}"))
        rows = rows.join(ranked, F.col(c) == F.col("v_"), "left").drop("v_")
    return rows


def size_quality_correlation(funds: DataFrame) -> DataFrame:
    """Pearson and Spearman of value and quality, and Spearman with the rows partialled out."""
    r = average_ranks(funds.where("nav > 0"), ["nav", "quality", "n_rows"])
    c = r.agg(F.corr("nav", "quality").alias("pearson"), F.corr("r_nav", "r_quality").alias("spearman"), F.corr("r_nav", "r_n_rows").alias("xz"), F.corr("r_quality", "r_n_rows").alias("yz"))
    partial = (F.col("spearman") - F.col("xz") * F.col("yz")) / F.sqrt((1 - F.col("xz") ** 2) * (1 - F.col("yz") ** 2))
    return c.select(F.round("pearson", 6).alias("pearson"), F.round("spearman", 6).alias("spearman"), F.round(partial, 6).alias("partial_spearman"))


def quartile_profile(funds: DataFrame, by: str = "nav", value: str = "quality") -> DataFrame:
    """Quartiles by edges, closed at the right; the first holds the least value."""
    e = funds.agg(*[F.percentile(by, q).alias(f"e{i}") for i, q in ((1, 0.25), (2, 0.5), (3, 0.75))])
    at = F.when(F.col(by) <= F.col("e1"), 1).when(F.col(by) <= F.col("e2"), 2).when(F.col(by) <= F.col("e3"), 3).otherwise(4)
    return funds.crossJoin(F.broadcast(e)).groupBy(at.alias("quartile")).agg(F.count("*").alias("n"), F.round(F.avg(value), 6).alias("mean_quality"), F.round(F.percentile(value, 0.5), 6).alias("median_quality"))


# ---- flags and checks


def missing_list(fields: list[str], failing: dict[str, Column] | None = None) -> Column:
    parts = [F.when(F.col(f).isNull() if failing is None else failing[f], F.lit(f)) for f in fields]
    return F.array_join(F.array_compact(F.array(*parts)), ", ")


def unconditional_flags(real: DataFrame, keys: list[str], fields: list[str] = CHECKED) -> DataFrame:
    n = len(fields) - filled(fields)
    return real.select(*keys, n.alias("n_missing"), missing_list(fields).alias("missing_fields")).where("n_missing > 0")


def investment_key() -> Column:
    return F.coalesce(F.col(ASSET_ID), F.col(ASSET))


def data_state_summary(panel: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    a = annotate(panel)
    rows = a.agg(F.count("*").alias("rows"), count_if(F.col("is_scorable")).alias("scorable"), count_if(F.col("is_resolvable")).alias("resolvable"), F.countDistinct(FUND).alias("funds"), F.countDistinct(MANAGER).alias("managers"), F.countDistinct(AS_AT).alias("dates"), F.countDistinct("reporting_currency").alias("currencies"))
    funds = fund_completeness(a.where("is_scorable")).agg(F.round(F.avg("completeness"), 6).alias("mean_fund_completeness"), count_if(F.col("completeness") >= p.full).alias("funds_full"), count_if(F.col("completeness") < p.fill_threshold).alias("funds_below"), F.min("completeness").alias("least_completeness"))
    return rows.crossJoin(F.broadcast(funds))


def validation_checks(panel: DataFrame, grain: list[str]) -> DataFrame:
    """One row for each check with its severity and whether it holds."""
    funds = fund_completeness(scorable(panel)).agg(truthy(F.min("completeness") >= 0).alias("a"), truthy(F.max("completeness") <= 1).alias("b"))
    dup = panel.groupBy(*grain).count().agg(truthy(F.max("count") == 1).alias("g"))
    cur = panel.agg((F.countDistinct("reporting_currency") <= 1).alias("c"))
    units = F.lit(not any(c.lower().endswith("unit") for c in panel.columns))
    named = funds.crossJoin(F.broadcast(dup)).crossJoin(F.broadcast(cur))
    checks = [("scores within 0 and 1", "hard", F.col("a") & F.col("b")), ("no unit columns", "hard", units), ("unique grain", "soft", F.col("g")), ("one reporting currency", "soft", F.col("c"))]
    return named.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), F.lit(s).alias("severity"), ok.alias("holds")) for n, s, ok in checks])).alias("x")).select("x.*")
