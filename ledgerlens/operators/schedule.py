"""Schedule rows of fund statements: row states, lots and company summaries.

Rows are (doc_id, page, table_order, row_index) with one text column for each cell. What the reference order of rows decides (the company
a row belongs to, which a subtotal closes) is expressed with windows over one document.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import truthy
from ..functions.numbers import CURRENCY_TOKENS, clean_cell, has_date, is_blank, parse_number, usable

CELLS = ["company", "date", "round", "shares", "cost", "fair_value", "gain"]
AMOUNTS = ["cost", "fair_value", "gain"]
REALIZED = ["company", "purchase_date", "exit_date", "transaction", "cost", "proceeds", "escrow", "gain"]
# Tokens of repeated headers and rows to ignore.
HEADER_TOKENS = ["company", "date", "round", "shares", "cost", "fair value", "gain"]
IGNORED = [r"^continued.*$", r"^page \d+$"]
ORDER = ["page", "table_order", "row_index"]


def _joined(cells: list[str]) -> Column:
    return F.lower(F.concat_ws(" ", *cells))


def _header(cells: list[str]) -> Column:
    """At least three header tokens in the row."""
    text = _joined(cells)
    return reduce(lambda a, b: a + b, [text.contains(t).cast("int") for t in HEADER_TOKENS]) >= 3


def _stateless(rows: DataFrame) -> DataFrame:
    blank = {c: is_blank(F.col(c)) for c in CELLS}
    amounts = reduce(or_, [~blank[c] & ~F.trim(F.col(c)).isin(CURRENCY_TOKENS) for c in AMOUNTS])
    total_like = amounts & blank["company"] & blank["date"] & blank["round"] & blank["shares"] & ~has_date(F.col("date"))
    dollar = reduce(or_, [F.col(c).contains("$") for c in AMOUNTS])
    lot = has_date(F.col("date")) | (~blank["company"] & ~blank["round"])
    ignored = reduce(and_, blank.values()) | reduce(or_, [F.trim(_joined(CELLS)).rlike(p) for p in IGNORED])
    kind = F.when(_header(CELLS), "repeated_header").when(ignored, "blank_or_noise").when(total_like & dollar, "grand_total").when(total_like, "subtotal").when(lot, "lot").otherwise("blank_or_noise")
    cleaned = rows.select(*[clean_cell(F.col(c)).alias(c) if c in CELLS else F.col(c) for c in rows.columns])
    return cleaned.withColumn("kind", kind)


def classify_rows(rows: DataFrame) -> DataFrame:
    """rows with row_type, company_name (of lots and subtotals), inherited and issue.

    A lot names its company or takes the active one, a subtotal or grand total closes it. A subtotal on a later page than the last lot is a
    page continuation. A lot without any active company is noise with an issue.
    """
    order = Window.partitionBy("doc_id").orderBy(*ORDER)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    states = _stateless(rows).withColumn("segment", F.coalesce(F.sum(F.col("kind").isin("grand_total", "subtotal").cast("int")).over(before), F.lit(0)))
    inside = Window.partitionBy("doc_id", "segment").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    own = F.when((F.col("kind") == "lot") & ~is_blank(F.col("company")), F.col("company"))
    states = states.withColumn("active", F.last(own, ignorenulls=True).over(inside))
    states = states.withColumn("lot_page", F.last(F.when((F.col("kind") == "lot") & F.col("active").isNotNull(), F.col("page")), ignorenulls=True).over(inside))
    lot, sub = F.col("kind") == "lot", F.col("kind") == "subtotal"
    orphan = lot & F.col("active").isNull()
    kind = F.when(orphan, "blank_or_noise").when(lot, "investment_lot").when(sub & truthy(F.col("page") != F.col("lot_page")), "page_continuation").when(sub, "company_subtotal").otherwise(F.col("kind"))
    return states.select(
        *rows.columns,
        kind.alias("row_type"),
        F.when(lot | sub, F.col("active")).alias("company_name"),
        (lot & F.col("active").isNotNull() & is_blank(F.col("company"))).alias("inherited"),
        F.when(orphan, "lot_without_active_company").alias("issue"),
    )


def row_type_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("row_type").agg(F.count("*").alias("rows"))


def lots(classified: DataFrame) -> DataFrame:
    """Investment lots with a parsed struct n_<field> for shares and amounts. A dash is zero in amounts, unknown in shares."""
    rows = classified.where("row_type = 'investment_lot'")
    return rows.withColumns({f"n_{c}": parse_number(F.col(c), dash_is_zero=c != "shares") for c in ["shares", *AMOUNTS]})


def company_summary(classified: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """(doc_id, company_name): lots, their sums, the last printed subtotal, differences and a status each.

    PASS needs both sides within the tolerance; a missing side fails.
    """
    lot, event = F.col("row_type") == "investment_lot", F.col("row_type").isin("company_subtotal", "page_continuation")
    pages = F.array_sort(F.collect_set(F.when(lot, F.col("page"))))
    value = lambda c: usable(F.col(f"n_{c}"))
    rows = classified.where(lot | event).where("company_name is not null").withColumns({f"n_{c}": parse_number(F.col(c)) for c in AMOUNTS})
    out = rows.groupBy("doc_id", "company_name").agg(
        F.count(F.when(lot, 1)).alias("lot_count"),
        F.array_join(F.transform(pages, lambda p: p.cast("string")), ",").alias("pages"),
        *[F.sum(F.when(lot, value(c))).alias(f"{c}_calculated") for c in AMOUNTS],
        *[F.max_by(F.struct(value(c).alias("v")), F.when(event, F.struct(*ORDER))).alias(f"{c}_event") for c in AMOUNTS],
    )
    out = out.where("lot_count > 0")
    for c in AMOUNTS:
        out = out.withColumn(f"{c}_reported", F.col(f"{c}_event.v")).withColumn(f"{c}_difference", F.col(f"{c}_calculated") - F.col(f"{c}_reported"))
        out = out.withColumn(f"{c}_status", F.when(truthy(F.abs(F.col(f"{c}_difference")) <= tolerance), "PASS").otherwise("FAIL"))
    return out.drop(*[f"{c}_event" for c in AMOUNTS])


def classify_realized(rows: DataFrame) -> DataFrame:
    """rows of the realized schedule with row_type: repeated_header, total, investment_lot or blank_or_noise."""
    cleaned = rows.select(*[clean_cell(F.col(c)).alias(c) if c in REALIZED else F.col(c) for c in rows.columns])
    company = F.lower(F.trim("company"))
    everything_blank = reduce(and_, [is_blank(F.col(c)) for c in REALIZED])
    kind = F.when(_header(REALIZED), "repeated_header").when(everything_blank, "blank_or_noise").when(company == "total", "total").when(is_blank(F.col("company")), "blank_or_noise").otherwise("investment_lot")
    return cleaned.withColumn("row_type", kind)


def realized_rollup(classified: DataFrame) -> DataFrame:
    rows = classified.where("row_type = 'investment_lot'")
    return rows.groupBy("doc_id", "company").agg(F.count("*").alias("lot_count"), *[F.sum(usable(parse_number(F.col(c)))).alias(c) for c in ("cost", "proceeds", "gain")])


def parse_rates(lot_rows: DataFrame) -> DataFrame:
    """Share of lots whose cell states a number, for each field."""
    fields = ["shares", *AMOUNTS]
    row = lot_rows.agg(*[F.round(F.avg(F.col(f"n_{c}.status").isin("ok", "zero", "dash").cast("double")), 6).alias(f"rate_{c}") for c in fields])
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"rate_{c}").alias("parse_rate")) for c in fields])).alias("x")).select("x.*")
