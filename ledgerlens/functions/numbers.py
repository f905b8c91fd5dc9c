"""Reported cells: text, numbers and dates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import let, truthy

# What stands for no value, and for a dash; date formats in the order in which they are tried.
BLANKS = [""]
DASHES = ["-", "—", "–", "$-", "$ -"]
CURRENCY_TOKENS = ["$"]
DATE_FORMATS = ["d-MMM-yy", "d-MMM-yyyy", "yyyy-MM-dd", "d/M/yyyy"]
MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"
DATE_CELL = r"^\d{1,2}/\d{1,2}/\d{4}"


def clean_cell(value: Column) -> Column:
    """One line, single spaces, trimmed; null becomes empty."""
    spaced = F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), "[\\s ]+", " ")
    return F.trim(spaced)


def is_blank(cell: Column) -> Column:
    return F.lower(F.trim(cell)).isin(BLANKS)


def is_dash(cell: Column) -> Column:
    return F.regexp_replace(cell, r"\s+", "").isin(DASHES) | F.trim(cell).isin(DASHES)


def format_decimal(value: Column) -> Column:
    """Plain digits without an exponent or trailing zeros."""
    text = value.cast("decimal(38,6)").cast("string")
    return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def parse_number(value: Column, dash_is_zero: bool = True) -> Column:
    """struct(raw, normalized, number, status) of a reported cell; status is blank, dash, zero, ok or parse_error.

    Signs of currency and per cent and thousands separators are removed, parentheses make it negative. A number is digits with at most one
    point and a sign: exponents and words such as NaN are errors.
    """

    def number_of(raw: Column) -> Column:
        return let(
            F.regexp_replace(raw, r"[$,%\s]", ""),
            lambda bare: let(
                F.regexp_replace(bare, r"^\((.*)\)$", "$1"),
                lambda text: F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), text.try_cast("decimal(38,6)") * F.when(bare.startswith("(") & bare.endswith(")"), -1).otherwise(1)).cast("decimal(38,6)"),
            ),
        )

    def status_of(raw: Column, number: Column) -> Column:
        return F.when(is_blank(raw), "blank").when(is_dash(raw), "dash").when(number.isNull(), "parse_error").when(number == 0, "zero").otherwise("ok")

    def result(x: Column) -> Column:
        dash = F.lit(0).cast("decimal(38,6)") if dash_is_zero else F.lit(None).cast("decimal(38,6)")
        stated = F.when(x["status"] == "dash", dash).when(x["status"].isin("zero", "ok"), x["number"])
        return let(stated, lambda v: F.struct(x["raw"].alias("raw"), format_decimal(v).alias("normalized"), v.alias("number"), x["status"].alias("status")))

    parts = let(clean_cell(value), lambda raw: let(number_of(raw), lambda n: F.struct(raw.alias("raw"), n.alias("number"), status_of(raw, n).alias("status"))))
    return let(parts, result)


def usable(parsed: Column) -> Column:
    """The number where the cell states one."""
    return F.when(parsed["status"].isin("ok", "zero", "dash"), parsed["number"])


def with_amounts(rows: DataFrame, cells: list[str]) -> DataFrame:
    """rows with v_<cell>: ``usable(parse_number(cell))`` of each cell, in steps that are compiled, as no lambda is."""
    raw, bare, text = ({c: F.col(f"{step}_{c}") for c in cells} for step in ("raw", "bare", "text"))
    out = rows.withColumns({f"raw_{c}": clean_cell(F.col(c)) for c in cells})
    out = out.withColumns({f"bare_{c}": F.regexp_replace(raw[c], r"[$,%\s]", "") for c in cells})
    out = out.withColumns({f"text_{c}": F.when(bare[c].startswith("("), F.regexp_replace(bare[c], r"^\((.*)\)$", "$1")).otherwise(bare[c]) for c in cells})
    sign = lambda c: F.when(bare[c].startswith("(") & bare[c].endswith(")"), -1).otherwise(1)
    number = lambda c: F.when(text[c].rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), text[c].try_cast("decimal(38,6)") * sign(c)).cast("decimal(38,6)")
    value = lambda c: F.when(is_blank(raw[c]), None).when(is_dash(raw[c]), F.lit(0).cast("decimal(38,6)")).otherwise(number(c))
    return out.withColumns({f"v_{c}": value(c) for c in cells}).drop(*[f"{step}_{c}" for step in ("raw", "bare", "text") for c in cells])


def parse_date(value: Column, formats: list[str] = DATE_FORMATS) -> Column:
    parsed = [F.try_to_timestamp(value, F.lit(f)).cast("date") for f in formats]
    # Two digits of a year from 69 on belong to the last century.
    parsed = [F.when(F.year(d) >= 2069, F.add_months(d, -1200)).otherwise(d) if f.endswith("-yy") else d for d, f in zip(parsed, formats, strict=True)]
    return F.coalesce(*parsed)


def has_date(cell: Column) -> Column:
    """A date, or a date with something glued to its end."""
    return truthy(F.trim(cell).rlike(DATE_CELL))


def digits_only(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "").try_cast("long")


def clean_number(value: Column) -> Column:
    """Digits only, so that a decimal point is dropped; negative with a parenthesis or a leading minus."""
    n = digits_only(value)
    return F.when(value.contains("(") | F.ltrim(value).startswith("-"), -n).otherwise(n)


def as_of_date(text: Column) -> Column:
    """Date of a statement: after "as of", "ended" or "to"; else the last date in words; else the first dd-dd-yyyy, read as month first."""
    low = F.lower(text)
    date = rf"({MONTHS})\s+(\d{{1,2}}),\s*(\d{{4}})"

    def iso(source: Column, pattern: str, at: int) -> Column:
        part = lambda i: F.regexp_extract(source, pattern, i)
        name = part(at)
        month = F.array_position(F.array(*map(F.lit, MONTHS.split("|"))), name)
        return F.when(name != "", F.concat_ws("-", part(at + 2), F.lpad(month.cast("string"), 2, "0"), F.lpad(part(at + 1), 2, "0")))

    preferred = [iso(low, rf"{word}\s+{date}", 1) for word in ("as of", "ended", "to")]
    last = F.get(F.reverse(F.regexp_extract_all(low, F.lit(rf"({date})"), F.lit(1))), F.lit(0))
    numeric = r"(\d{2})-(\d{2})-(\d{4})"
    dashed = F.when(low.rlike(numeric), F.concat_ws("-", F.regexp_extract(low, numeric, 3), F.regexp_extract(low, numeric, 1), F.regexp_extract(low, numeric, 2)))
    return reduce(lambda a, b: F.coalesce(a, b), [*preferred, iso(F.coalesce(last, F.lit("")), date, 1), dashed])
