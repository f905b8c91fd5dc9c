import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.functions import names as N
from ledgerlens.functions import numbers as U
from ledgerlens.operators import entity as E

CLASSIFIED = {
    "balance_sheet": ["Non-Investment Assets", "Net Non Investment Liabilities", " non-investmenta assets x", "NonInvestment Asset"],
    "accounting_entry": [None, "", "  ", "Quarterly Unrealized Gain/Loss", "Annual unrealized gains/(losses)", "AFS Gain/(Loss)", "ASC 740-10 Accrual", "Tax Distribution", "Cumulative loss foreign currency translation", "Cash", "Idle cash and cash equivalents.", "Pending Escrow", "Stock transfer receivable"],
    "subtotal": ["Total", "Subtotal equity", "total portfolio investments"],
    "unnamed_aggregate": ["Other", "Other - US - Tech", "Series seed investments", "Seed 2023-P", "Active Seed Deals", "Diversified Credit", "Residential", "Fund Investment", "Passive / Quickstart and Seed Investments", "Recycled Investment", "Secondary Market Investments"],
    "holding": ["Otherworld Games", "Cashmere Labs", "Totalis", "Seedling Bio", "Residential Finance Inc", "Column Payments", "Edge Investments"],
}


def test_classes(spark):
    cases = [(n, k) for k, ns in CLASSIFIED.items() for n in ns]
    rows = spark.createDataFrame(cases, "name string, wanted string").select("name", "wanted", N.source_asset_class(F.col("name")).alias("got")).collect()
    assert [(r["name"], r["got"]) for r in rows] == [(r["name"], r["wanted"]) for r in rows]


def test_names(spark):
    rows = spark.createDataFrame([("Acme (dba X), Inc.",), ("The Foo-Bar Holdings LLC",), (None,), ("",)], "n string").select(N.norm_name(F.col("n")).alias("a"), N.match_name(F.col("n")).alias("b"), N.needs_review(F.col("n")).alias("r")).collect()
    assert [r["a"] for r in rows] == ["acme", "the foo bar", None, ""]
    assert [r["b"] for r in rows] == ["acme x", "foo-bar holdings", None, ""]
    assert not any(r["r"] for r in rows)


NUMBERS = {
    None: (None, "blank"), "": (None, "blank"), " \n ": (None, "blank"), "-": ("0", "dash"), "$ -": ("0", "dash"), "$1,234": ("1234", "ok"), "(1,234)": ("-1234", "ok"), "($ 1,234.50)": ("-1234.5", "ok"),
    "0": ("0", "zero"), "()": (None, "parse_error"), "abc": (None, "parse_error"), "12%": ("12", "ok"), "1_000": (None, "parse_error"), "Infinity": (None, "parse_error"), "100": ("100", "ok"), ".5": ("0.5", "ok"), "-7": ("-7", "ok"),
}


def test_numbers(spark):
    rows = spark.createDataFrame([(k,) for k in NUMBERS], "t string").select("t", U.parse_number(F.col("t")).alias("n"), U.parse_number(F.col("t"), False).alias("m")).collect()
    assert {r["t"]: (r["n"]["normalized"], r["n"]["status"]) for r in rows} == NUMBERS
    assert all(r["m"]["number"] is None for r in rows if r["m"]["status"] == "dash")


def test_dates(spark):
    texts = {"as of March 31, 2026 and June 1, 2020": "2026-03-31", "from January 1, 2025 to March 31, 2025": "2025-03-31", "May 2, 2020, then May 3, 2021": "2021-05-03", "on 03-31-2026": "2026-03-31", "none": None}
    rows = spark.createDataFrame([(k,) for k in texts], "t string").select("t", U.as_of_date(F.col("t")).alias("d")).collect()
    assert {r["t"]: r["d"] for r in rows} == texts
    parsed = spark.createDataFrame([("31-Mar-26",), ("2026-03-31",), ("31/3/2026",), ("x",), (None,)], "t string").select(U.parse_date(F.col("t")).cast("string").alias("d")).collect()
    assert [r["d"] for r in parsed] == ["2026-03-31"] * 3 + [None] * 2


@settings(max_examples=200, deadline=None)
@given(st.text("abcd ", max_size=12), st.text("abcd ", max_size=12))
def test_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert E._lcs(a, b) == table[-1][-1]


def test_fuzzy_pairs_find_all(spark):
    names = ["alpha robotics", "alpha robotix", "alpha robots inc", "alphabet", "beta one", "beta  one llc", "Beta, One", "gamma"]
    got = {(r[0], r[1]) for r in E.fuzzy_pairs(spark.createDataFrame([(n,) for n in names], "n string"), "n").collect()}

    def norm(n):
        import re

        plain = re.sub(r"[^a-z0-9 ]", " ", re.sub(r"\(.*?\)", " ", n.lower()))
        return " ".join(sorted(re.sub(r"\s+", " ", re.sub(N.SUFFIXES, " ", plain)).strip().split(" ")))

    want = {(a, b) for a in names for b in names if a < b and norm(a)[:0] == norm(b)[:0] and _block(a) == _block(b) and 200 * E._lcs(norm(a), norm(b)) / (len(norm(a)) + len(norm(b))) >= 88}
    assert got == want and got


def _block(n):
    import re

    plain = re.sub(r"[^a-z0-9 ]", " ", n.lower())
    return re.sub(r"\s+", " ", re.sub(N.SUFFIXES, " ", plain)).strip()[:4]


def test_top_candidates_blocked_like_full(spark):
    ours = spark.createDataFrame([("Alpha Robotics",), ("Beta One",), ("Zeta",)], "name string")
    theirs = spark.createDataFrame([("alpha robotix",), ("beta one inc",), ("beta two",), (None,)], "name string")
    full, blocked = E.top_candidates(ours, theirs), E.top_candidates(ours, theirs, limit=0)
    assert sorted(full.collect()) == sorted(blocked.collect()) and full.count() == 2


def test_aliases_with_company_words(spark):
    rows = spark.createDataFrame([("Acme, Inc.", "F1"), ("Acme, Inc.", "F2"), ("Solo", "F1")], "name string, fund string")
    by_fund = spark.createDataFrame([("F1", "acme inc", "Acme One")], "fund string, alias string, canonical string")
    everywhere = spark.createDataFrame([("acme inc", "Acme"), ("solo", "")], "alias string, canonical string")
    got = [r["canonical"] for r in E.resolve_aliases(rows, "name", "fund", by_fund, everywhere).orderBy("fund", "name").collect()]
    assert got == ["Acme One", "Solo", "Acme"]
    legacy = [r["canonical"] for r in E.resolve_aliases(rows, "name", "fund", by_fund, everywhere, legacy=True).orderBy("fund", "name").collect()]
    assert legacy == ["Acme, Inc.", "Solo", "Acme, Inc."]


@pytest.mark.parametrize("value", ["a", "abc", "a b"])
def test_block_ratio_is_one_for_equal(spark, value):
    assert spark.createDataFrame([(value,)], "a string").select(E.block_ratio("a", "a")).first()[0] == 1.0


def test_no_break_spaces(spark):
    names = [" Cash", " ", "Total assets", "Non-Investment Assets", "Alpha Inc"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select(N.source_asset_class(F.col("n")).alias("c"), N.match_name(F.col("n")).alias("m")).collect()
    assert [r["c"] for r in rows] == ["accounting_entry", "accounting_entry", "subtotal", "balance_sheet", "holding"]
    assert rows[4]["m"] == "alpha"


def test_running_total(spark):
    import random

    from ledgerlens.operators.ordinals import running_total
    from ledgerlens.operators.scorecard import average_ranks, required

    draw = random.Random(3)
    values = [draw.choice([0.0, 1.5, -2.0, draw.random()]) for _ in range(400)]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = {r["v"]: r["r_v"] for r in average_ranks(rows, ["v"]).collect()}
    assert got.pop(None) is None
    assert got == {v: sum(x < v for x in values) + (values.count(v) + 1) / 2 for v in set(values)}
    assert running_total(rows.where("false"), "v", F.lit(1), "t").count() == 0
    with pytest.raises(ValueError, match="missing columns: w"):
        required(rows, ["v", "w"])
