from pyspark.sql import functions as F

from ledgerlens.operators import compare as C
from ledgerlens.operators import reconcile as K
from ledgerlens.operators import routing as D
from ledgerlens.operators import schedule as L

ROW = "doc_id string, page int, table_order int, row_index int, company string, date string, round string, shares string, cost string, fair_value string, gain string"
ROWS = [
    ("d", 3, 1, 0, "Company", "Date", "Round", "Shares", "Cost", "Fair value", "Gain"),
    ("d", 3, 1, 1, "Acme", "1/2/2020", "A", "10", "100", "150", "50"),
    ("d", 3, 1, 2, "", "1/3/2021", "B", "-", "200", "250", "50"),
    ("d", 3, 1, 3, "", "", "", "", "300", "400", "100"),
    ("d", 3, 1, 4, "", "2/2/2020", "A", "1", "5", "6", "1"),
    ("d", 3, 1, 5, "Beta", "2/2/2020", "A", "1", "1,000", "(50)", "(1,050)"),
    ("d", 4, 1, 0, "", "", "", "", "1,000", "(40)", "(1,040)"),
    ("d", 4, 1, 1, "", "", "", "", "$ 1,300", "$ 360", "$ (940)"),
    ("d", 4, 1, 2, "", "", "", "", "", "", ""),
]


def classified(spark):
    return L.classify_rows(spark.createDataFrame(ROWS, ROW))


def test_row_states(spark):
    rows = classified(spark).orderBy("page", "row_index").collect()
    assert [r["row_type"] for r in rows] == ["repeated_header", "investment_lot", "investment_lot", "company_subtotal", "blank_or_noise", "investment_lot", "page_continuation", "grand_total", "blank_or_noise"]
    assert [r["company_name"] for r in rows] == [None, "Acme", "Acme", "Acme", None, "Beta", "Beta", None, None]
    assert rows[2]["inherited"] and rows[4]["issue"] == "lot_without_active_company"


def test_summary_and_checks(spark):
    rows = classified(spark)
    summary = L.company_summary(rows)
    by = {r["company_name"]: r for r in summary.collect()}
    assert (by["Acme"]["lot_count"], by["Acme"]["cost_status"], by["Acme"]["gain_status"]) == (2, "PASS", "PASS")
    assert by["Beta"]["fair_value_status"] == "FAIL" and float(by["Beta"]["fair_value_difference"]) == -10
    statement = spark.createDataFrame([("d", 1300, 360, -940)], "doc_id string, cost int, fair_value int, gain int")
    checks = K.reconcile(rows, summary, statement, {"cost": 1300.0})
    status = {(r["check_id"], r["entity"]): r["status"] for r in checks.collect()}
    assert status["grand_cost", "total"] == status["statement_gain", "total"] == status["golden_cost", "total"] == status["grand_gain_identity", "total"] == "PASS"
    assert status["company_fair_value", "Beta"] == "FAIL"
    decisions = K.parser_decisions(rows, checks, summary)
    found = decisions.first().asDict()
    assert {k for k, v in found.items() if v == "PASS"} == {"header_coverage", "key_field_parse_rate", "row_structure", "subtotal_and_continuation"}
    kinds = {r["kind"] for r in K.validation_issues(decisions, checks, summary).collect()}
    assert kinds == {"parser_decision", "reconciliation", "subtotal_mismatch"}


def test_decisions(spark):
    """What a document lacks fails it: header rows, a grand total, a column, an expected continuation, a subtotal."""
    good = [r for r in ROWS if r[2:4] != (1, 4)]
    fixed = [(*r[:8], "1,000", "(40)", "(1,040)") if r[4] == "Beta" else r for r in good]

    def decided(rows, **more):
        c = L.classify_rows(spark.createDataFrame(rows, ROW))
        summary = L.company_summary(c)
        return K.parser_decisions(c, K.reconcile(c, summary), summary, **more).first().asDict()

    told = spark.createDataFrame([("d", "Beta", 3, 4)], "doc_id string, company_name string, starts_on_page int, subtotal_on_page int")
    tables = lambda *n: spark.createDataFrame([("d", k) for k in n], "doc_id string, n_columns int")
    passed = decided(fixed, continuations=told, tables=tables(7, 7), expected_columns=7)
    assert set(passed.values()) == {"d", "investments", "PASS"}
    fails = lambda rows, **more: {k for k, v in decided(rows, **more).items() if v == "FAIL"} - {"decision"}
    assert fails(fixed[1:]) == {"header_coverage"}
    assert fails([r for r in fixed if "$" not in r[8]]) == {"row_structure"}
    assert fails(fixed, tables=tables(7, 6), expected_columns=7) == fails(fixed, tables=tables(), expected_columns=7) == {"column_count"}
    wrong = spark.createDataFrame([("d", "Acme", 3, 4)], told.schema)
    assert fails(fixed, continuations=wrong) == {"subtotal_and_continuation"}
    assert "subtotal_and_continuation" in fails([r for r in fixed if r[3] != 3])


def test_realized_decisions(spark):
    cells = "company string, purchase_date string, exit_date string, transaction string, cost string, proceeds string, escrow string, gain string"
    rows = [("d", 1, "Company", "Date", "Exit Date", "Transaction", "Cost", "Cash Proceeds", "Receivable", "Gain/(Loss)"), ("d", 2, "Acme", "1/1/2020", "1/1/2021", "sale", "10", "15", "-", "5"), ("d", 3, "Total", "", "", "", "10", "15", "", "5"), ("e", 1, "Acme", "1/1/2020", "1/1/2021", "sale", "10", "x", "-", "5")]
    c = L.classify_realized(spark.createDataFrame(rows, f"doc_id string, row_index int, {cells}"))
    totals = c.where("row_type = 'total'").selectExpr("doc_id", *[f"cast({x} as int) as {x}" for x in ("cost", "proceeds", "gain")])
    checks = K.reconcile_realized(L.realized_rollup(c), totals)
    got = {r["doc_id"]: r.asDict() for r in K.realized_decisions(c, checks).collect()}
    assert set(got["d"].values()) == {"d", "realized", "PASS"}
    assert {k for k, v in got["e"].items() if v == "FAIL"} == {"header_coverage", "key_field_parse_rate", "row_structure", "decision"}


def test_empty_documents(spark):
    rows = L.classify_rows(spark.createDataFrame([], ROW))
    assert K.reconcile(rows, L.company_summary(rows)).count() == 0


def test_prefer(spark):
    cases = [(None, None, 0, "assumed_zero_missing_cost"), (None, 5, 5, "pdf_investments_cost_lot_sum"), (7, None, 7, "pdf_investments_cost_reported"), (7, 8, 7, "pdf_investments_cost_reported"), (7, 9, 9, "pdf_investments_cost_lot_sum_exceeds_printed_subtotal"), (9, 7, 9, "pdf_investments_cost_reported_lot_sum_incomplete")]
    rows = spark.createDataFrame(cases, "r int, c int, v int, s string").select("v", "s", C.prefer_reported_or_lot_sum(F.col("r"), F.col("c"), "cost").alias("x")).collect()
    assert all((int(r["x"]["value"]), r["x"]["source"]) == (r["v"], r["s"]) for r in rows)


def test_mapping_types_are_checked(spark):
    import pytest

    ok = spark.createDataFrame([("a", "exact")], "logical_field string, mapping_type string")
    assert C.field_dictionary(ok).count() == 1
    with pytest.raises(Exception, match="unknown mapping_type"):
        C.field_dictionary(ok.withColumn("mapping_type", F.lit("guess"))).collect()


def test_routes(spark):
    texts = {"letter": "Dear Limited Partners\nhello", "vc": "Schedule of Investments\nCompany name # shares cost/share fmv/share 1", "contents": "table of contents\nschedule of investments 3", "assets": "Statement of assets\n1", "afs": "Schedule of investments 1\nindustry country portfolio investments\nreport of independent accountants"}
    lines = spark.createDataFrame([(k, 1, i, t) for k, v in texts.items() for i, t in enumerate(v.split("\n"))], "doc_id string, page int, line_no int, text string")
    got = {r["doc_id"]: (r["extraction_mode"], r["template_family"]) for r in D.route(lines).collect()}
    assert got == {"letter": ("blocked_narrative", None), "vc": ("position_level", "vc_lot_schedule"), "contents": ("manual_review", None), "assets": ("fund_aggregate_only", None), "afs": ("position_level", "audited_portfolio_schedule")}


def _lines(spark, pages):
    rows = [("d", p, i, t) for p, ls in enumerate(pages, 1) for i, t in enumerate(ls)]
    return spark.createDataFrame(rows, "doc_id string, page int, line_no int, text string")


def test_inferred_positions(spark):
    pages = [["Alpha Robotics", "Series A Preferred 1,000", "Series B 2.50 2,000", "Total 9", "Beta", "Series Seed 1,500", "Gamma"], ["$ 4,000 5,000", "Delta 1,000 (2,000)", "Series X 7,000", None, "", "12", "Total 1", "Epsilon"]]
    got = lambda **k: {(r["name"], int(r["cost"]), int(r["fair_value"])) for r in D.line_positions(_lines(spark, pages), **k).collect()}
    companies = {("Alpha Robotics", 3000, 3000), ("Beta", 1500, 1500), ("Gamma", 4000, 5000)}
    assert got() == companies | {("Delta", 1000, 2000)}
    assert got(company_headers=True, has_shares=True) == companies - {("Gamma", 4000, 5000)} | {("Gamma", 5000, 5000)}
    assert D.line_positions(_lines(spark, [])).count() == 0


def test_audited_positions(spark):
    pages = [["Alpha** Software USA", "Series A 5 10 20", "Beta Software Capital preferred units", "1 2 3", "Alpha Software USA", "Common 5 7 8"], ["4 5 6", "Alpha Software Israel", "9 9 -"]]
    got = [(r["company_name"], int(r["cost"]), int(r["fair_value"])) for r in D.audited_positions(_lines(spark, pages)).collect()]
    assert sorted(got) == [("Alpha", 1, 2), ("Alpha", 9, 9)]


def test_headers(spark):
    at = lambda doc, page, top, text: [(doc, page, int(top) * 100 + i, w, 10.0 * i, float(top), 10.0 * i + 8, top + 9.0) for i, w in enumerate(text.split())]
    rows = at("a", 1, 50, "Company Cost Date") + at("a", 1, 90, "Company Name Round Cost Fair Value") + at("a", 1, 100, "nothing") + at("b", 1, 10, "plain") + at("b", 2, 10, "Issuer") + at("b", 2, 20, "FMV") + at("b", 2, 500, "Cost") + at("c", 7, 10, "plain")
    words = spark.createDataFrame([*rows, ("a", 1, 0, None, None, None, None, None)], "doc_id string, page int, word_no int, text string, x0 double, top double, x1 double, bottom double")
    got = {r["doc_id"]: r for r in D.infer_schema(words).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"]["columns"], got["a"]["missing"], got["a"]["source"]) == ("entity_name,round,cost,fair_value", "", "header_band")
    assert (got["b"]["page"], got["b"]["names"], got["b"]["missing"], got["b"]["source"]) == (2, "company_name,fair_value,cost", "cost", "upper_part")


def test_inferred_route(spark):
    lines = _lines(spark, [["Schedule of investments 1"]])
    words = lambda t: spark.createDataFrame([("d", 1, i, w, 10.0 * i, 5.0, 10.0 * i + 8, 9.0) for i, w in enumerate(t.split())], "doc_id string, page int, word_no int, text string, x0 double, top double, x1 double, bottom double")
    mode = lambda **k: tuple(D.route(lines, **k).select("extraction_mode", "template_family", "confidence").first())
    assert mode() == ("manual_review", None, 0.4)
    assert mode(words=words("Company Cost Value")) == ("position_level_inferred", "generic_holdings_schedule", 0.95)
    assert mode(words=words("Company Value Date"))[0] == "manual_review"
    assert C.onboarding(D.route(lines, words=words("Company Cost Value"))).count() == 2


def test_aggregates(spark):
    texts = {1: "Investments, at fair value (cost $ 1,000) $ 2,500\n7 notes", 2: "Investments, at estimated fair value $ 30\n(Cost equal to $10 at 2020)", 3: "Investment, at estimated fair value (cost: 5) 6", 4: "Investments, at fair value 5"}
    rows = spark.createDataFrame([(k, 2, i, t) for k, v in texts.items() for i, t in enumerate(v.split("\n"))], "doc_id int, page int, line_no int, text string")
    assert {r["doc_id"]: (int(r["cost"]), int(r["fair_value"]), int(r["unrealized"])) for r in D.fund_aggregate(rows).collect()} == {1: (1000, 2500, 1500), 2: (10, 30, 20), 3: (5, 6, 1)}
