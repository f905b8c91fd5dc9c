"""Missing values, empty tables and invariants of the panel operators."""

from pyspark.sql import functions as F

from ledgerlens.operators import rules as R
from ledgerlens.operators import sampling as G
from ledgerlens.operators import scorecard as S
from ledgerlens.operators import status as T
from ledgerlens.plans.holdings import holdings
from ledgerlens.plans.panel_queries import QUERIES
from ledgerlens.schema import STATUSES


def test_all_null_row_counts_as_violation(spark, sf_dir):
    h = holdings(spark, sf_dir)
    rows = h.limit(1).select(*[F.lit(None).cast(t).alias(c) if c != "deal_status" else F.col(c) for c, t in h.dtypes])
    for status, broken in (("Current", 1), ("Partially Exited", 1), ("Fully Exited", 1), ("Written Off", 1), ("Written Down", 1)):
        out = R.consistency_rules(rows.withColumn("deal_status", F.lit(status))).where(F.col("rule").startswith(status + " =>")).agg(F.sum("violations")).first()[0]
        assert out >= broken, status


def test_empty_panel(spark, sf_dir):
    empty = holdings(spark, sf_dir).limit(0)
    for name, query in QUERIES.items():
        if name not in ("drop_empty_and_unit_columns",):
            query(empty).collect()


def test_invariants(spark, sf_dir):
    real = S.scorable(holdings(spark, sf_dir))
    p = S.field_polarisation(real).collect()
    assert all(r["at_zero"] + r["low"] + r["high"] + r["at_one"] == r["n_funds"] for r in p)
    bounds = T.row_scores(real, ["k1"]).agg(F.min("row_score"), F.max("row_score")).first()
    assert 0 <= bounds[0] and bounds[1] <= 1
    statuses = {r["derived_status"] for r in T.derived_counts(real).collect()}
    assert statuses <= {*STATUSES, "Unclassifiable"}
    off = T.rules()["Written Off"]
    assert real.where(off & ~T.rules()["Fully Exited"]).isEmpty()


def test_greedy_sample(spark, sf_dir):
    p = G.SampleParams(least=1, most=10**6, n_high=2, n_low=2, n_random=1)
    stats = G.eligible(G.fund_stats(holdings(spark, sf_dir), F.lit("1998-12-31").cast("date"), p), p)
    sample = G.diverse_sample(stats, p)
    checks = G.sample_checks(sample, sample.count()).first()
    assert all(checks)
    assert {r["sample_group"] for r in sample.collect()} <= {"high", "low", "random"}
