import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import mixing as M
from ledgerlens.llm.queries import TARGETS, labelled_domains

WORDS = {"x": ["alpha", "beta", "gamma"], "y": ["uno", "dos", "tres"], "z": ["eins", "zwei", "drei"]}


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        d = "xxxxyyz"[i % 7]
        rows.append((i, " ".join(rng.choice(WORDS[d], rng.integers(3, 40))), d))
    return spark.createDataFrame(rows, "doc_id long, text string, domain string")


def test_targets_are_met(docs):
    targets = {"x": 0.2, "y": 0.5, "z": 0.3}
    rows = M.mix(docs, docs.select("doc_id", "domain"), targets).collect()
    tokens = np.array([r["mix"]["tokens"] for r in rows], dtype=float)
    q, w = np.array([r["mix"]["posterior"] for r in rows]), np.array([r["mix"]["rate"] for r in rows])
    total = (tokens * w) @ q
    assert np.allclose(total / total.sum(), [0.2, 0.5, 0.3], atol=2e-3) and (w >= 0).all()
    assert np.mean([r["mix"]["domains"][int(np.argmax(r["mix"]["posterior"]))] == r["domain"] for r in rows]) > 0.95
    assert all(abs(r["mix"]["copies"] - r["mix"]["rate"]) < 1 for r in rows)
    goal = np.array([0.2, 0.5, 0.3]) * tokens.sum()
    assert all(abs(r["mix"]["miss"] - (np.abs(total - goal) / goal).max()) < 1e-6 for r in rows) and rows[0]["mix"]["miss"] <= 1e-3


def _table(spark, q, tokens):
    rows = [(int(n), [float(x) for x in p]) for n, p in zip(tokens, q, strict=True)]
    return spark.createDataFrame(rows, "tokens long, posterior array<double>").repartition(4)


def _eight_overlapping(rng, n=400):
    """Posteriors that spread over eight domains: every document belongs to three or four of them at least."""
    q = rng.dirichlet(np.full(8, 0.6), n) * 0.7 + rng.dirichlet(np.full(8, 5.0), n) * 0.3
    return q, rng.integers(0, 300, n)


def test_rates_of_overlapping_domains(spark):
    """Where no rate is held at zero, the nearest rates to 1 that meet the targets, which linear algebra gives at once."""
    q, tokens = _eight_overlapping(np.random.default_rng(5))
    goal = (tokens @ q) * np.array([1.1, 0.95, 0.9, 1.05, 1.0, 0.97, 1.1, 0.93])
    fitted = M.fit_rates(_table(spark, q, tokens), list(goal), budget=goal.sum())
    a = q.T * tokens
    by_hand = 1 + q @ np.linalg.solve(a @ q, goal - a.sum(axis=1))
    w = M.rates(q, fitted.steps)[0]
    assert len(fitted.steps) == 1 and fitted.miss <= 1e-3 and np.allclose(w, by_hand, atol=1e-6) and by_hand.min() > 0


def _projected_gradient(q, tokens, goal, rounds=60_000):
    """Plain projected gradient over all rates in one process, least squares in the metric of the inverse Gram matrix."""
    a = q.T * tokens
    metric, w = np.linalg.inv(a @ q), np.ones(len(q))
    for _ in range(rounds):
        new = np.maximum(0.0, w - q @ (metric @ (a @ w - goal)))
        if np.abs(new - w).max() < 1e-12:
            break
        w = new
    return w, a @ w - goal, metric


@pytest.mark.parametrize(("shares", "within_reach"), [([0.3, 0.2, 0.2, 0.1, 0.05, 0.05, 0.05, 0.05], True), ([0.9, 0.1, 0, 0, 0, 0, 0, 0], False)])
def test_rates_held_at_zero(spark, shares, within_reach):
    """Steep targets: some rates end at zero. They are met, or, where no nonnegative rates meet them, as nearly as can be."""
    q, tokens = _eight_overlapping(np.random.default_rng(6))
    fitted = M.fit_rates(_table(spark, q, tokens), shares)
    goal = np.array(shares) * tokens.sum()
    w = M.rates(q, fitted.steps)[0]
    _, left, metric = _projected_gradient(q, tokens, goal)
    ours = (q.T * tokens) @ w - goal
    assert (w >= 0).all() and (w == 0).any()
    assert ours @ metric @ ours <= left @ metric @ left + 1e-3 * (goal @ metric @ goal)
    miss = (np.abs(ours) / np.where(goal > 0, goal, goal.sum())).max()
    assert abs(fitted.miss - miss) < 1e-6
    assert (miss <= M.Params().tolerance) == within_reach == bool(np.abs(left).max() < 1e-6 * goal.sum())
    assert len(fitted.steps) > M.Params().replay


def test_targets_of_the_query(spark):
    """The registered query meets its eight targets on the tables of the tests."""
    import os

    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("no test tables")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = M.mix(docs, labelled_domains(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet")), TARGETS).select("mix").collect()
    total = sum(r["mix"]["tokens"] * r["mix"]["rate"] * np.array(r["mix"]["posterior"]) for r in rows)
    want = np.array([TARGETS[d] for d in rows[0]["mix"]["domains"]])
    assert (np.abs(total / sum(r["mix"]["tokens"] for r in rows) - want) / want).max() <= 1e-3


def test_cover_never_shrinks_a_domain(docs):
    rows = M.mix(docs, docs.select("doc_id", "domain"), {"x": 0.2, "y": 0.5, "z": 0.3}, budget="cover").collect()
    assert np.quantile([r["mix"]["rate"] for r in rows], 0.05) > 0.9


def test_odd(odd, none_at_all, docs):
    labels = odd.select("doc_id", F.col("lang").alias("domain"))
    assert "mix" in odd.columns
    with pytest.raises(ValueError, match="exists already"):
        M.mix(odd, labels, {"en": 1.0, "de": 1.0})
    assert M.mix(odd, labels, {"en": 1.0, "de": 1.0}, out="m_").count() == odd.count()
    named = M.mix(odd, labels, {"en": 1.0}, out="m_")
    assert named.columns == [*odd.columns, "m_"] and named.where("m_.copies is null").isEmpty()
    assert M.mix(none_at_all, labels.limit(0), {"en": 1.0}, out="m_").count() == 0
    assert M.mix(odd, labels.limit(0), {"en": 1.0}, out="m_").where("m_.rate <> 1").isEmpty()
