import zlib
from fractions import Fraction

import numpy as np
import pytest

from ledgerlens.llm import ranks
from ledgerlens.llm import sharding as S


def test_balance_and_slots(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "hot text of a third" if i % 3 == 0 else " ".join(["w"] * int(rng.integers(1, 60))) + str(i)) for i in range(3000)]
    got = S.shard(spark.createDataFrame(rows, "doc_id long, text string"), S.Params(grain=1 / 512, most=1 / 64)).toPandas()
    assert len(got) == 3000
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() / sizes.min() < 1.02
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    texts = dict(rows)
    assert all(len(texts[i].encode()) + 1 == n and zlib.crc32(texts[i].encode()) == c for i, n, c in zip(got["doc_id"], got["size"], got["text_crc32"], strict=True))


def test_small_groups_stay_together(spark):
    rows = [(i, f"text {i // 4} of four") for i in range(2000)]
    got = S.shard(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert (got.assign(g=got["doc_id"] // 4).groupby("g")["shard"].nunique() == 1).all()


def plain(units, shards):
    """The rule one unit at a time in exact numbers: largest share first, then largest sum, then the first; ties to the lowest shard."""
    left = [[Fraction(1)] * len(units[0]) for _ in range(shards)]
    out = [None] * len(units)
    for i in sorted(range(len(units)), key=lambda i: (-max(units[i]), -sum(units[i]), i)):
        need = [shards * u for u in units[i]]
        fit = [sum(a * b for a, b in zip(need, r, strict=True)) for r in left]
        out[i] = fit.index(max(fit))
        left[out[i]] = [a - b for a, b in zip(left[out[i]], need, strict=True)]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_place_is_the_dot_product(seed):
    rng = np.random.default_rng(seed)
    # Totals are powers of two, so that shares are exact in both.
    counts = np.array([rng.multinomial(1 << 16, rng.dirichlet(np.full(60, 0.4))) for _ in range(3)]).T
    shares = [[Fraction(int(c), 1 << 16) for c in row] for row in counts]
    out, residual = S.by_dot_product(counts / (1 << 16), 4)
    assert out.tolist() == plain(shares, 4)
    placed = S.place(counts / (1 << 16), 4)
    loads = np.array([counts[placed == s].sum(axis=0) for s in range(4)]) * 4 / (1 << 16)
    assert ((1 - loads) ** 2).sum() <= (residual**2).sum() + 1e-12


def test_odd(odd, none_at_all):
    got = S.shard(odd).collect()
    assert len(got) == odd.count() and S.shard(none_at_all).count() == 0
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert {r["size"] for r in got if r["doc_id"] == 0} == {1} and {r["text_crc32"] for r in got if r["doc_id"] == 0} == {0}


def test_numbers_have_no_gaps(spark):
    rows = spark.range(5000).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else cast(id % 50 as string) end as k", "1 as n_")
    got = ranks.numbered(rows, ["k"], [rows["id"]], "slot", per_block=100).toPandas()
    assert len(got) == 5000
    for _, part in got.groupby("k", dropna=False):
        assert sorted(part["slot"]) == list(range(len(part)))
