import random
import re

import pytest
import xxhash

from ledgerlens.llm import components as K
from ledgerlens.llm import simhash as S


def roots(nodes, near):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in near:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("radius", [0, 2])
def test_links_give_the_components_of_all_pairs(spark, radius):
    rng = random.Random(radius)
    seeds = [rng.getrandbits(64) for _ in range(8)]
    points = {s ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (2**64 - 1) for s in seeds for _ in range(15)} | set(seeds) | {0, 1, 2**63}
    signed = [p - 2**64 if p >> 63 else p for p in points]
    want = roots(signed, [(a, b) for a in signed for b in signed if a < b and (a ^ b).bit_count() <= radius or a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= radius])
    links = S.links(spark.createDataFrame([(p,) for p in signed], "fp long"), "fp", radius)
    got = {r["node"]: r["root"] for r in K.connected_components(links, "a", "b").collect()}
    assert {p: got.get(p, p) for p in signed} == want


def test_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(100, 100), (None, 5), (7, None), (0, 1)]
    got = {r["node"]: r["root"] for r in K.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 160)}}
    assert K.connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_odd_radius(spark):
    with pytest.raises(ValueError, match="even"):
        S.links(spark.createDataFrame([(1,)], "fp long"), "fp", 3)


def test_table(odd, none_at_all):
    rows = S.near_duplicates(odd).collect()
    texts = {}
    for r in odd.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    fps = {i: [S.fingerprint(t) for t in ts] for i, ts in texts.items()}
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in odd.collect())
    assert all(r["fp"] % 2**64 in fps[r["doc_id"]] for r in rows)
    by = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert by[0] == by[1] == by[2] == 0 and by[3] == by[4] == 3
    assert S.near_duplicates(none_at_all).count() == 0
    kept = S.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 4 not in ids and 1 not in ids and ids.count(3) == ids.count(0) == 1 and ids.count(None) == 2


def test_near_copies_meet(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(1, base), (2, base.upper()), (3, base + " extra"), (4, " ".join(f"other{i}" for i in range(400)))]
    got = {r["doc_id"]: r["component_id"] for r in S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_fingerprint_by_counting(spark):
    """Every bit counted by itself over the hashes of the shingles, repeats included."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "Cat", "SAT", "on", "é", "a\tmat", "x\ny"]) for _ in range(n)) for n in (1, 2, 3, 4, 7, 30, 400)]
    for text in [*texts, None, "", " \n", "One\x0btwo\x0cthree four", "Ünïcode stays one wörd"]:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in re.split(r"[\x20\x09-\x0d]+", lowered) if w]
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0
        assert S.fingerprint(text) == want
