import random
from collections import Counter, defaultdict

import pytest

from ledgerlens.llm import packing as P


def bins_of(made):
    out = defaultdict(list)
    runs = sorted(made.runs)
    before = P._offsets(runs, made.bins)
    for k, (length, start, stop, first, each) in enumerate(runs):
        for n in range(start, stop):
            out[first + (n - start) // each].append((int(before[k]) + (n - start) % each * length, length))
    return out


@pytest.mark.parametrize("seed", range(25))
def test_plan_packs_everything(seed):
    rng = random.Random(seed)
    p = P.Params(sizes=(8, 16, 32))
    counts = {rng.randint(1, 32): rng.randint(1, 300) for _ in range(rng.randint(1, 15))}
    made = P.plan(counts, p)
    packed = bins_of(made)
    assert Counter(x for b in packed.values() for _, x in b) == Counter(counts)
    used = {b: u for first, n, u in made.bins for b in range(first, first + n)}
    assert set(used) == set(packed)
    for b, items in packed.items():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at == used[b] <= 32
    one = Counter()
    for first, n, u in P.plan(counts, P.Params(sizes=(32,))).bins:
        one[u] += n
    joint = sum(n * p.cost(p.downsized(u)) for _, n, u in made.bins)
    assert joint <= sum(n * P.Params(sizes=(32,)).cost(32) for n in one.values())


@pytest.mark.parametrize("seed", range(10))
def test_same_fill_as_best_fit_one_by_one(seed):
    """With one size, packing counts gives as many bins of each filling as placing piece after piece."""
    rng = random.Random(seed)
    counts = {rng.randint(1, 20): rng.randint(1, 20) for _ in range(8)}
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [r for r in rooms if r >= length]
            room = min(fits) if fits else 20
            if fits:
                rooms.remove(room)
            rooms.append(room - length)
    made = P.plan(counts, P.Params(sizes=(20,)))
    got = Counter()
    for _, n, u in made.bins:
        got[20 - u] += n
    assert sum(got.values()) == len(rooms)


def test_table(odd, none_at_all):
    p = P.Params(sizes=(64, 1024, 4096))
    rows = P.pack(odd, p).collect()
    docs = odd.select("doc_id", "text").collect()
    want = sum(len((r["text"] or "").encode().split()) for r in docs)
    assert sum(r["piece_len"] for r in rows) == want
    assert sum(r["piece"] == 0 for r in rows) == len(docs)
    assert all((r["bin_id"] is None) == (r["piece_len"] == 0) for r in rows)
    filled = Counter()
    for r in rows:
        filled[r["bin_id"]] += r["piece_len"]
    assert all(filled[r["bin_id"]] == r["bin_used"] <= r["bin_size"] for r in rows if r["bin_id"] is not None)
    assert P.pack(none_at_all, p).count() == 0
    assert P.pack(odd, p, length="n_chars").where("bin_id is not null").count() == 0


def cheapest(piece, others, p):
    """Size of least cost for a token, each size filled piece by piece with the longest that still fits; the smaller of equals."""
    prices = []
    for size in [s for s in p.sizes if s >= piece]:
        room = size - piece
        for other in sorted(others, reverse=True):
            room -= other if other <= room else 0
        used = size - room
        prices.append((p.cost(min(s for s in p.sizes if s >= used)) / used, size))
    least = min(price for price, _ in prices)
    return next(size for price, size in prices if price <= least + 1e-12)


@pytest.mark.parametrize("seed", range(30))
def test_joint_sizes_as_one_by_one(seed):
    """With several sizes, the plan holds the bins of placing piece after piece and choosing the size of each new bin by all sizes."""
    rng = random.Random(seed)
    p = P.Params(sizes=(8, 16, 32), fixed=rng.choice([0.0, 2.0, 8.0]), square=rng.choice([0.0, 1 / 64, 1 / 16]))
    counts = {rng.randint(1, 32): rng.randint(1, 8) for _ in range(rng.randint(1, 12))}
    pieces = sorted(Counter(counts).elements(), reverse=True)
    bins = []  # [room, used]
    for i, piece in enumerate(pieces):
        fits = [b for b in bins if b[0] >= piece]
        if not fits:
            bins.append([cheapest(piece, pieces[i + 1 :], p), 0])
            fits = bins[-1:]
        best = min(fits)
        best[0] -= piece
        best[1] += piece
    got = Counter()
    for _, n, used in P.plan(counts, p).bins:
        got[used] += n
    assert sum(n * p.cost(p.downsized(u)) for u, n in got.items()) == pytest.approx(sum(p.cost(p.downsized(u)) for _, u in bins))
    assert got == Counter(u for _, u in bins)
