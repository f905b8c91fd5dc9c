"""Each stage of the pipeline against a plain version over its own input."""

from collections import Counter

import pytest

import corpus_pipeline as C

@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    import os

    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    here = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [("documents", docs)]
    for k, (name, stage) in enumerate(C.STAGES):
        stage(spark, out[-1][1], sf).write.parquet(str(here / str(k)))
        out.append((name, spark.read.parquet(str(here / str(k)))))
    return out


def test_columns(stages):
    assert [n for n, _ in stages[1:]] == ["quality rules", "toxicity", "near duplicates", "mixing", "packing"]
    assert all(df.columns == stages[0][1].columns for _, df in stages[1:5])


def test_deduplication(stages):
    """Groups by brute force: all pairs of sets of five-word shingles with a Jaccard similarity of 0.8 or more."""
    before, after = stages[2][1].collect(), {r["doc_id"] for r in stages[3][1].collect()}
    words = {r["doc_id"]: (r["text"] or "").lower().split() for r in before}
    sets = {i: frozenset(" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset() for i, w in words.items()}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] == sets[b] or 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert after == {i for i in ids if find(i) == i} and len(after) < len(ids)


def test_filters_keep_rows_as_they_are(stages):
    for k in (1, 2, 3):
        before = Counter(map(tuple, stages[k - 1][1].collect()))
        assert not Counter(map(tuple, stages[k][1].collect())) - before


def test_mixing_keeps_every_document(stages):
    before, after = {r["doc_id"] for r in stages[3][1].collect()}, Counter(r["doc_id"] for r in stages[4][1].collect())
    assert set(after) == before
    tokens = Counter()
    for r in stages[4][1].collect():
        tokens[r["lang"]] += len(r["text"].split())
    total = sum(tokens.values())
    assert all(abs(tokens[k] / total - v) < 0.06 for k, v in C.TARGETS.items())


def test_packing_holds_every_token(stages):
    want = sum(len(r["text"].encode().split()) for r in stages[4][1].collect())
    rows = stages[5][1].collect()
    assert sum(r["piece_len"] for r in rows) == want
    assert len({(r["doc_id"], r["copy"], r["piece"]) for r in rows}) == len(rows)
    used = Counter()
    for r in rows:
        used[r["bin_id"]] += r["piece_len"]
    assert all(used[r["bin_id"]] == r["bin_used"] <= r["bin_size"] for r in rows if r["bin_id"] is not None)


def test_run(spark, sf_dir):
    assert C.run(spark, sf_dir).columns == ["doc_id", "piece", "start", "piece_len", "bin_id", "bin_size", "bin_used", "bin_offset", "copy"]


def test_odd(spark, odd, sf_dir):
    docs = odd
    for _, stage in C.STAGES:
        docs = stage(spark, docs, sf_dir)
        docs.count()
