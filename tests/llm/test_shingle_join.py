"""The pipeline's near-duplicate stage against brute-force Jaccard similarity of five-word shingles."""

import random
from itertools import combinations

import corpus_pipeline as C
from ledgerlens.llm import shingle_join as J
from ledgerlens.llm import simhash as S


def _texts():
    """Texts with edits of growing size, a chain, a group of near copies, common lines, copies, and short or empty ones."""
    rnd = random.Random(7)
    word = lambda: f"w{rnd.randrange(3000)}"
    base = [[word() for _ in range(rnd.randrange(30, 120))] for _ in range(40)]
    line, out = [word() for _ in range(12)], []
    for b in base:
        out.append(b + line)
        for edits in (1, 1, 2, 3, 5):
            c = list(b)
            for _ in range(edits):
                c[rnd.randrange(len(c))] = word()
            out.append(c + line)
    one = [word() for _ in range(100)]
    for k in range(40):
        out.append([*one[:50], f"n{k}", *one[50:]])
    chain = [word() for _ in range(100)]
    for k in range(8):
        out.append(chain[:100] if not k else out[-1][4:] + [word() for _ in range(4)])
    texts = [" ".join(w) for w in out]
    return [*texts, texts[0], texts[0].upper(), None, "", " \n", "One two", "one  TWO", "one two three four five", "x"]


def _components(texts, similar):
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(texts)), 2):
        if similar(i, j):
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


def test_stage_against_jaccard(spark):
    texts = _texts()
    sets = [frozenset(" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := (t or "").lower().split()) else frozenset() for t in texts]
    want = _components(texts, lambda i, j: sets[i] == sets[j] or 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j])))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert dict(map(tuple, J.near_duplicates(docs).collect())) == dict(enumerate(want))
    kept = {r["doc_id"] for r in C.deduplicate(spark, docs, "").collect()}
    assert kept == {i for i, root in enumerate(want) if i == root}
    fps = [S.fingerprint(t) for t in texts]
    by_bits = _components(texts, lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    assert sum(i == r for i, r in enumerate(by_bits)) > len(kept)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert J.near_duplicates(docs).count() == 0 and C.deduplicate(spark, docs, "").count() == 0
