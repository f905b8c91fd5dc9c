"""Toxicity and quality: parts by brute force, the whole by held-out accuracy."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import byte_cnn as B
from ledgerlens.llm import toxicity as T


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row


TERMS = [("idiot", False), ("scum", False), ("lowei", True), ("abcab", True)]


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text("idotscumlweab", min_size=1, max_size=9), st.sampled_from([t for t, _ in TERMS]).flatmap(lambda t: st.integers(0, len(t)).flatmap(lambda i: st.text("xyt", max_size=2).map(lambda s: t[:i] + s + t[i + 1 :])))).filter(bool))
def test_trie_is_edit_distance(word):
    got = T.Trie(TERMS, 5).match(word)
    best = []
    for term, stem in TERMS:
        row = edits(term, word)
        d = min(row) if stem else row[-1]
        if d == 0 or d == 1 and len(term) >= 5:
            best.append((d, term))
    want = min(best)[::-1] if best else None
    assert got == want


def test_context():
    m = T.Model([("idiot", False)], frozenset(), [-5.0, 10.0, 5.0]).matcher()
    plain, quoted, said, at_you = (m.sums(t)[0] for t in ("some idiot here", 'the word "idiot" here', "he said idiot then", "you idiot"))
    assert quoted < plain and said < plain < at_you
    assert m.sums(None) == m.sums("") == (0.0, 0.0)
    # A quotation of any length counts; a mark left open in one line doesn't reach into the next.
    assert m.sums(f'"{"so " * 400}idiot {"so " * 400}"')[0] == m.sums('"oh idiot"')[0] < plain
    assert m.sums('a lone " mark\nsome idiot here\nand " more')[0] == plain
    assert T.Model([], frozenset(), [-30.0, 0.0, 0.0]).score((0.0, 0.0)) == 0.0


def test_learned_terms():
    """Words of toxic texts only are learned, by the least set that covers them first; those of clean texts are not."""
    words = [f"plain{i}" for i in range(30)]
    rows = [({"shared", words[i % 30], "vile" if i % 2 else "nasty"}, "", 1) for i in range(60)] + [({"shared", words[i % 30], words[(i * 7) % 30]}, "", 0) for i in range(300)]
    terms = T.learn_terms(rows, T.Params())
    assert {"vile", "nasty"} <= {t[0] for t in terms if not t[1]} | {w for w in ("vile", "nasty") for t in terms if t[1] and w.startswith(t[0])}
    assert not any(w.startswith(t[0]) if t[1] else w == t[0] for w in ["shared", *words] for t in terms)


@pytest.fixture(scope="module")
def split(spark):
    import os

    path = "/root/testdata/sf0.1"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")


def auc(rows, label):
    y, s = np.array([r[label] for r in rows]), np.array([r["score"] for r in rows])
    order = np.argsort(np.argsort(s, kind="stable"), kind="stable")
    n = y.sum()
    return (order[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


def test_toxicity_held_out(split):
    docs, labels = split
    from ledgerlens.llm.labelled import held_out

    rows = T.toxicity(docs, labels).join(labels, "doc_id").where(held_out("doc_id")).select("score", "toxic").collect()
    assert auc(rows, "toxic") > 0.93 and all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([(r["score"] >= 0.5) == bool(r["toxic"]) for r in rows]) > 0.97


def test_quality_held_out(split):
    docs, labels = split
    from ledgerlens.llm.labelled import held_out

    rows = B.quality(docs, labels).join(labels, "doc_id").where(held_out("doc_id")).select("score", "quality").collect()
    assert auc(rows, "quality") > 0.93
    assert np.mean([(r["score"] >= 0.3) == bool(r["quality"]) for r in rows]) > 0.95


def test_network_by_brute_force():
    p = B.Params(filters=3, block=4, span=2, step=1, segment=2)
    rng = np.random.default_rng(0)
    net = B.Network(rng.normal(size=(256, 4)).astype(np.float32), rng.normal(size=(32, 3)).astype(np.float32), rng.normal(size=3).astype(np.float32), rng.normal(size=6).astype(np.float32), 0.1, p)
    for text in ["", "a", "hello world, this is a longer text that spans several segments é"]:
        raw = text.encode()
        n = max(1, -(-len(raw) // 8))
        padded = raw + bytes(n * 8 + 8 - len(raw))
        response = [np.maximum(np.concatenate([net.table[b] for b in padded[i * 2 : i * 2 + 8]]) @ net.kernel + net.bias, 0) for i in range(n * 4)]
        blocks = [np.max(response[i * 4 : i * 4 + 4], axis=0) for i in range(n)]
        chunks = [np.max(blocks[i : i + 2], axis=0) for i in range(max(1, n - 1))]
        z = np.concatenate((np.mean(chunks, axis=0), np.max(chunks, axis=0))) @ net.head + 0.1
        assert abs(net.probability(text) - 1 / (1 + np.exp(-z))) < 1e-5


def test_gradient_lowers_the_loss():
    good, bad = [(f"the plain words of text number {i} go on and on here", 1) for i in range(40)], [(f"$$$ %%% &&& ### {i} *** |||", 0) for i in range(40)]
    net = B.fit(good + bad, B.Params(steps=150, batch=16))
    assert min(net.probability(t) for t, _ in good) > 0.8 and max(net.probability(t) for t, _ in bad) < 0.2
    assert B.fit(good, B.Params(steps=1)).probability("x") > 0.99


def test_odd(spark, odd, none_at_all):
    labels = spark.createDataFrame([(3, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for f, p in ((T.toxicity, T.Params()), (B.quality, B.Params(steps=2))):
        out = f(odd, labels, p=p, out="s_")
        assert out.columns == [*odd.columns, "s_"] and out.count() == odd.count()
        assert out.where("s_ is null or s_ < 0 or s_ > 1").isEmpty()
        assert f(none_at_all, labels, p=p, out="s_").count() == 0
        assert f(odd, labels.limit(0), p=p, out="s_").count() == odd.count()
