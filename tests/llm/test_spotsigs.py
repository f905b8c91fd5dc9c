import hashlib
import re

from pyspark.sql import functions as F

from ledgerlens.llm import spotsigs as S

STOP = {w for ws in S.ANCHORS.values() for w in ws}


def brute(text):
    """Signatures as tuples: anchor and the next content words."""
    words = [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]
    out = set()
    for i, w in enumerate(words):
        chain = [x for x in words[i + 1 :] if x not in STOP][: S.CHAIN] if w in STOP else []
        if chain:
            out.add((w, *chain))
    return out or {("", *words)}


def test_signatures(spark):
    texts = ["The quick brown fox is in a den of the old wolf and runs", "no anchors here whatsoever", "", None, "the", "the end", "der alte Mann und das Meer, la mer!"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", S.signatures(F.col("t")).alias("s")).collect()
    assert [len(r["s"]) for r in rows] == [len(brute(r["t"])) for r in rows]
    sets = [set(r["s"]) for r in rows]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            x, y = brute(a), brute(b)
            assert abs(len(sets[i] & sets[j]) / len(sets[i] | sets[j]) - len(x & y) / len(x | y)) < 1e-12


def test_next_and_edit(odd, none_at_all):
    rows = S.fingerprints(odd).collect()
    docs = odd.select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    named = {r["doc_id"]: r["text"] or "" for r in docs if r["doc_id"] is not None}
    ids = sorted(named, reverse=True)
    following = {a: named[b] for a, b in zip(ids, ids[1:], strict=False)}
    for r in rows:
        if r["doc_id"] in following and r["doc_id"] not in (0, 3):  # these repeat: a copy may come next
            a, b = r["text"], following[r["doc_id"]]
            k = len(a) // 3
            assert r["next_text"] == b and r["edited"] == a[: len(a) - k] + b[:k]
    assert S.fingerprints(none_at_all).count() == 0


def test_many_ranges(spark):
    docs = spark.range(3000).selectExpr("id * id * 7 as doc_id", "concat('the text of ', id) as text")
    got = {r["doc_id"]: r["next_text"] for r in S.with_next_text(docs).collect()}
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = sorted(rows, reverse=True)
    assert got == {a: rows[b] for a, b in zip(ids, ids[1:] + ids[:1], strict=True)}


def test_pairs(spark):
    body = [f"the item{i} of shelf{i % 13} is near door{i % 7}" for i in range(40)]
    rows = [(1, " ".join(body)), (2, " ".join(body)), (3, " ".join(body[:-2] + ["the other of things"])), (4, " ".join(body[:20])), (5, "the cat of house"), (6, None), (7, "")]
    members, pairs = S.similar_pairs(spark.createDataFrame(rows, "doc_id long, text string"), 0.8)
    cls = {r["doc_id"]: r["class"] for r in members.collect()}
    assert cls[1] == cls[2] and cls[6] == cls[7]
    texts, want = dict(rows), set()
    for a in cls:
        for b in cls:
            x, y = brute(texts[a]), brute(texts[b])
            if cls[a] < cls[b] and len(x & y) / len(x | y) >= 0.8:
                want.add((cls[a], cls[b]))
    got = {(r["a"], r["b"]) for r in pairs.collect()}
    assert got == want and want


def test_fingerprint_ignores_order(spark):
    row = spark.sql("select array('1', '2', '3') a, array('3', '1', '2') b").select(S.fingerprint(F.col("a")).alias("a"), S.fingerprint(F.col("b")).alias("b")).first()
    assert row["a"] == row["b"] == hashlib.md5(b"1\n2\n3").hexdigest()
