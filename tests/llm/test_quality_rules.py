import math
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.llm import quality_rules as Q
from ledgerlens.llm.common import words


def brute(text):
    w = (text or "").encode("utf-8").split()
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    covered = {p for i, g in enumerate(grams) if g in twice for p in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_counts(spark, odd, none_at_all):
    out = Q.quality_rules(odd, out="verdict_")
    assert out.columns == [*odd.columns, "verdict_"] and out.count() == odd.count()
    for r in out.collect():
        v = r["verdict_"]
        assert (v["n_words"], v["word_chars"], v["n_symbols"], v["n_dup_lines"], v["n_repeat_words"]) == brute(r["text"])
        assert v["base_failed"] == (v["n_words"] < 10 or 100 * v["n_repeat_words"] > 20 * v["n_words"])
        assert not (v["base_failed"] and v["kept"]) and v["kept"] is not None
    assert Q.quality_rules(none_at_all, out="verdict_").count() == 0


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40).map(" ".join), min_size=1, max_size=8))
def test_repeats(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", Q.covered_by_repeats(words(F.col("t")), 5).alias("n")).collect()
    assert all(r["n"] == brute(r["t"])[4] for r in rows)


def test_distance(spark):
    pairs = [([1.0, 0.0], [0.0, 1.0], 1.0), ([0.5, 0.5], [0.5, 0.5], 0.0), ([0.75, 0.25], [0.25, 0.75], None)]
    rows = spark.createDataFrame([(p, q) for p, q, _ in pairs], "p array<double>, q array<double>").select(Q.jensen_shannon(F.col("p"), F.col("q")).alias("d")).collect()
    m = -(0.75 * math.log2(0.5 / 0.75) + 0.25 * math.log2(0.5 / 0.25))
    assert [round(r["d"], 9) for r in rows] == [1.0, 0.0, round(math.sqrt(m), 9)]


def test_junk_goes_and_prose_stays(spark):
    prose = " ".join(f"The word{i} of house{i} and tree{i * 7} is in a road{i * 3}, by old town{i}." for i in range(40))
    shout = prose.upper().replace(" ", "!! ")
    rows = [(i, prose.replace("word", f"w{i}"), "en") for i in range(20)] + [(100, shout, "en"), (101, " $$$ ".join(prose.split()), "en"), (102, "same words again and " * 30, "en")]
    kept = {r["doc_id"] for r in Q.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).where("quality.kept").collect()}
    assert kept == set(range(20))
