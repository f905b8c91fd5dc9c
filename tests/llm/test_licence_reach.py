"""Segments that no template can be near are left out before their words are joined, and no other ones."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import licences as L

NOTICE = "Licensed under the Apache License, Version 2.0."
LINES = [NOTICE, "All rights reserved.", "SPDX-License-Identifier: MIT", "This work is licensed under the GNU General Public License, version 3."]
PLAIN = [(10_000 + i, f"p/{i}.txt", f"the work is of version {i} in all the rooms of one house") for i in range(300)]


def files(spark, rows):
    return spark.createDataFrame(rows + PLAIN, "doc_id long, path string, text string").repartition(4)


def test_a_common_notice_with_different_lines_around_it(spark, monkeypatch):
    own = [f"{NOTICE}\n{' '.join(f'q{i}x{k}' for k in range(30))}" for i in range(200)]
    docs = files(spark, [(i, f"d{i}/a.txt", t) for i, t in enumerate(own)])
    words, joined = [], type(docs).join

    def counted(left, right, *more):
        out = joined(left, right, *more)
        if "tw" in right.columns:
            words.append(out.count())
        return out

    monkeypatch.setattr(type(docs), "join", counted)
    got = {r["file_id"]: r["declared"] for r in L.scan(docs).where("declared is not null").select("file_id", "declared").collect()}
    assert got == dict.fromkeys(range(200), "Apache-2.0")
    assert len(words) == 1 and 0 < words[0] < 100  # some 7,500 with the lines around it


@pytest.mark.parametrize("common", [0, 7, 1024])
def test_nothing_near_is_left_out(spark, monkeypatch, common):
    dice, pool = random.Random(7), [f"e{k}" for k in (1, 2, 3, 5, 8, 13, 21)] + ["house", "the", "version", "license"]
    made = [f"{line} {' '.join(dice.choices(pool, k=dice.randrange(9)))}" for line in LINES for _ in range(150)]
    made += [" ".join(line.split()[:n]) + " other other" * k for line in LINES for n in range(1, 9) for k in range(3)]
    made += [" ".join(e for k, e in enumerate(pool[:7]) if i % (k + 1) == 0) for i in range(200)]
    docs = files(spark, [(i, f"d{i}/LICENSE" if i % 2 else f"d{i}/a.txt", t if i % 3 else f"{t}\nrooms of one house\n{t}") for i, t in enumerate(made)])
    p = L.Params(common=common)
    got = {r["file_id"]: (r["declared"], r["score"]) for r in L.scan(docs, p).collect()}
    monkeypatch.setattr(L, "in_reach", lambda *_: F.lit(True))
    want = {r["file_id"]: (r["declared"], r["score"]) for r in L.scan(docs, p).collect()}
    assert got == want
    scores = [s for _, s in want.values() if s is not None]
    assert len(scores) > 100 and min(scores) < 0.71 and len(scores) < len(want)
