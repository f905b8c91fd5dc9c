"""Equal segments of many files are scored once."""

from ledgerlens.llm import licences as L

NOTICE, LINE = "Licensed under the Apache License, Version 2.0.", "the license of the house is kept under the roof"


def test_equal_segments_are_scored_once(spark, monkeypatch):
    files = [(i, f"d{i}/a.txt", f"{LINE}\n{NOTICE if i % 3 == 0 else 'word'}") for i in range(300)]
    plain = [(1000 + i, f"p/{i}.txt", f"the work is of version {i} in all the rooms of one house") for i in range(300)]
    docs = spark.createDataFrame(files + plain, "doc_id long, path string, text string").repartition(4)
    words, joined = [], type(docs).join

    def counted(left, right, *more):
        out = joined(left, right, *more)
        if "tw" in right.columns:
            words.append(out.count())
        return out

    monkeypatch.setattr(type(docs), "join", counted)
    got = {r["file_id"]: r["declared"] for r in L.scan(docs).select("file_id", "declared").collect()}
    assert got == {i: "Apache-2.0" if i < 1000 and i % 3 == 0 else None for i, _, _ in files + plain}
    assert len(words) == 1 and 0 < words[0] < 100
