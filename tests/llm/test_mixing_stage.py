"""The mixing stage of the pipeline drops no document that the filters kept."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as C


def test_every_document_stays(spark, sf_dir, monkeypatch):
    """Rates of single documents below 1 may be rounded to no copy at all; a null count is one copy."""
    docs = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "doc_id long, text string").withColumn("lang", F.lit("en"))
    counts = F.when(F.col("doc_id") != 3, F.col("doc_id"))
    monkeypatch.setattr(C, "mix", lambda d, *_, out, **__: d.withColumn(out, F.struct(counts.alias("copies"))))
    assert Counter(r["text"] for r in C.balance(spark, docs, sf_dir).collect()) == {"a": 1, "b": 1, "c": 2, "d": 1, "e": 1}
