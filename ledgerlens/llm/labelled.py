"""A bounded, repeatable sample of labelled texts, for fitting on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str) -> Column:
    """True for the rows that are never learned from: crc32 of the id as text leaves no rest by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int, doc_id: str = "doc_id", text: str = "text") -> list[tuple[str, int]]:
    """Up to ``most`` whole texts of each label 0 and 1, equal texts once, in the order of a hash of the id.

    Only the ids of the sample (at most 2 * most) are sent to the executors. Held-out rows, null ids, null texts and labels other
    than 0 and 1 are left out.
    """
    ids = None
    for value in (0, 1):
        some = labels.where(F.col(label) == value).where(~held_out("doc_id")).select("doc_id", F.lit(value).alias("label_")).where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        ids = some if ids is None else ids.unionByName(some)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text_")).where("text_ is not null").join(F.broadcast(ids), "doc_id").select("text_", "label_", F.xxhash64("doc_id").alias("h")).collect()
    out: dict[str, int] = {}
    for r in sorted(rows, key=lambda r: (r["h"], r["label_"])):
        out.setdefault(r["text_"], r["label_"])
    return list(out.items())
