"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2h bits have a common point at distance at most h from both. So each distinct
fingerprint emits all its variants within h bits, the variants are shuffled, and who meets at a variant is at most 2h apart:
all of them are linked through the smallest one, which keeps every component whole without listing pairs. A bucket
holds distinct fingerprints only, at most as many as a ball has points, so copies never pile up in it.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, cut
from .components import connected_components

SEED = 42
BITS = 64


def shingle_hashes(text: str | None, shingle: int = 3) -> np.ndarray:
    """XXH64 (seed 42) of the shingles of a text, unsigned, repeats included; none for a null or a text without words.

    A-Z are lower-cased, words end at space and bytes 9 to 13, a text of fewer words is one shingle.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, dtype="<u8")
    joined, k = b" ".join(tokens), min(shingle, len(tokens))
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[i:j], SEED) for i, j in zip(starts[: len(tokens) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)], dtype="<u8")


def majority(hashes: np.ndarray, segment: int = 1 << 14) -> int:
    """SimHash: a bit is set if it is set in over half of the hashes; 0 of none. Counted in segments, so that memory stays small."""
    if not len(hashes):
        return 0
    ones = sum(np.unpackbits(hashes[i : i + segment].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64) for i in range(0, len(hashes), segment))
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the shingles of a text, unsigned; 0 for a null or a text without words."""
    return majority(shingle_hashes(text, shingle))


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = 3) -> DataFrame:
    """docs with the fingerprint of each whole text as a signed long."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype="<u8").view("<i8"))

    return docs.withColumn(out, of(F.col(text)))


def links(fingerprints: DataFrame, fp: str, radius: int = 2) -> DataFrame:
    """(a, b), a > b: links between distinct fingerprints that give the same components as all pairs within radius bits.

    radius is even, as half of it is the radius of the balls.
    """
    if radius < 0 or radius % 2:
        raise ValueError("radius must be even")
    flips = [sum(1 << i for i in bits) for n in range(radius // 2 + 1) for bits in combinations(range(BITS), n)]
    masks = F.array(*[F.lit(m - (1 << BITS) if m >> (BITS - 1) else m) for m in flips])
    balls = fingerprints.select(F.col(fp).alias("a"), F.explode(masks).alias("mask")).select("a", F.col("a").bitwiseXOR(F.col("mask")).alias("variant"))
    met = balls.selectExpr("a", "min(a) over (partition by variant) AS b").where("a <> b")
    return met.distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 2, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs: component_id is the smallest doc_id reachable over links.

    Null and empty texts share fingerprint 0 and are linked like any other. Null ids never name a component unless
    all its ids are null. Repeated rows are all returned. Other columns are not read.
    """
    rows = cut(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")), "t", "fp", shingle).select("doc_id", "fp"))
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(links(classes.select("fp"), "fp", radius), "a", "b")
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(rooted.select("fp", "root").join(named, "root").drop("root"), "fp").select("doc_id", "fp", "component_id")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 2, shingle: int = 3) -> DataFrame:
    """docs with one row of each group of near duplicates: that with the smallest id.

    Of rows that repeat this id one stays, any of them. Rows with a null id can't be named and all stay.
    """
    return keep_named(docs, near_duplicates(docs, doc_id, text, radius, shingle), doc_id)


def keep_named(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """docs with one row of each component of found (doc_id, component_id), as ``keep_one`` says."""
    best = cut(found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")))
    keep = docs.where(F.col(doc_id).isNull()).unionByName(docs.join(best.where("n = 1").select(F.col("doc_id").alias("_keep")), F.col(doc_id) == F.col("_keep"), "left_semi"))
    if best.where("n > 1").isEmpty():
        return keep
    again = docs.join(best.where("n > 1").select(F.col("doc_id").alias("_keep")), F.col(doc_id) == F.col("_keep"), "left_semi")
    return keep.unionByName(again.dropDuplicates([doc_id]))
