"""SimHash near duplicates completed to an exact threshold: every pair of shingle sets at or above it counts, none is left to chance.

Ball hashing (``simhash.links``) reaches pairs whose fingerprints differ in a few bits; at a Jaccard similarity of 0.8 about ten of 64 bits
differ, and balls of radius five have millions of points. So the balls give the first links, each verified by the whole sets, and
prefix filtering (Chaudhuri et al. 2006, Xiao et al. 2008) gives the rest: in any fixed order of all shingles, two sets of similarity t or
more share one of the first n - ceil(t n) + 1 shingles of each. Sets that meet at such a shingle and aren't connected yet are
candidates, and each is decided by its whole sets. The order puts shingles that are frequent in a sample last; the sample decides the speed
only, never the result. Shingles are compared by 64-bit hashes.

Pairs of one group are not all listed: the sets at a shingle are first compared with the most central one there, which has the fewest rarer
shingles; then only pairs that are not connected yet are. Near copies of a text have their edits as rarer shingles, so the one with the
fewest is nearer to the others than these are to each other, and mostly connects those that can be. Candidates are first compared by the quarter of their shingles whose hashes end in two zero bits: similar
sets differ in few members altogether, so in few of these, and most candidates go without their whole sets being moved.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import bounded_batches, cut
from .components import connected_components
from .simhash import SEED

#: Lowest bits of a shingle's hash that are zero in the part of a set that is compared first.
FIRST = 3


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text, signed; words and shingles as in ``simhash.shingle_hashes``."""
    return np.unique(simhash.shingle_hashes(text, size).view("<i8"))


def _similar(common, a, b, percent: int):  # noqa: ANN001, ANN202
    """Whether sets of a and b members with so many in common have a Jaccard similarity of percent or more, in whole numbers."""
    return (100 + percent) * common >= percent * (a + b)


def _hashes(size: int) -> Column:
    @F.pandas_udf("array<long>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t, size) for t in texts])

    return of("t")


def _frequent(texts: DataFrame, size: int, share: int = 16, least: int = 3, most: int = 100_000) -> np.ndarray:
    """Shingles from the rarest to the most frequent, of those found in ``least`` texts of one in ``share``."""
    rows = texts.where(F.pmod("tkey", F.lit(share)) == 0).select(F.explode(_hashes(size)).alias("s")).groupBy("s").count().where(F.col("count") >= least)
    found = rows.orderBy(F.desc("count"), "s").limit(most).toPandas()
    return found["s"].to_numpy(dtype="<i8")[::-1].copy()


def _sets(texts: DataFrame, percent: int, size: int) -> DataFrame:
    """texts (doc_id, t, tkey) as (doc_id, tkey, key, n, fp, prefix): equal sets of n shingles have equal keys."""
    last = _frequent(texts, size)
    order = np.argsort(last)
    ordered = last[order]

    @F.pandas_udf("key long, n int, fp long, prefix array<long>")
    def of(texts: pd.Series) -> pd.DataFrame:
        keys, sizes, fps, out = [], [], [], []
        for t in texts:
            hashes = simhash.shingle_hashes(t, size)
            h = np.unique(hashes.view("<i8"))
            n, rank = len(h), np.full(len(h), -1)
            if len(ordered):
                at = np.minimum(np.searchsorted(ordered, h), len(ordered) - 1)
                rank = np.where(ordered[at] == h, order[at], -1)
            keys.append(xxhash.xxh64_intdigest(h.tobytes(), SEED))
            sizes.append(n)
            fps.append(simhash.majority(hashes))
            out.append(h[np.lexsort((h, rank))][: n + (-percent * n // 100) + 1] if n else h)
        signed = lambda x: np.array(x, dtype="<u8").view("<i8")
        return pd.DataFrame({"key": signed(keys), "n": np.array(sizes, dtype="int32"), "fp": signed(fps), "prefix": pd.Series(out, dtype=object)})

    return texts.withColumn("x", of("t")).select("doc_id", "tkey", "x.*")


def _balls(sets: DataFrame, radius: int) -> DataFrame:
    """(a, b): pairs of keys whose fingerprints are equal or meet in a ball; one for each link, not all pairs."""
    least = sets.groupBy("fp").agg(F.min("key").alias("least"))
    equal = sets.select("key", "fp").join(least, "fp").where("key <> least").select(F.col("key").alias("a"), F.col("least").alias("b"))
    one, two = least.select(F.col("fp").alias("x"), F.col("least").alias("a")), least.select(F.col("fp").alias("y"), F.col("least").alias("b"))
    far = simhash.links(least.select("fp"), "fp", radius).select(F.col("a").alias("x"), F.col("b").alias("y"))
    return equal.unionByName(far.join(one, "x").join(two, "y").select("a", "b"))


def _verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame, percent: int, size: int, broadcast: int = 200_000) -> DataFrame:
    """Those of the pairs (a, b) that are similar. Whole sets are made again, only of the texts that a pair needs; up to ``broadcast`` of them are looked up without a shuffle of all texts."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    needed = cut(sets.select("key", "tkey").join(needed, "key", "left_semi"))
    few = F.broadcast(needed) if needed.count() <= broadcast else needed
    whole = cut(texts.select("tkey", "t").join(few, "tkey").dropDuplicates(["key"]).select("key", _hashes(size).alias("h")))
    part = whole.select("key", F.size("h").alias("n"), F.filter("h", lambda x: x.bitwiseAND(F.lit(FIRST)) == 0).alias("g"))
    one, two = (part.select(F.col("key").alias(k), F.col("n").alias(f"n{k}"), F.col("g").alias(f"g{k}")) for k in "ab")
    # Of na + nb members in all, similar sets have at most this many on one side only; members in the part can't be more.
    apart = F.size("ga") + F.size("gb") - 2 * F.size(F.array_intersect("ga", "gb"))
    open_ = cut(pairs.join(one, "a").join(two, "b").where((100 + percent) * apart <= (100 - percent) * (F.col("na") + F.col("nb"))).select("a", "b"))
    one, two = (whole.select(F.col("key").alias(k), F.col("h").alias(f"h{k}")) for k in "ab")
    both = open_.join(one, "a").join(two, "b")
    return cut(both.where(_similar(F.size(F.array_intersect("ha", "hb")), F.size("ha"), F.size("hb"), percent)).select("a", "b"))


def _possible(na: str, ia: str, nb: str, ib: str, percent: int) -> Column:
    """Whether sets may be similar whose first common shingle is at these places: the rest of the shorter one must do."""
    a, b = F.col(na), F.col(nb)
    return _similar(F.least(a - F.col(ia), b - F.col(ib)), a, b, percent)


def _named(met: DataFrame, known: DataFrame) -> DataFrame:
    """met with the root that the known links give each key."""
    roots = connected_components(known, "a", "b")
    return met.join(roots, F.col("key") == F.col("node"), "left").select("s", "key", "n", "i", F.coalesce("root", "key").alias("root"))


def links(sets: DataFrame, texts: DataFrame, percent: int, size: int, radius: int = 2) -> DataFrame:
    """(a, b): links between the keys of sets (key, tkey, n, fp, prefix) that give the same components as all similar pairs."""
    near = _verified(cut(_balls(sets, radius)), sets, texts, percent, size)
    all_of = sets.select("key", "n", F.posexplode("prefix").alias("i", "s"))
    again = all_of.groupBy("s").count().where("count > 1").select("s")
    met = cut(all_of.join(again, "s").select("s", "key", "n", "i"))
    named = cut(_named(met, near))
    low = named.groupBy("s").agg(F.min(F.struct("i", "key", "n", "root")).alias("m")).select("s", F.col("m.key").alias("b"), F.col("m.n").alias("nb"), F.col("m.i").alias("ib"), F.col("m.root").alias("rb"))
    stars = named.join(low, "s").where("root <> rb").where(_possible("n", "i", "nb", "ib", percent))
    stars = cut(stars.select(F.greatest("key", "b").alias("a"), F.least("key", "b").alias("b")).distinct())
    known = near.unionByName(_verified(stars, sets, texts, percent, size))
    named = _named(met, known)
    mixed = named.groupBy("s").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("s")
    open_ = cut(named.join(mixed, "s"))
    x, y = (open_.select("s", *[F.col(c).alias(f"{c}_{k}") for c in ("key", "n", "i", "root")]) for k in "ab")
    cross = x.join(y, "s").where("key_a > key_b and root_a <> root_b").where(_possible("n_a", "i_a", "n_b", "i_b", percent))
    pairs = cross.select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct()
    return known.unionByName(_verified(cut(pairs.join(stars, ["a", "b"], "left_anti")), sets, texts, percent, size))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80, size: int = 5) -> DataFrame:
    """(doc_id, component_id) for every row of docs: component_id is the smallest doc_id reachable over similar texts.

    Null and empty texts are copies of each other. Null ids never name a component unless all its ids are null.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"), F.xxhash64(F.col(text)).alias("tkey"))
    rows = cut(_sets(texts, percent, size))
    sets = cut(rows.where("n > 0").dropDuplicates(["key"]).drop("doc_id"))
    roots = connected_components(links(sets, texts, percent, size), "a", "b")
    classes = rows.groupBy("key").agg(F.min("doc_id").alias("least"))
    rooted = cut(classes.join(roots, F.col("key") == F.col("node"), "left").select("key", "least", F.coalesce("root", "key").alias("root")))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.select("doc_id", "key").join(rooted.select("key", "root").join(named, "root").drop("root"), "key").select("doc_id", "component_id")
