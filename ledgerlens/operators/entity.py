"""Entity resolution: collisions of normalised names, fuzzy pairs in blocks, candidates, aliases and mappings."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.names import match_name, norm_name, sorted_tokens
from ..schema import DEFAULTS, Params


def normalised_collisions(names: DataFrame, name: str) -> DataFrame:
    groups = names.select(F.col(name).alias("n"), norm_name(F.col(name)).alias("norm")).where("norm <> ''").groupBy("norm").agg(F.countDistinct("n").alias("n_names"), F.array_join(F.sort_array(F.collect_set("n")), "|").alias("names"))
    return groups.where("n_names > 1")


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    s, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        u = s & at.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


@F.pandas_udf(DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """100 times the share of characters in the longest common subsequence; 100 for two empty texts."""
    return pd.Series([200.0 * _lcs(x, y) / (len(x) + len(y)) if x or y else 100.0 for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def block_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks, which depends on the order of the arguments, to 4 digits."""
    return pd.Series([round(difflib.SequenceMatcher(None, x, y).ratio(), 4) for x, y in zip(a, b, strict=True)], dtype="float64")


def fuzzy_pairs(names: DataFrame, name: str, p: Params = DEFAULTS) -> DataFrame:
    """(name_a, name_b, similarity) of distinct names of one block with similarity at or above the threshold, a < b.

    A block is the first letters of the normalised name. Before the costly comparison, pairs whose lengths alone rule out the
    threshold are dropped: the ratio is at most twice the shorter length over the sum. Spark splits a large block (adaptive skew join).
    """
    distinct = names.select(F.col(name).alias("n")).where("n is not null").distinct().withColumn("norm", norm_name(F.col("n"))).where("norm <> ''")
    keyed = distinct.withColumn("block", F.substring("norm", 1, p.block)).withColumn("t", sorted_tokens(F.col("norm"))).select("block", "n", "t")
    a, b = keyed.select("block", F.col("n").alias("name_a"), F.col("t").alias("ta")), keyed.select("block", F.col("n").alias("name_b"), F.col("t").alias("tb"))
    la, lb = F.length("ta"), F.length("tb")
    met = a.join(b, "block").where((F.col("name_a") < F.col("name_b")) & (200.0 * F.least(la, lb) >= p.similarity * (la + lb)))
    return met.withColumn("similarity", F.round(indel_ratio("ta", "tb"), 4)).where(F.col("similarity") >= p.similarity).select("name_a", "name_b", "similarity")


def top_candidates(ours: DataFrame, theirs: DataFrame, least: float = 0.84, top: int = 3, limit: int = 2_000) -> DataFrame:
    """(name, candidate, score, rank): the top candidates of each of our names among theirs.

    Up to ``limit`` candidates (they are counted first) are broadcast and compared in full. A longer list meets by common pairs of
    letters, which loses nothing: at a ratio of 0.84 the longest matching block of two names has two letters at least.
    """
    a = ours.select(F.col("name")).where("name is not null").distinct().withColumn("m", match_name(F.col("name")))
    b = theirs.select(F.col("name").alias("candidate")).where("candidate is not null").distinct().withColumn("mc", match_name(F.col("candidate")))
    # The ratio is at most twice the shorter length over the sum.
    fits = 2.0 * F.least(F.length("m"), F.length("mc")) >= least * (F.length("m") + F.length("mc"))
    if b.limit(limit + 1).count() <= limit:
        met = a.join(F.broadcast(b), fits)
    else:
        letters = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substring(F.col(c), i, F.lit(2))))
        met = a.withColumn("k", F.explode(letters("m"))).join(b.withColumn("k", F.explode(letters("mc"))), "k").where(fits).drop("k").distinct()
    scored = met.withColumn("score", block_ratio("m", "mc")).where(F.col("score") >= least)
    order = Window.partitionBy("name").orderBy(F.desc("score"), "candidate")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("name", "candidate", "score", "rank")


def resolve_aliases(rows: DataFrame, name: str, fund: str, by_fund: DataFrame, everywhere: DataFrame, legacy: bool = False) -> DataFrame:
    """rows with ``canonical``: the alias for the fund, else the general one, else the name.

    by_fund is (fund, alias, canonical), everywhere is (alias, canonical). Alias keys are normalised as the names are; with legacy they
    are taken as written, so that keys with a company word never match. An empty canonical name counts as none.
    """
    key = (lambda c: F.col(c)) if legacy else (lambda c: match_name(F.col(c)))
    one = by_fund.select(F.col("fund").alias("af"), key("alias").alias("ak"), F.nullif("canonical", F.lit("")).alias("c1")).groupBy("af", "ak").agg(F.max("c1").alias("c1"))
    two = everywhere.select(key("alias").alias("gk"), F.nullif("canonical", F.lit("")).alias("c2")).groupBy("gk").agg(F.max("c2").alias("c2"))
    m = match_name(F.col(name))
    out = rows.join(one, (F.col(fund) == F.col("af")) & (m == F.col("ak")), "left").join(two, m == F.col("gk"), "left")
    return out.withColumn("canonical", F.coalesce("c1", "c2", F.col(name))).drop("af", "ak", "gk", "c1", "c2")


def entity_mappings(ours: DataFrame, realized: DataFrame, theirs: DataFrame) -> DataFrame:
    """(name, realized_name, vendor_name, mapping_status) from names in list order (columns name, position).

    A vendor name goes to the first of our names with the same normalised form; of several vendor names of one form the last counts. A
    realized name of the form is attached, the last if there are several. Realized names that no vendor name was given for come after, first claim first.
    """
    form = match_name(F.col("name"))
    vendor = theirs.groupBy(form.alias("form")).agg(F.max_by("name", "position").alias("vendor_name"))
    first = Window.partitionBy("vendor_name").orderBy("position")
    mine = ours.withColumn("form", form).join(vendor, "form").withColumn("r", F.row_number().over(first)).where("r = 1")
    sold = realized.groupBy(form.alias("form")).agg(F.max_by("name", "position").alias("realized_name"))
    matched = mine.join(sold, "form", "left").select("name", "realized_name", "vendor_name", F.lit("confirmed").alias("mapping_status"))
    only = realized.withColumn("form", form).join(vendor, "form").join(mine.select("vendor_name"), "vendor_name", "left_anti").withColumn("r", F.row_number().over(first)).where("r = 1")
    return matched.unionByName(only.select(F.lit(None).cast("string").alias("name"), F.col("name").alias("realized_name"), "vendor_name", F.lit("confirmed_realized_only").alias("mapping_status")))
