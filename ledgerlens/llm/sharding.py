"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

A group is all rows of one text. Each group goes to the shard where the dot product of its vector (shares of bytes, tokens
and rows) with the shard's residual capacity is highest, the largest groups first; swaps then even out what is left. Two bounds make this run at any scale:
groups below ``grain`` of every total are bundled by a hash of the text, about 1 / grain bundles; a group above ``most`` of any total is
split by a hash of the id into parts of about that size, as no shard could stay balanced with a third of the rows. So the driver places
at most some tens of thousands of units, and sends back as many numbers.

Defined results: a null text has no bytes or tokens and is grouped with the empty texts; repeated rows each get a slot; an empty table gives
an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, words
from .ranks import numbered


@dataclass(frozen=True)
class Params:
    shards: int = 8
    grain: float = 1 / 8192  # of a total: smaller groups are bundled, into 1 / grain bundles
    most: float = 1 / 32  # of a total, a quarter of one of eight shards: larger groups are split into parts


def by_dot_product(units: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard of each unit, what is left of each shard); units are rows of shares of bytes, tokens, rows, each column summing to 1.

    The largest unit goes first. The residual of a shard in a dimension is what is left of an equal part, in equal parts. Ties go to the lowest shard.
    """
    residual = np.ones((shards, units.shape[1]))
    out = np.zeros(len(units), dtype=np.int64)
    scaled = units * shards
    for i in np.lexsort((np.arange(len(units)), -units.sum(axis=1), -units.max(axis=1))):
        out[i] = s = int(np.argmax(residual @ scaled[i]))
        residual[s] -= scaled[i]
    return out, residual


def place(units: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unit by the dot product, finished by swaps."""
    out, residual = by_dot_product(units, shards)
    return _exchanged(units * shards, out, residual)


def _exchanged(units: np.ndarray, out: np.ndarray, residual: np.ndarray, rounds: int = 400, tries: int = 200) -> np.ndarray:
    """Finish the placement: swap units between the shards furthest apart, while that brings all residuals closer to zero.

    The last units placed are small in bytes, so the dot product alone leaves bytes that few of them could even out.
    """
    rng = np.random.default_rng(0)
    none = np.zeros((1, units.shape[1]))
    for _ in range(rounds):
        d = int(np.argmax(residual.max(axis=0) - residual.min(axis=0)))
        full, free = int(np.argmin(residual[:, d])), int(np.argmax(residual[:, d]))
        a, b = np.flatnonzero(out == full), np.flatnonzero(out == free)
        a, b = (rng.choice(x, tries, replace=False) if len(x) > tries else x for x in (a, b))
        moved = np.concatenate((units[a], none))[:, None] - np.concatenate((units[b], none))[None]
        cost = ((residual[full] + moved) ** 2 + (residual[free] - moved) ** 2).sum(axis=2)
        i, j = np.unravel_index(int(cost.argmin()), cost.shape)
        if cost[i, j] >= (residual[full] ** 2 + residual[free] ** 2).sum() - 1e-15:
            break
        residual[full] += moved[i, j]
        residual[free] -= moved[i, j]
        if i < len(a):
            out[a[i]] = free
        if j < len(b):
            out[b[j]] = full
    return out


def shard(docs: DataFrame, p: Params = Params(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, tokens, text_crc32, shard, slot) for every row; size is UTF-8 bytes plus 1, slot is 0, 1, 2 .. in the shard.

    Only id and text are read, once; the narrow rows are kept in the shared folder.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.size(words(body)).cast("long").alias("tokens"), F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("g"))
    rows = cut(rows)
    dims = ["size", "tokens", "rows_"]
    groups = rows.groupBy("g").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows_"))
    total = groups.agg(*[F.sum(d).alias(d) for d in dims]).first()
    if not total["rows_"]:
        return rows.select("doc_id", "size", "tokens", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    share = F.greatest(*[F.col(d) / F.lit(float(max(total[d], 1))) for d in dims])
    n_bundles = round(1 / p.grain)
    bundle = F.pmod(F.xxhash64(F.lit("bundle"), F.col("g")), F.lit(n_bundles)).cast("int")
    parts_of = F.least(F.ceil(share / p.most), F.col("rows_")).cast("int")
    # At most 3 / grain groups reach the grain, in at most 3 / most parts more: few enough to collect and to broadcast.
    large = groups.where(share >= p.grain).select("g", *dims, parts_of.alias("parts")).collect()
    small = groups.where(share < p.grain).groupBy(bundle.alias("b")).agg(*[F.sum(d).alias(d) for d in dims]).collect()
    spark = docs.sparkSession
    split = spark.createDataFrame([(r["g"], r["parts"]) for r in large if r["parts"] > 1], "g_ long, parts int")
    part = F.pmod(F.xxhash64(F.lit("part"), F.col("doc_id")), F.col("parts")).cast("int")
    pieces = rows.join(F.broadcast(split), F.col("g") == F.col("g_")).groupBy("g", part.alias("part")).agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows_")).collect()
    units = {(r["g"], 0): r for r in large if r["parts"] == 1} | {(r["g"], r["part"]): r for r in pieces} | {(None, r["b"]): r for r in small}
    keys = sorted(units, key=str)
    vectors = np.array([[units[k][d] for d in dims] for k in keys], dtype=float) / np.array([max(total[d], 1) for d in dims])
    table = dict(zip(keys, map(int, place(vectors, p.shards)), strict=True))
    by_group = spark.createDataFrame([(r["g"], r["parts"], [table.get((r["g"], k), 0) for k in range(r["parts"])]) for r in large], "g_ long, parts int, to array<int>")
    by_bundle = F.get(F.lit([table.get((None, b), 0) for b in range(n_bundles)]), bundle)
    found = rows.join(F.broadcast(by_group), F.col("g") == F.col("g_"), "left").withColumn("shard", F.coalesce(F.get("to", part), by_bundle)).drop("g_", "parts", "to")
    return numbered(found, ["shard"], [F.col("doc_id"), F.col("text_crc32"), F.col("size")], "slot").select("doc_id", "size", "tokens", "text_crc32", "shard", "slot")
