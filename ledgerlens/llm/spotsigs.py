"""Document fingerprints by SpotSigs (native expressions only).

Theobald et al., "SpotSigs: Robust and Efficient Near Duplicate Detection" (2008). Each common word is an anchor; the anchor
with the chain of the next ``chain`` content words (words that are no anchors) is one signature. A document is the set of its
signatures, its fingerprint a digest of the set, likeness the Jaccard of two sets.

A text without any signature (no anchor before a content word) has one: that of its whole word sequence. So short
texts are alike only if their words are the same. Null texts count as empty; empty texts equal each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, let

# Common words of the corpus languages that serve as anchors.
ANCHORS = {
    "de": ["als", "an", "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "im", "in", "ist", "mit", "nicht", "sich", "und", "von", "zu"],
    "en": ["a", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "that", "the", "this", "to", "was", "with"],
    "es": ["con", "de", "del", "el", "en", "es", "la", "las", "lo", "los", "para", "por", "que", "se", "su", "un", "una", "y"],
    "fr": ["au", "dans", "de", "des", "du", "en", "est", "et", "il", "la", "le", "les", "par", "pour", "que", "qui", "sur", "un", "une"],
}
CHAIN = 2
#: Everything but letters, digits and marks ends a word.
BREAK = r"[^\p{L}\p{N}\p{M}]+"


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """Distinct signatures of the whole text, never empty.

    The r-th anchor at word i has i - r content words before it, so its chain starts at content word i - r: no scan
    from each anchor is needed.
    """
    anchors = sorted({w for ws in ANCHORS.values() for w in ws})
    tokens = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BREAK), "")

    def spots(words: Column) -> Column:
        content = F.filter(words, lambda w: ~w.isin(anchors))
        marked = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        at = F.filter(marked, lambda m: m["w"].isin(anchors))
        made = let(content, lambda c: F.transform(at, lambda m, r: F.when(m["i"] - r < F.size(c), F.concat_ws(" ", m["w"], *[F.get(c, m["i"] - r + j) for j in range(chain)]))))
        found = F.array_distinct(F.filter(made, lambda s: s.isNotNull()))
        return let(found, lambda f: F.when(F.size(f) > 0, f).otherwise(F.array(F.concat(F.lit("= "), F.array_join(words, " ")))))

    return let(tokens, spots)


def fingerprint(signature_set: Column) -> Column:
    """Digest of a signature set, the same for every order of it."""
    return F.md5(F.array_join(F.sort_array(signature_set), "\n"))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def with_next_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, next_text): next in descending doc_id, the first after the last; ties go by text hash.

    Ids are cut into ranges at quantiles, each range is one window partition, and the row at a cut goes to both of its
    ranges: the texts are shuffled once, no task holds all rows. Null ids come last. Null texts become empty.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("k"))
    n, low, high = rows.agg(F.count("*"), F.min("k"), F.max("k")).first()
    if not n:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"))
    ranges = min(max(n // 200, 1), 16384)
    cuts = rows.agg(F.percentile_approx("k", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0] if ranges > 1 else []
    cuts = sorted({c for c in cuts if c < high})
    # A coarse grid over the ids leaves few cuts to compare with.
    width = (high - low) / min(max(len(cuts), 1), 4096) + 1.0
    grid: list[list[int]] = [[] for _ in range(int((high - low) / width) + 1)]
    for c in cuts:
        grid[int((c - low) / width)].append(c)
    below, first = 0, []
    for cell in grid:
        first.append(below)
        below += len(cell)
    longs = lambda xs: F.lit(xs) if xs else F.array().cast("array<bigint>")
    cells, firsts = F.array(*[longs(x) for x in grid]).cast("array<array<bigint>>"), F.array(*[F.lit(x) for x in first])
    slot = ((F.col("k").cast("double") - F.lit(float(low))) / F.lit(width)).cast("int")
    inside = rows.withColumn("slot", F.least(F.greatest(slot, F.lit(0)), F.lit(len(grid) - 1)))
    inside = inside.withColumn("cell", F.get(cells, F.col("slot")))
    part = F.get(firsts, F.col("slot")) + F.size(F.filter("cell", lambda c: c < F.col("k")))
    inside = inside.withColumn("part", part).withColumn("edge", F.array_contains("cell", F.col("k")))
    own = F.struct(F.col("part"), F.lit(0).alias("also"))
    places = F.array_compact(F.array(own, F.when(F.col("edge"), F.struct((F.col("part") + 1).alias("part"), F.lit(1).alias("also"))), F.when(F.col("k") == high, F.struct(F.lit(0).alias("part"), F.lit(2).alias("also")))))
    dealt = inside.select("doc_id", "text", "k", F.explode(places).alias("p")).select("doc_id", "text", "k", "p.*")
    order = Window.partitionBy("part").orderBy("also", F.desc("k"), F.xxhash64("text"))
    return dealt.withColumn("next_text", F.lead("text").over(order)).where("also = 0").select("doc_id", "text", "next_text")


def edited_text(text: Column, following: Column) -> Column:
    """text with its last third (rounded down) replaced by as many first code points of the following text, or all."""
    k = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - k), F.substring(following, F.lit(1), k))


def similar_pairs(docs: DataFrame, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, pairs): members maps each doc_id to its set's class, pairs are the class pairs (a < b) of likeness >= threshold.

    Equal sets form one class, so copies never pair up. Sets are partitioned by length: two sets of likeness t differ in
    length by a factor t at most, so a set meets only those of its own and the next longer length bands, each band a
    factor 1 / threshold wide. Within, the rarest signatures of each set (as many as a likeness >= threshold must share) are the
    join keys; who meets is verified by length bound and exact Jaccard. No pair at or above the threshold is lost.
    """
    sets = cut(docs.select(F.col(doc_id).alias("doc_id"), signatures(F.col(text)).alias("s")).withColumn("class", fingerprint(F.col("s"))))
    members = sets.select("doc_id", "class")
    classes = cut(sets.groupBy("class").agg(F.first("s").alias("s")))
    seen = classes.select(F.explode("s").alias("sig")).groupBy("sig").agg(F.count("*").alias("df"))
    ranked = classes.select("class", F.size("s").alias("n"), F.explode("s").alias("sig")).join(seen, "sig")
    rarest = ranked.withColumn("r", F.row_number().over(Window.partitionBy("class").orderBy("df", "sig"))).where(F.col("r") <= F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - 1e-9) + 1)
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / threshold))).cast("int")
    keys = rarest.where("df > 1").select("class", "n", "sig", band.alias("band"))
    a = keys.select(F.col("class").alias("ca"), F.col("n").alias("na"), "sig", F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    b = keys.select(F.col("class").alias("cb"), F.col("n").alias("nb"), "sig", "band")
    met = a.join(b, ["sig", "band"]).where((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("ca") < F.col("cb"))))
    near = met.where(F.col("na") >= F.col("nb") * F.lit(threshold) - 1e-9).select("ca", "cb").distinct()
    sa, sb = classes.select(F.col("class").alias("ca"), F.col("s").alias("sa")), classes.select(F.col("class").alias("cb"), F.col("s").alias("sb"))
    scored = near.join(sa, "ca").join(sb, "cb").withColumn("likeness", jaccard(F.col("sa"), F.col("sb"))).where(F.col("likeness") >= threshold - 1e-9)
    return members, scored.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"), "likeness")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, next_text, edited, s, s_edited, s_next): the texts and signature sets of each row, its edit and its successor.

    Existing columns other than id and text are not read. An empty table gives an empty result.
    """
    out = with_next_text(docs, doc_id, text).withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    return out.select("*", signatures(F.col("text")).alias("s"), signatures(F.col("edited")).alias("s_edited"), signatures(F.col("next_text")).alias("s_next"))
