"""License scan by sparse TF-IDF cosine, and inheritance from directories (native expressions only).

Segments of a text (the sentences of its lines, each two lines in a row, and the whole text of a licence file) are vectors of token counts
times inverse document frequencies, over all documents and over the templates, so that names and versions decide; they are compared with each template by cosine. The templates hold every version and
variant of a license as its own, and a segment counts only if it is nearer to one license than to any other by a margin: a license that
isn't listed is as near to several, and stays unknown. A file without a license of its own inherits that of the nearest directory
above it that has a licence file.

Only segments with one of the key tokens are compared. The key tokens of a template are all but its lightest ones whose joint norm
stays below ``threshold`` times the template's: by the Cauchy-Schwarz inequality a segment without a key token can't reach the
threshold. So the filter loses nothing. By the same inequality the cosine is at most the share that the words of templates have in the
norm of a segment. Their weights are known before any join, and other words weigh at least what their document frequency allows, which is
known for the ``common`` most frequent ones and at most that of the last of these for the rest. A segment whose share stays below the
threshold is left out as well, such as a line of a key token with other lines around it. Segments are small tables of words, joined to
the document frequencies of all words by a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, let
from .licence_texts import TEMPLATES

LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)(\..*)?$"
BREAK = r"[^\p{L}\p{N}]+"
SENTENCE_END = r"[.;!?]+\s+"
#: A notice that names no license; it counts only where a file declares none by name.
RESERVED = "proprietary"


@dataclass(frozen=True)
class Params:
    threshold: float = 0.7
    margin: float = 0.02  # by which the best license must be nearer than the next
    common: int = 1024  # words whose document frequencies bound the norms from below; more are slower to test, none changes the result
    templates: dict = field(default_factory=lambda: TEMPLATES)

    def listed(self) -> list[tuple[str, str]]:
        """(license, template) in the order of names."""
        return [(name, text) for name in sorted(self.templates) for text in self.templates[name]]


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BREAK), "")


def _words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def vocabulary(p: Params) -> list[str]:
    return sorted({w for _, text in p.listed() for w in _words(text)})


def document_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """(w, df): how many documents hold each word; the row of the empty word is the number of documents. One pass over all texts."""
    found = docs.select(F.explode(F.concat(F.array_distinct(tokens(F.col(text))), F.array(F.lit("")))).alias("w"))
    return found.groupBy("w").agg(F.count("*").alias("df"))


@dataclass
class Vectors:
    """Weighted templates: (license, norm, weights), the key tokens, the number of documents, and what words weigh by the templates."""

    templates: list[tuple[str, float, dict[str, float]]]
    keys: list[str]
    n: int
    told: dict[str, float]
    other: float  # of a word in no template
    df: dict[str, int]

    def weight(self, w: str, df: int) -> float:
        return (math.log((1 + self.n) / (1 + df)) + 1) * self.told.get(w, self.other)


def weigh(n: int, df: dict[str, int], p: Params = Params()) -> Vectors:
    out, keys, t = [], set(), len(p.listed())
    held = Counter(w for _, text in p.listed() for w in set(_words(text)))
    told = {w: 1 + math.log(t / k) for w, k in sorted(held.items())}
    for name, text in p.listed():
        weights = {w: c * (math.log((1 + n) / (1 + df.get(w, 0))) + 1) * told[w] for w, c in sorted(Counter(_words(text)).items())}
        norm = math.sqrt(sum(x * x for x in weights.values()))
        out.append((name, norm, weights))
        rest = 0.0
        for w in sorted(weights, key=lambda w: (weights[w], w)):
            rest += weights[w] ** 2
            if rest >= (p.threshold * norm) ** 2 * (1 - 1e-9):
                keys.add(w)
    return Vectors(out, sorted(keys), n, told, 1 + math.log(t) / 2, df)


def in_reach(ws: Column, v: Vectors, common: dict[str, int], p: Params = Params()) -> Column:
    """Whether the words of templates have so large a share in the norm of a segment that a template can be near.

    ``common`` are the document frequencies of the most frequent words; no other word has a larger one than the last of them.
    The squares of words outside the templates are added as if none stood twice, and with logarithms rounded down to halves.
    """
    rarity = lambda df: math.log((1 + v.n) / (1 + df))
    square = lambda r: ((r + 1) * v.other) ** 2
    rest, levels = square(rarity(min(common.values(), default=v.n))), {}
    for w, df in common.items():
        if w not in v.told:
            levels.setdefault(square(math.floor(2 * rarity(df)) / 2), []).append(w)
    weights = F.map_from_arrays(F.lit(list(v.told)), F.lit([v.weight(w, v.df.get(w, 0)) for w in v.told]))

    def outside(x: Column) -> Column:
        least = F.lit(rest)
        for level, held in sorted(levels.items(), reverse=True):
            least = F.when(x.isin(held), level).otherwise(least)
        return F.when(x.isin(sum(levels.values(), [])), least).otherwise(rest) if levels else least

    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    times = lambda w, t: F.size(t) - F.size(F.array_remove(t, w))
    inside = let(F.filter(ws, lambda x: x.isin(list(v.told))), lambda t: total(F.transform(F.array_distinct(t), lambda w: F.pow(times(w, t) * F.element_at(weights, w), F.lit(2.0)))))
    least = (max(p.threshold - 1e-6, 0.0)) ** 2 * (1 - 1e-9)  # scores are rounded to six digits
    return inside * (1 - least) >= total(F.transform(F.filter(ws, lambda x: ~x.isin(list(v.told))), outside)) * least


def segments(text: Column, v: Vectors, common: dict[str, int], whole: Column, p: Params = Params()) -> Column:
    """Token arrays of the segments that hold a key token and may be near a template: sentences of lines, two lines in a row, and the whole text where ``whole``."""
    body, wanted = F.coalesce(text, F.lit("")), F.lit(v.keys)

    def of(lines: Column) -> Column:
        sentences = F.flatten(F.transform(lines, lambda x: F.split(x, SENTENCE_END)))
        following = F.when(F.size(lines) > 1, F.zip_with(F.slice(lines, F.lit(1), F.size(lines) - 1), F.slice(lines, F.lit(2), F.size(lines) - 1), lambda a, b: F.concat_ws(" ", a, b)))
        made = F.concat(sentences, F.coalesce(following, F.array().cast("array<string>")), F.when(whole, F.array(body)).otherwise(F.array().cast("array<string>")))
        return F.filter(F.transform(made, lambda x: tokens(x)), lambda w: F.arrays_overlap(w, wanted) & in_reach(w, v, common, p))

    found = let(F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[\p{L}\p{N}]")), of)
    return F.when(F.arrays_overlap(tokens(body), wanted), found)


def declared(candidates: DataFrame, df: DataFrame, v: Vectors, p: Params = Params()) -> DataFrame:
    """(rid, license, score) for the rows of candidates (rid, segs) that declare a license. Equal segments are scored once, however many rows hold them."""
    spark = candidates.sparkSession
    vectors = [(w, told, [weights.get(w, 0.0) for _, _, weights in v.templates]) for w, told in v.told.items()]
    table = F.broadcast(spark.createDataFrame(vectors, "tw string, told double, tv array<double>"))  # bounded by the templates
    held = candidates.select("rid", F.explode(F.array_distinct("segs")).alias("ws")).select("rid", F.sha2(F.concat_ws(" ", "ws"), 256).alias("seg"), "ws")
    words = held.dropDuplicates(["seg"]).select("seg", F.explode("ws").alias("w"))
    counted = words.groupBy("seg", "w").agg(F.count("*").alias("k")).join(df, "w", "left").join(table, F.col("w") == F.col("tw"), "left")
    weighted = counted.withColumn("v", F.col("k") * (F.log((1 + F.lit(v.n)) / (1 + F.coalesce("df", F.lit(0)))) + 1) * F.coalesce("told", F.lit(v.other)))
    dots = [F.coalesce(F.sum(F.col("v") * F.get("tv", F.lit(k))), F.lit(0.0)).alias(f"d{k}") for k in range(len(v.templates))]
    summed = weighted.groupBy("seg").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"), *dots)
    scores = F.array(*[F.struct(F.round(F.col(f"d{k}") / (F.col("norm") * F.lit(norm)), 6).alias("score"), F.lit(-k).alias("rank"), F.lit(name).alias("license")) for k, (name, norm, _) in enumerate(v.templates)])
    best = summed.select("seg", scores.alias("scores")).withColumn("best", F.array_max("scores")).where(F.col("best.score") >= p.threshold)
    rival = F.array_max(F.transform(F.filter("scores", lambda x: x["license"] != F.col("best.license")), lambda x: x["score"]))
    clear = best.where(F.col("best.score") >= F.round(F.coalesce(rival, F.lit(0.0)) + p.margin, 6)).select("seg", F.struct((F.col("best.license") != RESERVED).alias("named"), "best").alias("b"))
    return held.select("rid", "seg").join(clear, "seg").groupBy("rid").agg(F.max("b").alias("b")).select("rid", F.col("b.best.license").alias("license"), F.col("b.best.score").alias("score"))


def scan(files: DataFrame, p: Params = Params(), file_id: str = "doc_id", path: str = "path", text: str = "text") -> DataFrame:
    """(file_id, path, declared, score, inherited, inherited_from, license) for every row of files.

    declared is the file's own license, that of the best segment; a notice that reserves all rights counts only where nothing else is
    declared. inherited is that of the nearest directory (its own first) with a licence file that declares one; of
    several in a directory the one of the best score counts, then the first by name. license is the declared, else the inherited
    one. A null path is in no directory; null and empty texts declare nothing; repeated rows are all returned; an
    empty table gives an empty result. Other columns are not read.
    """
    rows = files.select(F.col(file_id).alias("file_id"), F.col(path).alias("path"), F.col(text).alias("text"))
    df = cut(document_frequencies(rows))
    known = {r["w"]: r["df"] for r in df.where(F.col("w").isin([*vocabulary(p), ""])).collect()}
    v = weigh(known.pop("", 0), known, p)
    common = {r["w"]: r["df"] for r in df.where("w <> ''").orderBy(F.desc("df"), "w").limit(p.common).collect()}
    is_file = F.coalesce(F.substring_index("path", "/", -1).rlike(LICENCE_FILE), F.lit(False))
    narrow = rows.select("file_id", "path", is_file.alias("is_file"), F.regexp_replace("path", r"/?[^/]*$", "").alias("dir"), segments(F.col("text"), v, common, is_file, p).alias("segs"), F.monotonically_increasing_id().alias("rid"))
    narrow = cut(narrow)  # from here on a row keeps its number
    own = declared(narrow.where(F.size("segs") > 0), df.where("w <> ''"), v, p)
    found = cut(narrow.drop("segs").join(own, "rid", "left").drop("rid"))
    best = F.struct((-F.col("score")).alias("s"), "license")
    owners = found.where("is_file and license is not null and dir is not null").groupBy("dir").agg(F.min(best).alias("b")).select(F.col("dir").alias("owner"), F.col("b.license").alias("inherited"))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("owner")))
    climbed = found.where("dir is not null").select("dir").distinct().select("dir", F.explode(above).alias("a")).select("dir", "a.*").distinct()
    nearest = climbed.join(owners, "owner").groupBy("dir").agg(F.max(F.struct("depth", F.col("owner").alias("inherited_from"), "inherited")).alias("n")).select(F.col("dir").alias("dir_"), "n.inherited", "n.inherited_from")
    joined = found.join(nearest, F.col("dir") == F.col("dir_"), "left")
    return joined.select("file_id", "path", F.col("license").alias("declared"), "score", "inherited", "inherited_from", F.coalesce("license", "inherited").alias("license"))
