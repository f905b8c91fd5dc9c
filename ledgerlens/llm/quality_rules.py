"""Quality rules by distribution divergence (native expressions only).

A document's histogram of character classes and its histogram of common words are compared with a
reference for its language by the Jensen-Shannon distance (base 2, so 0 to 1). The references are the scaled
medians, class by class, over all documents of the language that are long enough: a minority of junk doesn't move them. Two guards keep short texts from being judged on
noise: fewer than ``min_chars`` word characters skip the first test, fewer than ``min_words`` the second.

Defined results: a null or empty text has zero counts and fails the base rule (fewer than ten words);
a null or unlisted ``lang`` is compared, by character classes only, with the reference over all documents; repeated rows are
judged one by one and all returned; an empty table gives an empty result. Existing columns are kept:
the verdict columns are put into one struct column, whose name the caller chooses.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let, words

# The commonest function words of each language.
COMMON_WORDS = {
    "de": ["der", "die", "und", "den", "von", "das", "mit", "sich", "des", "auf", "ist", "in"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "was", "with", "by"],
    "es": ["de", "la", "que", "el", "los", "se", "del", "las", "un", "por", "una", "en"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
}
# Character classes; what is neither a separator nor in one of them is the fifth class.
CLASSES = {"lower": r"[^\p{Ll}]+", "upper": r"[^\p{Lu}]+", "digit": r"[^\p{Nd}]+", "stop": r"""[^.,;:!?'"()-]+"""}
SYMBOLS = r"[^#*$%&|<>]+"
ANY = "*"
#: Steps in which the references count shares.
BINS = 1000


@dataclass(frozen=True)
class Rules:
    """Parameters of the verdict. A distance above its limit rejects the document."""

    min_chars: int = 250
    min_words: int = 100
    max_char_distance: float = 0.2
    max_word_distance: float = 0.26
    least_words: int = 10
    repeat_percent: int = 20
    window: int = 5


def covered_by_repeats(tokens: Column, k: int) -> Column:
    """Words of tokens that lie in a k-word window found at least twice, the first occurrence included.

    Windows are compared by chained 64-bit hashes. Texts without a repeat stop at a distinct count; the others
    sort (hash, position) once, so that the work stays n log n for texts of any length.
    """

    def cover(at: Column) -> Column:
        gaps = F.transform(at, lambda p, i: F.least(F.lit(k), F.coalesce(F.get(at, i + 1) - p, F.lit(k))))
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    def repeats(pairs: Column) -> Column:
        twice = F.filter(pairs, lambda s, i: (F.get(pairs, i - 1)["h"] == s["h"]) | (F.get(pairs, i + 1)["h"] == s["h"]))
        return let(F.sort_array(F.transform(twice, lambda s: s["p"])), cover)

    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(pairs, repeats)).otherwise(0)

    def windows(ids: Column) -> Column:
        full = F.transform(ids, lambda x, i: F.xxhash64(x, *[F.get(ids, i + j) for j in range(1, k)]))
        return F.slice(full, 1, F.greatest(F.size(ids) - (k - 1), F.lit(0)))

    return let(let(F.transform(tokens, lambda w: F.xxhash64(w)), windows), count).cast("long")


def _char_histogram(text: Column, nonspace: Column) -> Column:
    counts = [F.length(F.regexp_replace(text, pattern, "")) for pattern in CLASSES.values()]
    return let(F.array(*counts), lambda c: F.concat(c, F.array(nonspace - F.aggregate(c, F.lit(0), lambda a, b: a + b))))


def _word_histogram(tokens: Column, lang: Column) -> Column:
    every = sorted({w for listed in COMMON_WORDS.values() for w in listed})
    hits = F.filter(tokens, lambda w: w.isin(every))
    listed = reduce(lambda c, k: c.when(lang == k, F.array(*map(F.lit, COMMON_WORDS[k]))), COMMON_WORDS, F)
    listed = listed.otherwise(F.array().cast("array<string>"))
    counts = let(hits, lambda h: F.transform(listed, lambda c: F.size(F.filter(h, lambda x: x == c))))
    return let(counts, lambda c: F.concat(c, F.array(F.size(tokens) - F.aggregate(c, F.lit(0), lambda a, b: a + b))))


def _measured(docs: DataFrame, text: str, lang: str) -> tuple[DataFrame, str, str]:
    """docs with a column of the words and one of the histograms; every text is read whole."""
    w, m = fresh(docs, "words_", "measured_")
    body = F.coalesce(F.col(text), F.lit(""))
    known = F.when(F.col(lang).isin(list(COMMON_WORDS)), F.col(lang)).otherwise(ANY)
    nonspace = F.length(F.array_join(w, ""))
    out = docs.withColumn(w, words(F.col(text)))
    return out.withColumn(m, F.struct(known.alias("lang"), nonspace.alias("chars"), _char_histogram(body, nonspace).alias("char_h"), _word_histogram(F.col(w), known).alias("word_h"))), w, m


def fit_references(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang") -> dict[str, dict[str, list[float]]]:
    """Median histograms by language over all documents that are long enough: {language: {"char": [..], "word": [..]}}.

    Shares are counted in BINS steps, so that what is gathered is a count for each language, slot and step,
    whatever the size of docs.
    """
    measured, w, m = _measured(docs, text, lang)
    total = {"char": F.col(f"{m}.chars"), "word": F.size(w)}
    enough = {"char": total["char"] >= max(rules.min_chars, 1), "word": (total["word"] >= max(rules.min_words, 1)) & (F.col(f"{m}.lang") != ANY)}
    none = F.array().cast("array<struct<kind:string,slot:int,bin:bigint>>")

    def bins(kind: str) -> Column:
        return F.transform(F.col(f"{m}.{kind}_h"), lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("slot"), F.floor(x.cast("long") * BINS / total[kind]).cast("long").alias("bin")))

    shares = F.concat(*[F.when(enough[k], bins(k)).otherwise(none) for k in total])
    seen = measured.select(F.col(f"{m}.lang").alias("lang"), F.explode(shares).alias("s")).groupBy("lang", "s.kind", "s.slot", "s.bin").count()
    counts: dict[tuple, Counter] = defaultdict(Counter)
    for r in seen.collect():
        for key in {r["lang"], ANY}:
            counts[key, r["kind"], r["slot"]][r["bin"]] += r["count"]

    def median(found: Counter) -> float:
        below = accumulate(found[b] for b in sorted(found))
        return next((float(b) for b, n in zip(sorted(found), below, strict=True) if 2 * n >= sum(found.values())), 0.0)

    slots = {"char": len(CLASSES) + 1, "word": len(next(iter(COMMON_WORDS.values()))) + 1}
    out: dict[str, dict[str, list[float]]] = {}
    for key in {k[0] for k in counts}:
        raw = {kind: [median(counts[key, kind, i]) for i in range(n)] for kind, n in slots.items()}
        out[key] = {kind: [x / (sum(xs) or 1.0) for x in xs] for kind, xs in raw.items()}
    return out


def jensen_shannon(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence in bits of two histograms with sum 1, 0 to 1."""

    def term(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(F.lit(2.0) * x / (x + y))).otherwise(0.0)

    parts = F.zip_with(p, q, lambda x, y: term(x, y) + term(y, x))
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, b: a + b) / 2, F.lit(0.0)))


def judge(docs: DataFrame, references: dict, rules: Rules = Rules(), text: str = "text", lang: str = "lang", out: str = "quality") -> DataFrame:
    """docs with a struct column ``out``: the counts, both distances (null under their guard) and the verdict."""
    measured, w, m = _measured(docs, text, lang)
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    base = fresh(measured, "base_")[0]
    measured = measured.withColumn(
        base,
        F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.col(f"{m}.chars").cast("long").alias("word_chars"),
            F.length(F.regexp_replace(body, SYMBOLS, "")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            covered_by_repeats(F.col(w), rules.window).alias("n_repeat_words"),
        ),
    )

    def distance(kind: str, total: Column, guard: int) -> Column:
        table = F.create_map(*[x for k, v in references.items() for x in (F.lit(k), F.array(*map(F.lit, v[kind])))]) if references else None
        if table is None:
            return F.lit(None).cast("double")
        key = F.col(f"{m}.lang")
        q = F.coalesce(F.try_element_at(table, key), F.try_element_at(table, F.lit(ANY)))
        known = (total >= max(guard, 1)) & (F.lit(kind == "char") | (key != ANY)) & (F.aggregate(q, F.lit(0.0), lambda a, b: a + b) > 0)
        return F.when(known, let(q, lambda r: jensen_shannon(F.transform(F.col(f"{m}.{kind}_h"), lambda x: x / total), r)))

    d = fresh(measured, "distance_")[0]
    measured = measured.withColumn(d, F.struct(distance("char", F.col(f"{m}.chars"), rules.min_chars).alias("char_distance"), distance("word", F.size(w), rules.min_words).alias("word_distance")))
    failed = (F.col(f"{base}.n_words") < rules.least_words) | (100 * F.col(f"{base}.n_repeat_words") > rules.repeat_percent * F.col(f"{base}.n_words"))
    close = (F.coalesce(F.col(f"{d}.char_distance"), F.lit(0.0)) <= rules.max_char_distance) & (F.coalesce(F.col(f"{d}.word_distance"), F.lit(0.0)) <= rules.max_word_distance)
    verdict = F.struct(F.col(f"{base}.*"), F.col(f"{d}.*"), failed.alias("base_failed"), (~failed & close).alias("kept"))
    return measured.withColumn(out, verdict).select(*docs.columns, out)


def quality_rules(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang", out: str = "quality") -> DataFrame:
    """Fit the references on all of docs, then judge all of docs."""
    return judge(docs, fit_references(docs, rules, text, lang), rules, text, lang, out)
