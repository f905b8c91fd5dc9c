"""Toxicity by a lexicon trie met with Levenshtein automata, and context windows around each hit.

The lexicon is learned from labelled texts: words, and stems that stand for every word starting with them, which occur in many
toxic texts and hardly in clean ones. The trie of the lexicon is walked with the edit-distance states of a word, so a
misspelled term is found without listing its spellings; spellings that clean texts use are exceptions. Each hit weighs less
in a quotation (inside quotation marks, which pair up within a line, or near reporting words) and more near an address (``you`` and the like). A logistic
model of the summed weights gives the score.

Defined results: null and empty texts have no hits and get the score of such texts; texts are read whole; without any labelled
toxic text every score is 0. The lexicon has as many terms as the sample supports.
"""

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches
from .labelled import sample

WORD = re.compile(r"\w+")
# Words that report speech, words that address someone, and quotation marks.
REPORTING = frozenset("said says quote quoted wrote called calls word term slur insult dijo palabra dit mot sagte wort".split())
ADDRESS = frozenset("you your yours ur u tu te toi vous usted du dich ihr euch".split())
QUOTES = "\"“”„«»"


@dataclass(frozen=True)
class Params:
    max_labelled: int = 2000  # of each label: the bound of the sample for fitting
    min_texts: int = 3
    max_clean_share: float = 0.03
    clean_cost: float = 3.0
    frequent_share: float = 0.03
    stem_lengths: tuple[int, ...] = (4, 5, 6, 7, 8, 9)
    fuzzy_length: int = 5  # terms of so many letters may have one edit
    window: int = 5
    quoted_weight: float = 0.3
    address_weight: float = 1.5
    misspelled_prior: float = 0.7  # weight of a misspelled hit against an exact one, unless clean texts speak against it


class Trie:
    """Lexicon trie. A node maps letters to nodes; key "" holds (term, whether it is a stem)."""

    def __init__(self, terms: list[tuple[str, bool]], fuzzy_length: int) -> None:
        self.root: dict = {}
        self.fuzzy_length = fuzzy_length
        self.heads, self.tails, self.middles = set(), set(), set()
        for term, stem in terms:
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node.setdefault("", []).append((term, stem))
            self.heads.add(term[:2])
            if len(term) >= fuzzy_length:
                (self.middles if stem else self.tails).add(term[2:4] if stem else term[-2:])

    def may_match(self, word: str) -> bool:
        """Necessary for a match: one edit leaves the first two letters, or what follows them, as they are."""
        m = self.middles
        return word[:2] in self.heads or word[-2:] in self.tails or word[1:3] in m or word[2:4] in m or word[3:5] in m

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its edits, 0 or 1; None if there is none. A stem matches the start of a word."""
        if not self.may_match(word):
            return None
        found: list[tuple[int, str]] = []
        n = len(word)

        def walk(node: dict, states: dict[int, int]) -> None:
            """states: letters of word read so far -> least edits, of the automaton for one edit."""
            for term, stem in node.get("", ()):
                ends = [e for i, e in states.items() if stem or i == n]
                ends += [e + 1 for i, e in states.items() if not stem and i == n - 1 and e == 0]
                if ends and (min(ends) == 0 or min(ends) == 1 and len(term) >= self.fuzzy_length):
                    found.append((min(ends), term))
            for c, after in node.items():
                if c:
                    now: dict[int, int] = {}
                    for i, e in states.items():
                        steps = [(i + 1, e)] if i < n and word[i] == c else []
                        if e == 0:
                            steps += [(i, 1)] + ([(i + 1, 1)] if i < n else []) + ([(i + 2, 1)] if i + 1 < n and word[i + 1] == c else [])
                        for j, f in steps:
                            if f < now.get(j, 2):
                                now[j] = f
                    if now:
                        walk(after, now)

        walk(self.root, {0: 0})
        if not found:
            return None
        edits, term = min(found)
        return term, edits


@dataclass
class Model:
    terms: list[tuple[str, bool]]
    exceptions: frozenset[str]
    weights: list[float]  # bias, exact hits, misspelled hits
    params: Params = field(default_factory=Params)

    def matcher(self) -> "Matcher":
        return Matcher(self)

    def score(self, sums: tuple[float, float]) -> float:
        if not self.terms:
            return 0.0
        z = self.weights[0] + sum(w * math.log1p(x) for w, x in zip(self.weights[1:], sums, strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


class Matcher:
    """Hits in texts; remembers the words it has met, up to a bound."""

    MEMORY = 300_000

    def __init__(self, model: Model) -> None:
        self.model, self.trie = model, Trie(model.terms, model.params.fuzzy_length)
        self.clean: set[str] = set()
        self.hits: dict[str, int] = {}

    def known(self, words: set[str]) -> dict[str, int]:
        if len(self.clean) + len(self.hits) > self.MEMORY:
            self.clean.clear()
            self.hits.clear()
        for w in words - self.clean - self.hits.keys():
            found = self.trie.match(w)
            if found is None or found[1] and w in self.model.exceptions:
                self.clean.add(w)
            else:
                self.hits[w] = found[1]
        return {w: self.hits[w] for w in words & self.hits.keys()}

    def sums(self, text: str | None) -> tuple[float, float]:
        """Summed context weights of the exact and of the misspelled hits in the whole text."""
        low = (text or "").lower()
        words = WORD.findall(low)
        hits = self.known(set(words))
        if not hits:
            return 0.0, 0.0
        p, total = self.model.params, [0.0, 0.0]
        marks = [m.start() for m in re.finditer(f"[{QUOTES}]", low)]
        for k, m in enumerate(WORD.finditer(low)):
            edits = hits.get(m[0])
            if edits is None:
                continue
            near = words[max(0, k - p.window) : k + p.window + 1]
            inside = False
            if marks:
                # Marks are counted from the start of the line, and the one that closes must be in it too.
                at = bisect.bisect_left(marks, m.start())
                before = at - bisect.bisect_left(marks, low.rfind("\n", 0, m.start()) + 1)
                inside = before % 2 == 1 and at < len(marks) and "\n" not in low[m.start() : marks[at]]
            weight = 1.0
            if inside or not REPORTING.isdisjoint(near):
                weight = p.quoted_weight
            if not inside and not ADDRESS.isdisjoint(near):
                weight = max(weight, 1.0) * p.address_weight
            total[edits] += weight
        return total[0], total[1]


def _distinct_families(texts: list[tuple[str, int]]) -> list[tuple[set[str], str, int]]:
    """(words, text, label), one for each least hash of three words in a row: near copies count once."""
    seen, out = set(), []
    for text, label in texts:
        words = WORD.findall(text.lower())
        key = min((xxhash.xxh64_intdigest(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0)
        if (key, label) not in seen:
            seen.add((key, label))
            out.append((set(words), text, label))
    return out


def learn_terms(rows: list[tuple[set[str], str, int]], p: Params) -> list[tuple[str, bool]]:
    """Words and stems that mark toxic texts: first those that cover texts not yet covered, then all frequent ones."""

    def of(words: set[str]) -> set[tuple[str, bool]]:
        out = {(w, False) for w in words if len(w) >= 3}
        return out | {(w[:k], True) for w in words for k in p.stem_lengths if len(w) > k}

    toxic = [words for words, _, label in rows if label]
    support: Counter = Counter()
    for words in toxic:
        support.update(of(words))
    support = Counter({t: n for t, n in support.items() if n >= p.min_texts})
    clean: Counter = Counter()
    n_clean = 0
    for words, _, label in rows:
        if not label:
            n_clean += 1
            clean.update(t for t in of(words) if t in support)
    rate = len(toxic) / max(n_clean, 1)
    # By chance a term of n toxic and c clean texts has odds of about C(n + c, c) * share ** n; so many terms make long odds likely.
    share = len(toxic) / max(len(toxic) + n_clean, 1)
    least = math.log(max(len(support), 1)) + 1

    def strength(n: int, c: int) -> float:
        return -n * math.log(max(share, 1e-9)) - (math.lgamma(n + c + 1) - math.lgamma(n + 1) - math.lgamma(c + 1))

    pure = {t: n for t, n in support.items() if clean[t] * rate <= p.max_clean_share * n and strength(n, clean[t]) >= least}
    # How many texts not yet covered hold each term, kept up to date as texts get covered.
    held = [sorted(of(words) & pure.keys()) for words in toxic]
    open_: Counter = Counter(t for ts in held for t in ts)
    left = set(range(len(toxic)))
    chosen: list[tuple[str, bool]] = []
    order = sorted(pure, key=lambda t: (-pure[t], t[1], -len(t[0]), t))
    while left:
        # A clean text that a term would hit counts against it.
        gains = [(open_[t] - p.clean_cost * rate * clean[t], t) for t in order]
        gain = max((g for g, _ in gains), default=0.0)
        if gain < p.min_texts:
            break
        best = [t for g, t in gains if g >= 0.98 * gain]
        pick = min(best, key=lambda t: (t[1], -len(t[0]), -pure[t], t))
        chosen.append(pick)
        for i in [i for i in left if pick in held[i]]:
            left.discard(i)
            open_.subtract(held[i])
    limit = p.frequent_share * max((pure[t] for t in chosen), default=0)
    stems = [t[0] for t in chosen if t[1]]
    for t in order:
        if pure[t] >= max(limit, p.min_texts) and t not in chosen and not any(t[0].startswith(s) for s in stems):
            if not (t[1] and any(w.startswith(t[0]) for w, stem in chosen if not stem)):
                chosen.append(t)
                stems += [t[0]] if t[1] else []
    return chosen


def _fit_logistic(x: np.ndarray, y: np.ndarray, prior: float, ridge: float = 0.05) -> np.ndarray:
    """Weights of bias, exact and misspelled hits; the penalty draws the third towards prior times the second."""
    w = np.zeros(3)
    pull = ridge * (np.diag([0.0, 1.0, 0.0]) + np.outer(v := np.array([0.0, -prior, 1.0]), v))
    for _ in range(50):
        prob = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (prob * (1 - prob) + 1e-9)[:, None]).T @ x + pull + 1e-9 * np.eye(3), x.T @ (prob - y) + pull @ w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(texts: list[tuple[str, int]], p: Params = Params()) -> Model:
    """Learn lexicon, exceptions and weights. The weights are fitted on clean texts that gave no exceptions."""
    rows = _distinct_families(texts)
    terms = learn_terms(rows, p)
    if not terms:
        return Model([], frozenset(), [-30.0, 0.0, 0.0], p)
    trie = Trie(terms, p.fuzzy_length)
    clean = [r for r in rows if not r[2]]
    memo: dict[str, bool] = {}

    def misspelled(words: set[str]) -> set[str]:
        for w in words:
            if w not in memo:
                memo[w] = (m := trie.match(w)) is not None and m[1] == 1
        return {w for w in words if memo[w]}

    halves = [frozenset(w for r in part for w in misspelled(r[0])) for part in (clean[::2], clean[1::2])]
    first = Matcher(Model(terms, halves[0], [0.0, 0.0, 0.0], p))
    use = clean[1::2] + [r for r in rows if r[2]]
    x = np.array([[1.0, *map(math.log1p, first.sums(r[1]))] for r in use])
    y = np.array([float(r[2]) for r in use])
    return Model(terms, halves[0] | halves[1], [float(v) for v in _fit_logistic(x, y, p.misspelled_prior)], p)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """docs with the score of each whole text."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = model.matcher()
        for texts in batches:
            yield pd.Series([model.score(matcher.sums(t)) for t in texts], dtype="float64")

    return docs.withColumn(out, of(F.col(text)))


def toxicity(docs: DataFrame, labels: DataFrame, labelled_docs: DataFrame | None = None, p: Params = Params(), text: str = "text", out: str = "score") -> DataFrame:
    """Fit on a bounded sample of the labelled rows of labelled_docs (or docs) that aren't held out, then score all of docs."""
    model = fit(sample(docs if labelled_docs is None else labelled_docs, labels, "toxic", p.max_labelled), p)
    return score(docs, model, text, out)
