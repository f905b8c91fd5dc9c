"""Mixing sources to target weights with soft membership.

A classifier fitted on a bounded labelled table gives each document a posterior over domains. Then nonnegative rates are fitted for all
documents, by projected gradient on a least squares problem, so that the expected tokens of each domain, summed over
documents as rate * tokens * posterior, match the targets.

The squares are taken in the metric of the inverse Gram matrix G of the posteriors (the sum of tokens * posterior * posterior'),
a few numbers summed once. In it every direction that the rates can move the totals in has curvature 1, so a step of one
meets the targets at once as long as no rate turns negative, however much the domains overlap; only rates held at zero take more rounds.

The gradient of a document's rate depends on its posterior and the few residuals of the domains only. So what a round adds to the
state of the iteration is one step of a few numbers: every pass recomputes the rates from the steps and sums one vector on the
executors. Every ``replay`` rounds the rates go to the shared folder, so work grows with the rounds and not with their square; a lost
executor costs a recomputation of its part.

Defined results: a null or empty text has no tokens, gets the prior as posterior and
can't change any total; a domain that no document belongs to can't be filled and is left out of the fit; an empty table gives an empty result.
Targets that nonnegative rates can't meet are met as nearly as the rounds allow; ``miss`` in the result says how nearly.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, cut, fresh, refuse, words
from .labelled import held_out


@dataclass(frozen=True)
class Params:
    max_labelled: int = 400  # of each domain: with max_domains the bound of the sample for fitting
    max_domains: int = 64
    features: int = 1 << 16
    epochs: int = 40
    rate: float = 2.0
    rounds: int = 200
    replay: int = 16  # rounds after which the rates are written, so that no pass goes through more steps than that
    gain: float = 1e-3  # part of the squares that so many rounds must win, else no better rates are in reach
    tolerance: float = 1e-3  # greatest relative miss of a target at which the fit stops
    block: int = 1 << 14  # documents that a row of the state holds
    part: int = 1 << 25  # bytes of tokens and posteriors that a task of a pass reads
    flat: float = 1e-9  # directions of G below this part of its largest eigenvalue are left alone


# ---- the classifier: multinomial logistic regression on the shares of byte pairs


@dataclass
class Classifier:
    domains: list[str]
    weights: np.ndarray  # features x domains
    offset: np.ndarray

    @staticmethod
    def pairs(text: str | None) -> np.ndarray:
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.int32)
        return raw[:-1] * 256 + raw[1:]

    def posterior(self, text: str | None, segment: int = 1 << 16) -> np.ndarray:
        """Over the whole text, in segments, so that memory doesn't grow with its length."""
        pairs = self.pairs(text)
        z = self.offset.astype(np.float64)
        if len(pairs):
            z = z + sum(self.weights[pairs[i : i + segment]].sum(axis=0, dtype=np.float64) for i in range(0, len(pairs), segment)) / len(pairs)
        e = np.exp(z - z.max())
        return e / e.sum()


def fit_classifier(rows: list[tuple[str, str]], p: Params = Params()) -> Classifier:
    """rows are (text, domain)."""
    domains = sorted({d for _, d in rows})
    y = np.array([domains.index(d) for _, d in rows])
    prior = np.log(np.bincount(y, minlength=len(domains)) / max(len(y), 1)) if len(y) else np.zeros(len(domains))
    weights, offset = np.zeros((p.features, len(domains)), np.float32), prior.astype(np.float32)
    sparse = []
    for text, _ in rows:
        at, n = np.unique(Classifier.pairs(text), return_counts=True)
        sparse.append((at, (n / max(n.sum(), 1)).astype(np.float32)))
    total = np.zeros((p.features, 1), np.float32)
    for at, share in sparse:
        total[at, 0] += share**2
    # Each pair has its own step: rare pairs move as fast as frequent ones.
    step = p.rate / (np.sqrt(total) + 1e-3)
    for _ in range(p.epochs):
        grad, bias = np.zeros_like(weights), np.zeros_like(offset)
        for (at, share), k in zip(sparse, y, strict=True):
            z = share @ weights[at] + offset
            e = np.exp(z - z.max())
            error = e / e.sum()
            error[k] -= 1
            grad[at] += share[:, None] * error[None]
            bias += error
        weights -= step * grad
        offset -= p.rate * bias / max(len(y), 1)
    return Classifier(domains, weights, offset)


def labelled_sample(docs: DataFrame, table: DataFrame, p: Params, doc_id: str = "doc_id", text: str = "text") -> list[tuple[str, str]]:
    """Whole texts with their domain for up to max_labelled ids of each domain of table (doc_id, domain), in the order of a hash of the id.

    Only those ids, max_labelled for each domain, are sent to the executors. Held-out rows are left out.
    """
    usable = cut(table.select("doc_id", "domain").where("doc_id is not null and domain is not null").where(~held_out("doc_id")))
    domains = sorted(r["domain"] for r in usable.select("domain").distinct().limit(p.max_domains + 1).collect())
    if len(domains) > p.max_domains:
        raise ValueError(f"more than {p.max_domains} domains")
    ids = None
    for d in domains:
        some = usable.where(F.col("domain") == d).orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.max_labelled).select("doc_id", "domain")
        ids = some if ids is None else ids.unionByName(some)
    if ids is None:
        return []
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text_")).where("text_ is not null").join(F.broadcast(ids), "doc_id").select("doc_id", "text_", "domain").distinct().collect()
    return [(r["text_"], r["domain"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["domain"], r["text_"]))]


# ---- the rates


def rates(posterior: np.ndarray, steps: list[np.ndarray], begun: int = 0, state: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rates after one accelerated projected-gradient step (Nesterov) for each of steps, for a matrix of posteriors.

    They start from 1, or from the state that ``begun`` steps gave. Never negative. The second array are the extrapolated rates, at
    which the next round's totals are measured.
    """
    w, look = state or (np.ones(len(posterior)), np.ones(len(posterior)))
    for k, step in enumerate(steps[begun:], begun):
        last, w = w, np.maximum(0.0, look - posterior @ step)
        look = w + k / (k + 3) * (w - last)
    return w, look


def _packed(soft: DataFrame, p: Params) -> DataFrame:
    """soft (n, q) as blocks of at most ``p.block`` documents, raw doubles in binary columns: n, q, and w, look once begun.

    A pass reads a block as one matrix. Row by row it would take as long as the classifier after some dozen rounds.
    """

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, posteriors, held = [], [], 0

        def block() -> pd.DataFrame:
            return _block(np.concatenate(tokens), np.concatenate(posteriors))

        for b in batches:
            for i in range(0, len(b), p.block):
                x = b.iloc[i : i + p.block]
                if held + len(x) > p.block:
                    yield block()
                    tokens, posteriors, held = [], [], 0
                tokens.append(x["n"].to_numpy(dtype=float))
                posteriors.append(np.concatenate(x["q"].to_numpy()).astype(float))
                held += len(x)
        if held:
            yield block()

    state = cut(soft.mapInPandas(part, BLOCK))
    size = state.agg(F.sum(F.octet_length("n") + F.octet_length("q"))).first()[0] or 0
    return state.coalesce(max(4, -(-size // p.part)))


BLOCK = "n binary, q binary, w binary, look binary"


def _block(*columns: np.ndarray) -> pd.DataFrame:
    raw = [c.tobytes() for c in columns]
    return pd.DataFrame({k: [v] for k, v in zip(("n", "q", "w", "look"), [*raw, None, None], strict=False)})


def _replayed(b: pd.DataFrame, steps: list[np.ndarray], begun: int, d: int) -> Iterator[tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]]:
    """Tokens, posteriors and rates of each block of the state."""
    for n, q, *state in zip(*(b[c] for c in ("n", "q", "w", "look")), strict=True):
        q = np.frombuffer(q).reshape(-1, d)
        yield np.frombuffer(n), q, rates(q, steps, begun, tuple(np.frombuffer(x) for x in state) if begun else None)


def _totals(state: DataFrame, steps: list[np.ndarray], begun: int, d: int, gram: bool = False) -> np.ndarray:
    """Tokens by domain at the rates of now and at those extrapolated; with gram also G, at rate 1. One pass, one row from each task."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2 + gram * d, d))
        for b in batches:
            for n, q, both in _replayed(b, steps, begun, d):
                total[:2] += np.stack([(n * w) @ q for w in both])
                if gram:
                    total[2:] += (q * n[:, None]).T @ q
        yield pd.DataFrame({"t": [total.ravel()]})

    sums = state.mapInPandas(part, "t array<double>").agg(*[F.sum(F.get("t", F.lit(i))).alias(f"t{i}") for i in range((2 + gram * d) * d)]).first()
    return np.array([x or 0.0 for x in sums]).reshape(-1, d)


def _written(state: DataFrame, steps: list[np.ndarray], begun: int, d: int) -> DataFrame:
    """The state after all steps, in the shared folder."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for n, q, (w, look) in _replayed(b, steps, begun, d):
                yield _block(n, q, w, look)

    return cut(state.mapInPandas(part, BLOCK))


@dataclass
class Fit:
    steps: list[np.ndarray]  # for rates()
    miss: float  # greatest relative miss of a target at these rates


def fit_rates(soft: DataFrame, targets: list[float], p: Params = Params(), tokens: str = "tokens", posterior: str = "posterior", budget: float | str | None = None) -> Fit:
    """Steps for rates(), one a round until every target is met within the tolerance, or the squares hardly fall any more.

    budget is the tokens wanted in all; None keeps as many as there are; "cover" takes the least at which no domain shrinks. A target
    of 0 is missed by what is left there, as a part of the budget.
    """
    steps: list[np.ndarray] = []
    begun, d = 0, len(targets)
    state = _packed(soft.select(F.col(tokens).cast("long").alias("n"), F.col(posterior).alias("q")), p)
    first, look, *gram = _totals(state, steps, begun, d, gram=True)
    open_ = first > 0
    goal = np.array(targets, dtype=float)
    goal = goal / goal.sum()
    if budget == "cover":
        budget = float(max((first[goal > 0] / goal[goal > 0]).max(), first.sum()))
    budget = first.sum() if budget is None else budget
    goal = goal * budget
    size, axes = np.linalg.eigh(np.array(gram))
    metric = (axes / np.where(size > p.flat * max(size.max(), 1e-300), size, np.inf)) @ axes.T

    def miss(now: np.ndarray) -> float:
        return float((np.abs(now - goal) / np.where(goal > 0, goal, max(budget, 1.0)))[open_].max()) if open_.any() else 0.0

    def squares(now: np.ndarray) -> float:
        return float((off := np.where(open_, now - goal, 0.0)) @ metric @ off)

    now, before = first, squares(first)
    while miss(now) > p.tolerance and len(steps) < p.rounds:
        if len(steps) - begun == p.replay:
            if squares(now) > (1 - p.gain) * before:
                break
            state, begun, before = _written(state, steps, begun, d), len(steps), squares(now)
        steps.append(metric @ np.where(open_, look - goal, 0.0))
        now, look = _totals(state, steps, begun, d)
    return Fit(steps, miss(now))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], p: Params = Params(), labelled_docs: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", budget: float | str | None = None, out: str = "mix") -> DataFrame:
    """docs with a struct column ``out``: tokens, domains, posterior, rate, copies and miss.

    labelled is (doc_id, domain). Tokens are words. copies is the rate rounded up or down by a hash of id and text, so that its mean is
    the rate, the same at each run. miss is the greatest relative miss of a target, the same in every row: more than the tolerance
    where the targets can't be met. Domains without a target get target 0. All columns and rows of docs are kept; a column named like
    ``out`` is an error. The texts are read twice: for the fit, which keeps tokens and posteriors in the shared folder, and for
    the result; nothing is joined by id.
    """
    refuse(docs, out)
    model = fit_classifier(labelled_sample(docs if labelled_docs is None else labelled_docs, labelled, p, doc_id, text), p)
    bounded_batches(docs.sparkSession)
    tokens = F.size(words(F.col(text))).cast("long")

    def soft(fitted: Fit) -> Column:
        @F.pandas_udf("struct<posterior array<double>, rate double>")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in batches:
                q = np.array([model.posterior(t) for t in texts]).reshape(len(texts), -1)
                yield pd.DataFrame({"posterior": list(q), "rate": rates(q, fitted.steps)[0]})

        return of(F.col(text))

    if model.domains:
        kept = docs.select(tokens.alias("tokens"), soft(Fit([], 0.0))["posterior"].alias("posterior"))
        fitted = fit_rates(kept, [targets.get(k, 0.0) for k in model.domains], p, budget=budget)
        rated = soft(fitted)
    else:
        fitted = Fit([], 0.0)
        rated = F.struct(F.array().cast("array<double>").alias("posterior"), F.lit(1.0).alias("rate"))
    r, n = fresh(docs, "rated_", "tokens_")
    chance = F.pmod(F.xxhash64(F.lit("copies"), F.col(doc_id), F.col(text)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = F.col(f"{r}.rate")
    copies = (F.floor(rate) + (chance < rate - F.floor(rate)).cast("int")).cast("long")
    return docs.withColumn(n, tokens).withColumn(r, rated).withColumn(out, F.struct(F.col(n).alias("tokens"), F.lit(model.domains).cast("array<string>").alias("domains"), F.col(f"{r}.posterior"), rate.alias("rate"), copies.alias("copies"), F.lit(fitted.miss).alias("miss"))).drop(n, r)
