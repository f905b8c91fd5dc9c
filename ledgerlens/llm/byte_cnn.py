"""Quality by a byte-level convolutional network in numpy.

Bytes are embedded, filters of ``width`` bytes slide over the text at steps of ``stride``, and each filter's response is max-pooled
in overlapping chunks that cover the whole text, whatever its length. The means and the maxima over the chunks make
one probability by a logistic head. All weights are learned from labelled texts on the driver, from a bounded sample.

Defined results: null and empty texts count as one chunk of padding; texts are read whole, in segments, so that memory does not
grow with their length; with labels of one kind only, every score is the share of that label.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches
from .labelled import sample


@dataclass(frozen=True)
class Params:
    max_labelled: int = 3000  # of each label: the bound of the sample for fitting
    width: int = 8
    stride: int = 2
    embed: int = 4
    filters: int = 24
    block: int = 32  # positions; a chunk is ``span`` blocks, the next starts ``step`` blocks later
    span: int = 4
    step: int = 2
    segment: int = 1024  # blocks read at once
    chunks: int = 8  # of each text at each training step
    batch: int = 64
    steps: int = 900
    rate: float = 0.01
    seed: int = 7


@dataclass
class Network:
    table: np.ndarray  # 256 x embed
    kernel: np.ndarray  # width * embed x filters
    bias: np.ndarray
    head: np.ndarray  # means, then maxima
    offset: float
    p: Params

    def blocks(self, data: np.ndarray) -> np.ndarray:
        """Greatest response of each filter in each block of positions, for the padded bytes of one text."""
        p = self.p
        size = p.block * p.stride
        n = max(1, -(-len(data) // size))
        padded = np.zeros(n * size + p.width, dtype=np.uint8)
        padded[: len(data)] = data
        out = np.empty((n, p.filters), dtype=np.float32)
        for a in range(0, n, p.segment):
            b = min(n, a + p.segment)
            vectors = self.table[padded[a * size : b * size + p.width]]
            windows = np.lib.stride_tricks.as_strided(vectors, ((b - a) * p.block, p.width * p.embed), (vectors.strides[0] * p.stride, vectors.strides[1]))
            out[a:b] = (np.ascontiguousarray(windows) @ self.kernel).reshape(b - a, p.block, p.filters).max(axis=1)
        return np.maximum(out + self.bias, 0)

    def chunks(self, blocks: np.ndarray) -> np.ndarray:
        """Greatest response in each overlapping chunk; the last chunk ends with the text."""
        p, n = self.p, len(blocks)
        starts = list(range(0, max(n - p.span, 0) + 1, p.step))
        if starts[-1] + p.span < n:
            starts.append(n - p.span)
        rows = np.minimum(np.array(starts)[:, None] + np.arange(p.span), n - 1)
        return blocks[rows].max(axis=1)

    def probability(self, text: str | None) -> float:
        pooled = self.chunks(self.blocks(np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)))
        z = float(np.concatenate((pooled.mean(axis=0), pooled.max(axis=0))) @ self.head) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(texts: list[tuple[str, int]], p: Params = Params()) -> Network:
    """Adam on the log loss; each step draws as many texts of both labels, and chunks anywhere in them."""
    rng = np.random.default_rng(p.seed)
    shape = p.width * p.embed
    net = Network(rng.normal(0, 0.5, (256, p.embed)).astype(np.float32), rng.normal(0, shape**-0.5, (shape, p.filters)).astype(np.float32), np.zeros(p.filters, np.float32), rng.normal(0, 0.1, 2 * p.filters).astype(np.float32), 0.0, p)
    size = p.block * p.stride * p.span
    data, kinds = [], [[], []]
    for text, label in texts:
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        kinds[label].append(len(data))
        data.append(np.concatenate((raw, np.zeros(max(p.width, size + p.width - len(raw)), np.uint8))))
    if not kinds[0] or not kinds[1]:
        net.head[:], net.offset = 0, 30.0 if kinds[1] else -30.0
        return net
    offset = np.zeros(1, np.float32)
    weights = [net.table, net.kernel, net.bias, net.head, offset]
    means, squares = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    positions = p.block * p.span
    reach = np.arange(positions)[:, None] * p.stride + np.arange(p.width)
    for t in range(1, p.steps + 1):
        picks = np.concatenate([rng.choice(k, p.batch // 2) for k in kinds])
        y = (np.arange(len(picks)) >= p.batch // 2).astype(np.float32)
        pieces = np.stack([data[i][s : s + size + p.width] for i in picks for s in rng.integers(0, len(data[i]) - size - p.width + 1, p.chunks)])
        windows = pieces[:, reach]  # chunk, position, byte
        x = net.table[windows].reshape(len(pieces), positions, shape)
        raw = x @ net.kernel
        at = raw.argmax(axis=1)
        top = np.take_along_axis(raw, at[:, None, :], axis=1)[:, 0] + net.bias
        pooled = np.maximum(top, 0).reshape(len(picks), p.chunks, p.filters)
        which = pooled.argmax(axis=1)
        features = np.concatenate((pooled.mean(axis=1), pooled.max(axis=1)), axis=1)
        error = 1 / (1 + np.exp(-np.clip(features @ net.head + offset[0], -30, 30))) - y
        error = (error / len(picks)).astype(np.float32)
        back = np.repeat((error[:, None] * net.head[: p.filters] / p.chunks)[:, None, :], p.chunks, axis=1)
        np.put_along_axis(back, which[:, None, :], np.take_along_axis(back, which[:, None, :], axis=1) + (error[:, None] * net.head[p.filters :])[:, None, :], axis=1)
        back = back.reshape(len(pieces), p.filters) * (top > 0)
        chosen = x[np.arange(len(pieces))[:, None], at]  # chunk, filter, shape
        grads = [np.zeros_like(net.table), np.einsum("cf,cfs->sf", back, chosen), back.sum(axis=0), features.T @ error, np.array([error.sum()], np.float32)]
        to_bytes = (back[:, :, None] * net.kernel.T[None]).reshape(-1, p.width, p.embed)
        np.add.at(grads[0], windows[np.arange(len(pieces))[:, None], at].reshape(-1, p.width), to_bytes)
        rate = p.rate * min(1.0, 2 * (1 - t / (p.steps + 1)))
        for w, g, m, v in zip(weights, grads, means, squares, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    net.offset = float(offset[0])
    return net


def score(docs: DataFrame, net: Network, text: str = "text", out: str = "score") -> DataFrame:
    """docs with the probability of label 1 for each whole text."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([net.probability(t) for t in texts], dtype="float64")

    return docs.withColumn(out, of(F.col(text)))


def quality(docs: DataFrame, labels: DataFrame, labelled_docs: DataFrame | None = None, p: Params = Params(), text: str = "text", out: str = "score") -> DataFrame:
    """Fit on a bounded sample of the labelled rows of labelled_docs (or docs) that aren't held out, then score all of docs."""
    return score(docs, fit(sample(docs if labelled_docs is None else labelled_docs, labels, "quality", p.max_labelled), p), text, out)
