"""Variable-capacity best-fit packing of token sequences.

Texts longer than the largest permitted sequence length are cut into pieces of that length and a rest; the pieces are packed, the longest first, each
into the open bin with the least room that fits it. Where none fits, a bin is opened whose size costs least for what it would hold: for
each permitted size the bin is filled, on paper, from the pieces still to come, and the cost of the size is divided by the tokens in it.
So the sizes are chosen jointly with what is left to pack. In the end every bin is cut down to the smallest permitted size that holds
its contents.

Best fit looks at lengths only. So the executors count pieces by length (at most ``max length`` counts, whatever the number of texts), the
driver packs these counts, many equal bins at a time, and the executors find each piece's bin from its length and its number among
the pieces of that length. The result is that of packing all pieces in one process.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, words
from .ranks import numbered


@dataclass(frozen=True)
class Params:
    sizes: tuple[int, ...] = (512, 1024, 2048, 4096)
    fixed: float = 64.0  # cost of a bin, in tokens
    square: float = 1 / 16384  # cost of attention: times the square of the size

    def cost(self, size: int) -> float:
        return self.fixed + size + self.square * size * size

    def downsized(self, used: int) -> int:
        return min(s for s in self.sizes if s >= used)


@dataclass
class Plan:
    """Runs of pieces: pieces start .. stop - 1 of a length go to bins first, first + 1 .., ``each`` pieces to a bin; and the runs of bins."""

    runs: list[tuple[int, int, int, int, int]]  # length, start, stop, first bin, each
    bins: list[tuple[int, int, int]]  # first bin, how many, tokens in each


def _best_size(length: int, left: np.ndarray, p: Params) -> int:
    """Permitted size of least cost for a token held, when a bin opened for a piece of this length is filled from the counts left."""
    best, choice = np.inf, 0
    lengths = np.flatnonzero(left)
    for size in p.sizes:
        if size < length:
            continue
        room, taken = size - length, {}
        while room > 0:
            # The longest piece that still fits, as often as it does.
            i = int(np.searchsorted(lengths, room, side="right")) - 1
            while i >= 0 and left[lengths[i]] - taken.get(i, 0) - (lengths[i] == length) <= 0:
                i -= 1
            if i < 0:
                break
            k = int(min(room // lengths[i], left[lengths[i]] - taken.get(i, 0) - (lengths[i] == length)))
            taken[i] = taken.get(i, 0) + k
            room -= k * int(lengths[i])
        used = size - room
        # What is not used is cut off in the end.
        price = p.cost(p.downsized(used)) / used
        if price < best - 1e-12:
            best, choice = price, size
    return choice


def plan(counts: dict[int, int], p: Params = Params()) -> Plan:
    """Pack counts of pieces by length. Work and result grow with the number of lengths, and with the logarithm of the counts."""
    left = np.zeros(max(p.sizes) + 1, dtype=np.int64)
    for length, n in counts.items():
        if not 0 < length <= max(p.sizes):
            raise ValueError(f"length {length} is not within 1 to {max(p.sizes)}")
        left[length] += n
    groups: dict[int, list[list[int]]] = {}  # room -> runs of bins [first, how many, tokens]
    rooms: list[int] = []
    closed: list[list[int]] = []
    runs: list[tuple[int, int, int, int, int]] = []
    n_bins = 0

    def keep(first: int, n: int, used: int, room: int) -> None:
        if n and room:
            if room not in groups:
                bisect.insort(rooms, room)
            groups.setdefault(room, []).append([first, n, used])
        elif n:
            closed.append([first, n, used])

    for length in range(max(p.sizes), 0, -1):
        n, at = int(left[length]), 0
        while at < n:
            left[length] = n - at
            i = bisect.bisect_left(rooms, length)
            if i == len(rooms):
                size = _best_size(length, left, p)
                each = max(1, size // length)
                # Several bins of this size at once, but no more than a share of what is left, as the best size may change.
                more = max(1, (n - at) // each // 8) if (n - at) >= each else 1
                keep(n_bins, more, 0, size)
                n_bins += more
                continue
            room = rooms[i]
            first, many, used = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(i)
            # A bin that takes one piece has less room than its like, so it is the best fit for the next too, while that fits.
            each = room // length
            full = min(many, (n - at) // each)
            if full:
                runs.append((length, at, at + full * each, first, each))
                keep(first, full, used + each * length, room - each * length)
                at += full * each
            if full < many:
                rest = n - at if (n - at) < each else 0
                if rest:
                    runs.append((length, at, n, first + full, rest))
                    keep(first + full, 1, used + rest * length, room - rest * length)
                    at = n
                keep(first + full + (rest > 0), many - full - (rest > 0), used, room)
        left[length] = 0
    return Plan(runs, [tuple(x) for x in closed + [g for gs in groups.values() for g in gs] if x[2]])


def pieces(docs: DataFrame, length: str, p: Params = Params()) -> DataFrame:
    """docs with one row for each piece: piece (0, 1 ..), start and piece_len. Texts without tokens have one piece of length 0."""
    most = max(p.sizes)
    n = F.coalesce(F.col(length), F.lit(0)).cast("long")
    made = docs.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.floor((n - 1) / most), F.lit(0)).cast("long"))))
    return made.withColumn("start", F.col("piece") * most).withColumn("piece_len", F.least(n - F.col("start"), F.lit(most)).cast("long"))


def pack(docs: DataFrame, p: Params = Params(), doc_id: str = "doc_id", text: str = "text", length: str | None = None) -> DataFrame:
    """(doc_id, piece, start, piece_len, bin_id, bin_size, bin_used, bin_offset) for every piece of every row of docs.

    Lengths are words of the whole text, or the column ``length``. bin_size is the permitted size after cutting down, bin_used the
    tokens in the bin, bin_offset the piece's place in it. A null or empty text has one piece of length 0 in no bin (null bin). Repeated rows are
    packed one by one; equal rows may swap places. An empty table gives an empty result. Other columns are not read.
    """
    n = F.size(words(F.col(text))).cast("long") if length is None else F.greatest(F.coalesce(F.col(length).cast("long"), F.lit(0)), F.lit(0))
    tie = F.xxhash64(F.col(text)) if length is None else F.lit(0).cast("long")
    rows = cut(pieces(docs.select(F.col(doc_id).alias("doc_id"), n.alias("n"), tie.alias("tie")), "n", p))
    counts = {r["piece_len"]: r["count"] for r in rows.where("piece_len > 0").groupBy("piece_len").count().collect()}
    made = plan(counts, p)
    runs = sorted(made.runs)
    keys = np.array([r[0] for r in runs], dtype=np.int64) * (1 << 42) + np.array([r[1] for r in runs], dtype=np.int64)
    table = np.array(runs, dtype=np.int64).reshape(-1, 5)
    bins = np.array(sorted(made.bins), dtype=np.int64).reshape(-1, 3)
    offsets = _offsets(runs, made.bins)

    @F.pandas_udf("struct<bin_id long, bin_size long, bin_used long, bin_offset long>")
    def bin_of(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(keys, lengths.to_numpy() * (1 << 42) + numbers.to_numpy(), side="right") - 1
        run = table[at]
        nth = numbers.to_numpy() - run[:, 1]
        bin_id = run[:, 3] + nth // run[:, 4]
        used = bins[np.searchsorted(bins[:, 0], bin_id, side="right") - 1, 2]
        before = offsets[at] + nth % run[:, 4] * run[:, 0]
        return pd.DataFrame({"bin_id": bin_id, "bin_size": np.array(sorted(p.sizes))[np.searchsorted(sorted(p.sizes), used)], "bin_used": used, "bin_offset": before})

    real = numbered(rows.where("piece_len > 0"), ["piece_len"], [F.col("doc_id"), F.col("piece"), F.col("tie")], "number")
    packed = real.withColumn("b", bin_of("piece_len", "number")).select("doc_id", "piece", "start", "piece_len", "b.*")
    none = [F.lit(None).cast("long").alias(c) for c in ("bin_id", "bin_size", "bin_used", "bin_offset")]
    return packed.unionByName(rows.where("piece_len = 0").select("doc_id", "piece", "start", "piece_len", *none))


def _offsets(runs: list[tuple], bins: list[tuple]) -> np.ndarray:
    """Tokens that lie before the first piece of each run, in each of the run's bins: what longer pieces have filled."""
    out = np.zeros(len(runs), dtype=np.int64)
    # Runs of bins are only ever split; walk the runs from long to short and keep the filling of each stretch of bins.
    edges = sorted({b for r in runs for b in (r[3], r[3] + -(-(r[2] - r[1]) // r[4]))} | {b for x in bins for b in (x[0], x[0] + x[1])})
    filled = np.zeros(max(len(edges), 1), dtype=np.int64)
    for k in sorted(range(len(runs)), key=lambda k: (-runs[k][0], runs[k][1])):
        length, start, stop, first, each = runs[k]
        a, b = bisect.bisect_left(edges, first), bisect.bisect_left(edges, first + -(-(stop - start) // each))
        out[k] = filled[a]
        filled[a:b] += length * each
    return out
