"""Gradient-boosted trees as Spark ML's ``GBTClassifier`` fits them, from packed columns.

The model is the estimator's: its candidate cuts, the columns that it draws for a node, variance as
impurity, log-loss residuals, means in the leaves. Only the passes differ. A row's bins are packed in a few
12-bit codes, rows lie in blocks, and a pass sums the residuals of a block's codes by node and code with
numpy; sums of single columns follow from those of codes. A row takes 2 bytes a code, a label and its margin.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from ..spec import RANDOM_SEED

BLOCK = 1 << 15
#: Bits of a code. A column of 32 bins takes 5.
BITS = 12
BINS = 32
#: Spark ML looks for cuts in a sample of about this many rows.
CUT_ROWS = 10_000
#: Trees between two states that are made from the table itself, so that lineage stays short.
FRESH = 50
DEEPEST = 7
#: Up to this many partitions hand their sums (one array of open nodes, columns and bins each) straight to the driver.
DIRECT = 64


@dataclass
class BoostedTree:
    """Nodes numbered as in a heap (children of i: 2i + 1, 2i + 2): (column, bin) of splits, values of leaves."""

    split: dict[int, tuple[int, int]] = field(default_factory=dict)
    value: dict[int, float] = field(default_factory=dict)

    def node_of(self, bins: Callable[[int], np.ndarray], n: int) -> np.ndarray:
        """The node that each of ``n`` rows has reached; ``bins`` gives a column's."""
        at = np.zeros(n, np.int16)
        for i, (c, cut) in sorted(self.split.items()):
            at = np.where(at == i, (bins(c) > cut).astype(np.int16) + np.int16(2 * i + 1), at)
        return at

    def values(self, bins: Callable[[int], np.ndarray], n: int) -> np.ndarray:
        by_node = np.zeros(1 + max(self.value))
        by_node[list(self.value)] = list(self.value.values())
        return by_node[self.node_of(bins, n)]


@dataclass
class BoostedModel:
    """Fitted trees over named columns; adds the columns that a fitted ``GBTClassifier`` adds."""

    features: list[str]
    cuts: list[list[float]]
    rate: float
    trees: list[BoostedTree]

    def margin(self) -> Column:
        def of(*columns: pa.Array) -> pa.Array:
            bins = [_binned(c, e) for c, e in zip(columns, self.cuts)]
            out = np.zeros(len(columns[0]))
            for k, t in enumerate(self.trees):
                out += _weight(k, self.rate) * t.values(bins.__getitem__, len(out))
            return pa.array(out)

        return F.arrow_udf(of, "double")(*[F.col(c).cast("double") for c in self.features])

    def transform(self, df: DataFrame) -> DataFrame:
        out = df.withColumn("__margin", self.margin())
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(2.0) * F.col("__margin")))
        out = out.withColumns({"probability": array_to_vector(F.array(p, F.lit(1.0) - p)), "prediction": (F.col("__margin") > 0).cast("double")})
        return out.drop("__margin")


def fit(df: DataFrame, features: Sequence[str], trees: int, depth: int, rate: float, columns: float = 1.0, label: str = "label") -> BoostedModel:
    """``columns`` is the share of columns drawn for a node. Labels are 0 or 1; a column without a value raises."""
    if not 1 <= depth <= DEEPEST:
        raise ValueError(f"depth {depth} is not between 1 and {DEEPEST}")
    features, d = list(features), len(features)
    data = df.select(F.col(label).cast("double").alias("y"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    model = BoostedModel(features, find_cuts(data), rate, [])
    places, n_codes = _packed([len(c) + 1 for c in model.cuts])
    per_node = int(np.ceil(columns * d)) if columns < 1 else d
    blocks = written(data.mapInArrow(_pack(model.cuts, places, n_codes), "n int, y binary, codes binary"), "blocks")
    # a block a batch, so that the margins of a block can be zipped to it
    table = _kept(blocks.rdd.map(lambda r: (np.frombuffer(r["codes"], np.uint16).reshape(n_codes, r["n"]), np.frombuffer(r["y"], np.int8))))
    state, margins, before = table.map(lambda block: (block, None)), None, None
    steps = 1 if table.getNumPartitions() <= DIRECT else 2
    counts = None  # rows by column and bin at the root, the same for every tree
    for k in range(trees):
        tree, drawn, open_nodes = BoostedTree(), _JavaRandom(RANDOM_SEED + k), [0]
        for level in range(depth):
            counting = level > 0 or counts is None
            sums, squares = state.mapPartitions(_sums(tree, open_nodes, places, n_codes, counting)).treeReduce(lambda a, b: (a[0] + b[0], a[1] + b[1]), steps)
            if before is not None:  # the new margins are made by now
                before = before.unpersist() and None
            if level == 0:
                counts = sums[0, :, :, 0].copy() if counting else counts
                sums[0, :, :, 0] = counts
            split = []
            for slot, node in enumerate(open_nodes):
                n, s = sums[slot, 0].sum(0).tolist()
                tree.value.setdefault(node, s / n)
                if level and abs((squares[slot] - s * s / n) / n) < np.finfo(float).eps:
                    continue
                order = _reservoir(d, per_node, drawn.next_long()) if per_node < d else range(d)
                best = _best(sums[slot], n, s, [(c, len(model.cuts[c])) for c in order])
                if best is None:
                    continue
                c, cut, (nl, sl) = best
                tree.split[node] = c, cut
                tree.value[2 * node + 1], tree.value[2 * node + 2] = sl / nl, (s - sl) / (n - nl)
                split.append(node)
            # the estimator takes open nodes from a stack: the last split's right child comes first
            open_nodes = [child for node in reversed(split) for child in (2 * node + 2, 2 * node + 1)]
            if not open_nodes:
                break
        model.trees.append(tree)
        if k + 1 < trees:
            before = margins
            if margins is None or (k + 1) % FRESH == 0:
                margins = _kept(table.map(lambda block: (block, None)).map(_grown(list(model.trees), 0, rate, places)))
            else:
                margins = _kept(state.map(_grown([tree], k, rate, places)))
            state = table.zip(margins)
    for kept in (table, margins, before):
        if kept is not None:
            kept.unpersist()
    return model


def _kept(blocks: RDD) -> RDD:
    return blocks._reserialize(BatchedSerializer(CPickleSerializer(), 1)).persist(StorageLevel.MEMORY_AND_DISK)


def _weight(k: int, rate: float) -> float:
    return rate if k else 1.0


def _binned(x: pa.Array, cuts: Sequence[float]) -> np.ndarray:
    v = x.to_numpy(zero_copy_only=False)
    if np.isnan(v).any():
        raise ValueError("a feature is missing: impute before fitting")
    if len(cuts) <= 2:
        return sum(((v > c).astype(np.uint16) for c in cuts), np.zeros(len(v), np.uint16))
    return np.searchsorted(np.array(cuts), v, "left").astype(np.uint16)


def find_cuts(data: DataFrame) -> list[list[float]]:
    """About 31 cuts per column of ``(y, x0, ...)``, by the estimator's rule from its sample of about
    10 000 rows: between all neighbours if there are few values, else where running counts come nearest to equal shares."""
    n, d = data.count(), len(data.columns) - 1
    if not n:
        raise ValueError("no rows to fit on")
    share = min(1.0, CUT_ROWS / n)
    sample = data.drop("y")
    if share < 1:
        spark = data.sparkSession
        drawn = sample._jdf.javaRDD().sample(False, share, _XorShift(RANDOM_SEED).next(32))  # JavaRDD.sample, as the estimator's
        sample = DataFrame(spark._jsparkSession.createDataFrame(drawn, sample._jdf.schema()), spark)
    rows = np.array(sample.collect(), float).reshape(-1, d)  # about CUT_ROWS rows
    if np.isnan(rows).any():
        raise ValueError("a feature is missing: impute before fitting")
    wanted = share * n
    return [_cuts(rows[:, i], wanted, min(BINS, n) - 1) for i in range(d)]


def _cuts(x: np.ndarray, wanted: float, n_cuts: int) -> list[float]:
    values, counts = np.unique(x[x != 0], return_counts=True)
    counts = counts.astype(float)
    if not len(values):
        return []
    zeros = wanted - counts.sum()  # the expected rows of the sample, less those with another value
    if zeros > np.finfo(float).eps * counts.sum() * 100:
        at = int(np.searchsorted(values, 0.0))
        values, counts = np.insert(values, at, 0.0), np.insert(counts, at, zeros)
    between = (values[:-1] + values[1:]) / 2
    if len(between) <= n_cuts:
        return between.tolist()
    stride, out, count = wanted / (n_cuts + 1), [], counts[0]
    target = stride
    for i in range(1, len(values)):
        previous, count = count, count + counts[i]
        if abs(previous - target) < abs(count - target):
            out.append(float(between[i - 1]))
            target += stride
    return out


def _packed(n_bins: Sequence[int]) -> tuple[list[tuple[int, int, int]], int]:
    """(code, shift, bits) of each column, widest first into the first code with room; number of codes."""
    bits = [max(1, (n - 1).bit_length()) for n in n_bins]
    used: list[int] = []
    places: list[tuple[int, int, int]] = [(0, 0, 0)] * len(bits)
    for c in sorted(range(len(bits)), key=lambda c: -bits[c]):
        at = next((j for j, u in enumerate(used) if u + bits[c] <= BITS), len(used))
        if at == len(used):
            used.append(0)
        places[c] = at, used[at], bits[c]
        used[at] += bits[c]
    return places, len(used)


def _pack(cuts: Sequence[Sequence[float]], places: Sequence[tuple[int, int, int]], n_codes: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            y, codes = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held], axis=1)
            held.clear()
            return pa.RecordBatch.from_pydict({"n": pa.array([len(y)], pa.int32()), "y": [y.tobytes()], "codes": [codes.tobytes()]})

        for b in batches:
            y = b.column(0).to_numpy(zero_copy_only=False)
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("a label is neither 0 nor 1")
            codes = np.zeros((n_codes, b.num_rows), np.uint16)
            for c, (code, shift, _) in enumerate(places):
                codes[code] |= _binned(b.column(c + 1), cuts[c]) << np.uint16(shift)
            held.append(((2 * y - 1).astype(np.int8), codes))
            if sum(len(h[0]) for h in held) >= BLOCK:
                yield block()
        if sum(len(h[0]) for h in held):
            yield block()

    return pack


def _bins_of(codes: np.ndarray, places: Sequence[tuple[int, int, int]]) -> Callable[[int], np.ndarray]:
    def bins(c: int) -> np.ndarray:
        code, shift, bits = places[c]
        return (codes[code] >> np.uint16(shift)) & np.uint16((1 << bits) - 1)

    return bins


def _grown(trees: Sequence[BoostedTree], first: int, rate: float, places: Sequence[tuple[int, int, int]]):
    """A block's margins with those that ``trees`` add; ``first`` is the number of the first."""
    def grown(state) -> np.ndarray:
        (codes, y), margin = state
        margin = np.zeros(len(y)) if margin is None else margin.copy()
        for k, t in enumerate(trees, first):
            margin += _weight(k, rate) * t.values(_bins_of(codes, places), len(y))
        return margin

    return grown


def _sums(tree: BoostedTree, open_nodes: Sequence[int], places: Sequence[tuple[int, int, int]], n_codes: int, counting: bool = True):
    """A partition's (rows if ``counting``, residuals) by open node, column and bin, and the sums of squared residuals by open node."""
    slots, width = len(open_nodes), 1 << BITS
    wide = 1 << max(bits for *_, bits in places)
    slot_of = np.full(1 + max(open_nodes + [2 * i + 2 for i in tree.split]), slots, np.int64)  # the last: rows of no open node
    slot_of[open_nodes] = range(slots)

    def sums(blocks: Iterator[Any]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        total, squares = np.zeros((n_codes, 2, (slots + 1) * width)), np.zeros(slots + 1)
        for (codes, y), margin in blocks:
            r = y.astype(float) if margin is None else 4.0 * y / (1.0 + np.exp(2.0 * y * margin))
            slot = slot_of[tree.node_of(_bins_of(codes, places), len(y))]
            squares += np.bincount(slot, r * r, slots + 1)
            start, cell = slot * width, np.empty(len(y), np.int64)
            for j in range(n_codes):
                cell[:] = codes[j]
                cell += start
                if counting:
                    total[j, 0] += np.bincount(cell, minlength=(slots + 1) * width)
                total[j, 1] += np.bincount(cell, r, (slots + 1) * width)
        out = np.zeros((slots, len(places), wide, 2))
        for c, (code, shift, bits) in enumerate(places):
            for q in range(2):
                cells = total[code, q].reshape(slots + 1, 1 << (BITS - shift - bits), 1 << bits, 1 << shift)[:slots]
                out[:, c, : 1 << bits, q] = cells.sum((1, 3))
        yield out, squares[:slots]

    return sums


def _best(sums: np.ndarray, n: float, s: float, columns: Sequence[tuple[int, int]]) -> tuple[int, int, tuple[float, float]] | None:
    """(column, bin, (rows, residuals) on the left) of the largest fall of variance, the first on a tie."""
    best, gain = None, 0.0
    for c, n_cuts in columns:
        if not n_cuts:
            continue
        nl, sl = np.cumsum(sums[c, :n_cuts], axis=0).T
        nr, sr = n - nl, s - sl
        fit_ = (nl >= 1) & (nr >= 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            gains = np.where(fit_, (sl * sl / nl + sr * sr / nr - s * s / n) / n, -np.inf)
        at = int(gains.argmax())
        if gains[at] > gain:
            best, gain = (c, at, (float(nl[at]), float(sl[at]))), gains[at]
    return best


# ---------------------------------------------------------------------------
# The estimator's random numbers, so that a node draws the columns that it would draw there
# ---------------------------------------------------------------------------

_U64 = (1 << 64) - 1


def _signed(x: int, bits: int) -> int:
    x &= (1 << bits) - 1
    return x - (1 << bits) if x >> (bits - 1) else x


class _JavaRandom:
    """``java.util.Random``."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def next(self, bits: int) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        return _signed(self.state >> (48 - bits), 32)

    def next_long(self) -> int:
        return _signed((self.next(32) << 32) + self.next(32), 64)


class _XorShift:
    """Spark's seeded generator."""

    def __init__(self, seed: int):
        data = (seed & _U64).to_bytes(8, "big")
        low = _murmur(data, 0x3C074A61)
        self.state = _murmur(data, low) << 32 | low

    def next(self, bits: int) -> int:
        x = self.state
        x ^= x << 21 & _U64
        x ^= x >> 35
        x ^= x << 4 & _U64
        self.state = x
        return _signed(x & ((1 << bits) - 1), 32)

    def next_double(self) -> float:
        return ((self.next(26) << 27) + self.next(27)) * 2.0**-53


def _murmur(data: bytes, seed: int) -> int:
    h, m = seed, 0xFFFFFFFF
    rot = lambda x, k: (x << k | x >> (32 - k)) & m
    for i in range(0, len(data), 4):
        h = (rot(h ^ rot(int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & m, 15) * 0x1B873593 & m, 13) * 5 + 0xE6546B64) & m
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & m
    h = (h ^ h >> 13) * 0xC2B2AE35 & m
    return h ^ h >> 16


def _reservoir(d: int, k: int, seed: int) -> list[int]:
    """``k`` of ``d`` columns, in the order in which the estimator tries them."""
    out, rng = list(range(k)), _XorShift(seed)
    for c in range(k, d):
        at = int(rng.next_double() * (c + 1))
        if at < k:
            out[at] = c
    return out
