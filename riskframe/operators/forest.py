"""Random forest over packed blocks of rows, for trees up to a bounded depth.

As Spark ML's ``RandomForestClassifier``: cuts by its rule, draws with replacement (Poisson with mean 1),
about sqrt(d) columns drawn for each node, weighted Gini impurity, leaves of siblings that predict alike
merged, the mean of the trees' leaf shares as probability. It keeps 300 draws of 4 bytes and 300 nodes
with every row; here a row takes a byte a column (its bin and the label), and 2 bytes for each tree of the group that is grown at
the time. Draws are made again from the block and the tree whenever they are needed. A pass sums the
weights of a level's open nodes by column, bin and label; the driver picks the splits.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass
from typing import Any, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from ..spec import RANDOM_SEED
from .boosting import DIRECT, _binned, _kept, find_cuts

BLOCK = 1 << 16
DEEPEST = 15
#: Bytes of all rows' nodes in the trees of a group, and of sums that a task holds in a pass.
STATE, HELD = 1 << 28, 8 << 20
#: Node of a row that isn't drawn or lies in a leaf.
CLOSED = 0xFFFF
#: Number of draws by a uniform 16-bit number.
_DRAWS = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(8)]), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


class ForestTree:
    """Nodes as arrays, children next to each other; a leaf is its own child and holds label 1's share of the weight."""

    def __init__(self, share: float):
        self.column, self.cut, self.left, self.share = [0], [255], [0], [share]

    def split(self, node: int, column: int, cut: int, shares: tuple[float, float]) -> int:
        a = len(self.column)
        self.column[node], self.cut[node], self.left[node] = column, cut, a
        for k, s in enumerate(shares):
            self.column.append(0)
            self.cut.append(255)
            self.left.append(a + k)
            self.share.append(s)
        return a

    def merge(self) -> None:
        """Siblings that are leaves and predict the same label go, from the bottom up."""
        for node in range(len(self.left) - 1, -1, -1):
            a = self.left[node]
            if a != node and self.left[a] == a and self.left[a + 1] == a + 1 and (self.share[a] > 0.5) == (self.share[a + 1] > 0.5):
                self.column[node], self.cut[node], self.left[node] = 0, 255, node

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.column, np.int64), np.array(self.cut, np.uint8), np.array(self.left, np.int64), np.array(self.share)


@dataclass
class ForestModel:
    """Fitted trees over named columns; adds the columns that a fitted ``RandomForestClassifier`` adds to score with."""

    features: list[str]
    cuts: list[list[float]]
    depth: int
    trees: list[ForestTree]

    def probabilities(self, bins: np.ndarray, trees: Sequence[tuple[np.ndarray, ...]]) -> np.ndarray:
        """Of rows of bins, one after another."""
        flat, begin = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
        out = np.zeros(len(bins))
        for column, cut, left, share in trees:
            at = np.zeros(len(bins), np.int64)
            for _ in range(self.depth):
                at = left[at] + (flat[begin + column[at]] > cut[at])
            out += share[at]
        return out / len(trees)

    def transform(self, df: DataFrame) -> DataFrame:
        trees = [t.arrays() for t in self.trees]

        def of(*columns: pa.Array) -> pa.Array:
            return pa.array(self.probabilities(np.column_stack([_binned(c, e) for c, e in zip(columns, self.cuts)]).astype(np.uint8), trees))

        out = df.withColumn("__p", F.arrow_udf(of, "double")(*[F.col(c).cast("double") for c in self.features]))
        p = F.col("__p")
        return out.withColumns({"probability": array_to_vector(F.array(F.lit(1.0) - p, p)), "prediction": (p > 0.5).cast("double")}).drop("__p")


def fit(df: DataFrame, features: Sequence[str], trees: int, depth: int, min_leaf: int = 1, label: str = "label", weight: str | None = None) -> ForestModel:
    """Labels are 0 or 1, weights not below 0; a column without a value raises."""
    if not 1 <= depth <= DEEPEST:
        raise ValueError(f"depth {depth} is not between 1 and {DEEPEST}")
    features, d = list(features), len(features)
    x = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    cuts = find_cuts(df.select(F.col(label).cast("double").alias("y"), *x))
    rows = df.select(F.col(label).cast("double").alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"), *x)
    blocks = written(rows.mapInArrow(_pack(cuts), "n int, y binary, w binary, bins binary"), "forest-blocks").rdd
    blocks = blocks.coalesce(max(1, min(blocks.getNumPartitions(), 2 * df.sparkSession.sparkContext.defaultParallelism)))
    table = _kept(blocks.map(lambda r: (np.frombuffer(r["bins"], np.uint8), np.frombuffer(r["y"], np.int8), np.frombuffer(r["w"]), zlib.crc32(r["bins"], zlib.crc32(r["y"])))))
    n, weights = table.map(lambda b: (len(b[1]), np.bincount(b[1], b[2], 2))).reduce(lambda a, b: (a[0] + b[0], a[1] + b[1]))
    group = max(1, min(trees, STATE // (2 * n)))
    out: list[ForestTree] = []
    for first in range(0, trees, group):
        out += _grow(table, range(first, min(trees, first + group)), depth, min_leaf, [len(c) + 1 for c in cuts], d)
    table.unpersist()
    return ForestModel(features, cuts, depth, out)


def _pack(cuts: Sequence[Sequence[float]]):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def block() -> pa.RecordBatch:
            y, w, bins = (np.concatenate(p) for p in zip(*held))
            held.clear()
            return pa.RecordBatch.from_pydict({"n": pa.array([len(y)], pa.int32()), "y": [y.tobytes()], "w": [w.tobytes()], "bins": [bins.tobytes()]})

        for b in batches:
            y, w = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("a label is neither 0 nor 1")
            if not (w >= 0).all():
                raise ValueError("a weight is missing or below 0")
            # twice the bin and the label: a cell of the sums
            held.append((y.astype(np.int8), w, np.column_stack([2 * _binned(b.column(i + 2), c) + y for i, c in enumerate(cuts)]).astype(np.uint8)))
            if sum(len(h[0]) for h in held) >= BLOCK:
                yield block()
        if sum(len(h[0]) for h in held):
            yield block()

    return pack


def _drawn(tree: int, block: tuple) -> np.ndarray:
    """How often each row of a block is drawn for a tree: the same whenever the block is read."""
    return _DRAWS[np.random.Generator(np.random.SFC64([RANDOM_SEED, tree, block[3]])).integers(0, 1 << 16, len(block[1]), np.uint16)]


@dataclass
class _Open:
    """A tree's open nodes: the columns drawn for each, and where a column's cells begin, by the column's place among the drawn."""

    nodes: list[int]
    columns: np.ndarray  # (node, place)
    begin: np.ndarray  # (node, place)
    cells: list[int]  # by place

    @staticmethod
    def of(tree: int, level: int, nodes: list[int], n_bins: np.ndarray, per_node: int) -> "_Open":
        order = np.random.Generator(np.random.SFC64([RANDOM_SEED, tree, level])).random((len(nodes), len(n_bins))).argsort(axis=1)
        columns = order[:, :per_node]
        wide = 2 * n_bins[columns]
        return _Open(nodes, columns, np.cumsum(wide, axis=0) - wide, wide.sum(0).tolist())


def _grow(table: Any, numbers: range, depth: int, min_leaf: int, n_bins: Sequence[int], d: int) -> list[ForestTree]:
    """The trees of a group, a level a pass."""
    n_bins, per_node = np.array(n_bins), math.ceil(math.sqrt(d))
    steps = 1 if table.getNumPartitions() <= DIRECT else 2
    quantities = 1 if min_leaf <= 1 else 2  # weights, and draws if leaves have a least number
    state = _kept(table.map(lambda b: np.array([np.where(_drawn(t, b) > 0, 0, CLOSED) for t in numbers], np.uint16)))
    trees: dict[int, ForestTree] = {}
    todo = {t: _Open.of(t, 0, [0], n_bins, per_node) for t in numbers}
    for level in range(depth):
        moves: dict[int, tuple[np.ndarray, ...]] = {}
        after: dict[int, _Open] = {}
        for some in _portions(todo, quantities):
            sums = table.zip(state).mapPartitions(_sums(some, numbers, d, quantities)).treeReduce(lambda a, b: [x + y for x, y in zip(a, b)], steps)
            for (t, o), cells in zip(some.items(), _split_up(sums[0], [(q, sum(o.cells)) for o in some.values() for q in [quantities]])):
                moves[t], nodes = _choose(trees, t, o, cells, level, depth, min_leaf, n_bins)
                if nodes:
                    after[t] = _Open.of(t, level + 1, nodes, n_bins, per_node)
        todo = after
        if not todo:
            break
        before, state = state, _kept(table.zip(state).map(_moved(moves, numbers, d)))
        state.count()
        before.unpersist()
    state.unpersist()
    for tree in trees.values():
        tree.merge()
    return [trees.get(t) or ForestTree(0.0) for t in numbers]


def _portions(todo: dict[int, _Open], quantities: int) -> Iterator[dict[int, _Open]]:
    part: dict[int, _Open] = {}
    size = 0
    for t, o in todo.items():
        own = 8 * quantities * sum(o.cells)
        if part and size + own > HELD:
            yield part
            part, size = {}, 0
        part[t], size = o, size + own
    if part:
        yield part


def _split_up(sums: np.ndarray, shapes: Sequence[tuple[int, int]]) -> Iterator[np.ndarray]:
    at = 0
    for q, cells in shapes:
        yield sums[at : at + q * cells].reshape(q, cells)
        at += q * cells


def _sums(some: dict[int, _Open], numbers: range, d: int, quantities: int):
    """A partition's weights (and draws) of some trees by place of the column, node, bin and label."""
    def sums(pairs: Iterator[Any]) -> Iterator[list[np.ndarray]]:
        held = {t: np.zeros((quantities, sum(o.cells))) for t, o in some.items()}
        for block, nodes in pairs:
            flat, _, w, _ = block
            for t, o in some.items():
                at = nodes[t - numbers[0]]
                rows = np.flatnonzero(at != CLOSED)
                if not len(rows):
                    continue
                node, begin = at[rows].astype(np.int64), rows * d
                n = _drawn(t, block)[rows]
                own, a = n * w[rows], 0
                for j, cells in enumerate(o.cells):
                    cell = np.take(o.columns[:, j], node, mode="clip")
                    cell += begin
                    cell = np.take(o.begin[:, j], node, mode="clip") + np.take(flat, cell, mode="clip")
                    held[t][0, a : a + cells] += np.bincount(cell, own, cells)
                    if quantities > 1:
                        held[t][1, a : a + cells] += np.bincount(cell, n, cells)
                    a += cells
        yield [np.concatenate([h.ravel() for h in held.values()])]

    return sums


def _moved(moves: dict[int, tuple[np.ndarray, ...]], numbers: range, d: int):
    """A block's rows in the nodes of the next level."""
    def moved(pair) -> np.ndarray:
        (flat, *_), nodes = pair
        out = np.full_like(nodes, CLOSED)
        for t, (column, cut, left, right) in moves.items():
            at = nodes[t - numbers[0]]
            rows = np.flatnonzero(at != CLOSED)
            node = at[rows].astype(np.int64)
            beyond = np.take(flat, rows * d + column[node], mode="clip") > (2 * cut.astype(np.int16) + 1)[node]
            out[t - numbers[0], rows] = np.where(beyond, right[node], left[node])
        return out

    return moved


def _choose(trees: dict[int, ForestTree], t: int, o: _Open, cells: np.ndarray, level: int, depth: int, min_leaf: int, n_bins: np.ndarray) -> tuple[tuple[np.ndarray, ...], list[int]]:
    """Splits a tree's open nodes; (column, cut, left and right place in the next level) of each, and the next level's nodes."""
    wide, n = int(n_bins.max()), len(o.nodes)
    bins = n_bins[o.columns]
    inside = np.arange(wide) < bins[..., None]
    place = (o.begin + np.cumsum([0, *o.cells[:-1]]))[..., None] + 2 * np.arange(wide)
    place = np.where(inside, place, 0)[..., None] + np.arange(2)
    by_bin = np.where(inside[..., None], cells[:, place], 0.0)  # (quantity, node, place, bin, label)
    left = np.cumsum(by_bin[0], axis=2)
    every = left[:, :, -1:, :]
    right = every - left
    wl, wr, whole = left.sum(-1), right.sum(-1), every.sum(-1)
    fits = np.arange(wide) < bins[..., None] - 1
    if len(cells) > 1:
        nl = np.cumsum(by_bin[1], axis=2).sum(-1)
        fits &= (nl >= min_leaf) & (nl[:, :, -1:] - nl >= min_leaf)
    with np.errstate(divide="ignore", invalid="ignore"):
        impure = lambda a, w: 1 - ((a / w[..., None]) ** 2).sum(-1)
        gain = impure(every, whole) - wl / whole * impure(left, wl) - wr / whole * impure(right, wr)
    # weights of an empty side cancel to about nothing
    fits &= (wl > 1e-9 * whole) & (wr > 1e-9 * whole)
    gain = np.where(fits, gain, -np.inf).reshape(n, -1)
    best = gain.argmax(1)
    column, cut = np.zeros(n, np.int64), np.full(n, 255, np.uint8)
    to = np.full((2, n), CLOSED, np.uint16)
    if t not in trees:
        trees[t] = ForestTree(float(every[0, 0, 0, 1] / whole[0, 0, 0]))
    nodes: list[int] = []
    for i in np.flatnonzero(gain[np.arange(n), best] > 1e-12).tolist():
        j, b = divmod(int(best[i]), wide)
        column[i], cut[i] = o.columns[i, j], b
        shares = float(left[i, j, b, 1] / wl[i, j, b]), float(right[i, j, b, 1] / wr[i, j, b])
        a = trees[t].split(o.nodes[i], int(column[i]), b, shares)
        for k, s in enumerate(shares):
            if level + 1 < depth and 1e-12 < s < 1 - 1e-12:
                to[k, i] = len(nodes)
                nodes.append(a + k)
    return (column, cut, *to), nodes
