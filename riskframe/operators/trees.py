"""Histogram trees: forests and second-order boosting of many settings and folds in the same passes.

Columns are cut into bins once. A pass sums (gradient, hessian, rows) per (model, tree, node, column,
bin) of every open node of every model: a partition hands on one histogram per open node, a task per
node adds them up and picks the split, and one row per node reaches the driver. A forest grows all its
trees a level a pass; boosting grows the next tree of every model a level a pass.

A split's gain is ``GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)``. Boosting takes the log-loss' gradient
``p - y`` and hessian ``p (1 - p)``; a forest takes ``-s y`` and ``s`` (s a row's weight and number of
draws), so that its gain is the fall of the weighted Gini impurity and a leaf holds the mean label.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, field
from typing import Any, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..spec import RANDOM_SEED

BLOCK = 8192
#: Bytes of histograms that a task holds; more open nodes than fit are summed in further passes.
HELD = 64 << 20


@dataclass(frozen=True)
class Setting:
    """What a model is grown by; ``fold`` is left out of its rows (None: none)."""

    kind: str  # "forest" or "boosting"
    trees: int = 100
    depth: int = 3
    rate: float = 0.1
    rows: float = 1.0  # share of rows drawn for each tree of boosting
    columns: float = 1.0  # share of columns drawn for each tree of boosting
    min_split: int = 2
    min_leaf: int = 1
    penalty: float = 1.0
    fold: int | None = None

    @staticmethod
    def of(family: str, setting: Mapping[str, Any], fold: int | None = None, deepest: int = 30) -> "Setting":
        """The setting of a grid's draw."""
        depth = setting.get("max_depth")
        if family == "random_forest":
            return Setting("forest", int(setting.get("n_estimators", 100)), deepest if depth is None else int(depth), min_split=int(setting.get("min_samples_split", 2)),
                           min_leaf=int(setting.get("min_samples_leaf", 1)), penalty=0.0, fold=fold)
        return Setting("boosting", int(setting.get("n_estimators", 100)), int(depth or 3), float(setting.get("learning_rate", 0.1)), float(setting.get("subsample", 1.0)),
                       float(setting.get("colsample_bytree", 1.0)), fold=fold)


@dataclass
class Tree:
    """Nodes as lists: column and bin of the split (-1: a leaf), children, value and rows' hessian."""

    column: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    weight: list[float] = field(default_factory=lambda: [0.0])

    def node_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of binned columns."""
        column, cut, left, right = (np.array(x) for x in (self.column, self.bin, self.left, self.right))
        at = np.zeros(len(bins), np.int64)
        while True:
            inner = np.flatnonzero(column[at] >= 0)
            if not len(inner):
                return at
            here = at[inner]
            at[inner] = np.where(bins[inner, column[here]] <= cut[here], left[here], right[here])

    def split(self, node: int, column: int, cut: int, values: tuple[float, float], weights: tuple[float, float]) -> tuple[int, int]:
        a = len(self.column)
        self.column[node], self.bin[node], self.left[node], self.right[node] = column, cut, a, a + 1
        for v, w in zip(values, weights):
            for x, new in ((self.column, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.value, v), (self.weight, w)):
                x.append(new)
        return a, a + 1


@dataclass
class TreeModel:
    """Fitted trees over named columns; ``edges`` cut each column (bin b: the edges below the value are b)."""

    setting: Setting
    features: list[str]
    edges: list[list[float]]
    trees: list[Tree]
    base: float = 0.0

    def margins(self, bins: np.ndarray) -> np.ndarray:
        """Log-odds of boosting, mean label of a forest."""
        out = np.full(len(bins), self.base)
        for t in self.trees:
            out += np.array(t.value)[t.node_of(bins)]
        return out / max(1, len(self.trees)) if self.setting.kind == "forest" else out

    def probabilities(self, bins: np.ndarray) -> np.ndarray:
        m = self.margins(bins)
        return m if self.setting.kind == "forest" else 1 / (1 + np.exp(-m))

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``(*keep, probability)`` of the rows of ``df``."""
        k = len(keep)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = np.column_stack([np.asarray(b.column(i)) for i in range(k, b.num_columns)])
                yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(self.probabilities(binned(x, self.edges)))], names=[*keep, "probability"])

        data = df.select(*keep, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.features)])
        return data.mapInArrow(rows, ", ".join(f"`{c}` {t}" for c, t in data.select(*keep).dtypes) + ", probability double")


def search(df: DataFrame, features: Sequence[str], family: str, settings: Sequence[Mapping[str, Any]], label: str = "label", fold_col: str = "fold",
           weight: str | None = "weight", bins: int = 64, key: str | None = None) -> tuple[dict[tuple[int, int | None], TreeModel], DataFrame]:
    """M4 for a tree family: models by (draw, fold left out or None), all grown in shared passes, and
    ``(draw, fold, n_positive, n_found, recall)`` of the held-out rows at 0.5 (0 without positives)."""
    folds = sorted(r[0] for r in df.where(F.col(fold_col).isNotNull()).select(fold_col).distinct().collect())  # a row per fold
    jobs = [(i, f) for i in range(len(settings)) for f in [*folds, None]]
    models = dict(zip(jobs, fit(df, features, [Setting.of(family, settings[i], f) for i, f in jobs], label, fold_col, weight, bins, key)))
    held = [(i, f) for i, f in jobs if f is not None]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(held), 2), np.int64)
        for b in batches:
            y, fold = np.asarray(b.column(0)), np.asarray(b.column(1))
            x = binned(np.column_stack([np.asarray(b.column(i)) for i in range(2, b.num_columns)]), models[jobs[0]].edges)
            for k, (i, f) in enumerate(held):
                mine = (fold == f) & (y > 0)
                n[k] += mine.sum(), (models[i, f].probabilities(x[mine]) >= 0.5).sum()
        yield pa.RecordBatch.from_pydict({"draw": pa.array([i for i, _ in held], pa.int32()), "fold": pa.array([f for _, f in held], pa.int32()), "p": n[:, 0], "q": n[:, 1]})

    rows = df.where(F.col(label).isNotNull() & F.col(fold_col).isNotNull()).select(F.col(label).cast("double"), F.col(fold_col).cast("int"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    total = rows.mapInArrow(count, "draw int, fold int, p long, q long").groupBy("draw", "fold").agg(F.sum("p").alias("n_positive"), F.sum("q").alias("n_found"))
    return models, total.withColumn("recall", F.coalesce(F.try_divide("n_found", "n_positive"), F.lit(0.0)))


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = 64, accuracy: int = 10_000) -> list[list[float]]:
    """At most ``bins - 1`` cuts per column, at sketched quantiles, in one pass; the largest value cuts nothing."""
    at = F.array(*[F.lit(i / bins) for i in range(1, bins + 1)])
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), at, accuracy) for c in features], *[F.max(F.col(c).cast("double")) for c in features]).first()
    return [sorted({x for x in row[i] or [] if x < row[len(features) + i]}) for i in range(len(features))]


def binned(x: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    if not np.isfinite(x).all():
        raise ValueError("a feature is missing or not finite: impute before fitting")
    return np.column_stack([np.searchsorted(np.array(e), x[:, i], "left") for i, e in enumerate(edges)]).astype(np.uint8)


def uniforms(keys: np.ndarray, stream: int) -> np.ndarray:
    """U[0, 1) of each row's key for one tree: the same wherever and how often the row is read."""
    with np.errstate(over="ignore"):
        h = keys ^ np.uint64((stream * 0x9E3779B97F4A7C15 + RANDOM_SEED) & (1 << 64) - 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        h ^= h >> np.uint64(31)
    return (h >> np.uint64(11)).astype(np.float64) / 2.0**53


def draws(keys: np.ndarray, stream: int) -> np.ndarray:
    """How often each row is drawn for a tree of a forest (Poisson with mean 1, as in a large bootstrap)."""
    u, n, p, below = uniforms(keys, stream), np.zeros(len(keys)), math.exp(-1), 0.0
    for k in range(1, 12):
        below += p
        n += u >= below
        p /= k
    return n


def allowed(s: Setting, model: int, tree: int, node: int, d: int) -> list[int]:
    """Columns that may split a node: a share per tree for boosting, about sqrt(d) per node for a forest."""
    forest = s.kind == "forest"
    k = max(1, math.isqrt(d)) if forest else max(1, math.ceil(s.columns * d))
    if k >= d:
        return list(range(d))
    name = f"{RANDOM_SEED}:{tree}:{node if forest else ''}"
    return sorted(sorted(range(d), key=lambda c: hashlib.md5(f"{name}:{c}".encode()).hexdigest())[:k])


def counted(s: Setting, model: int, tree: int, node: int, d: int) -> np.ndarray:
    """Columns whose histogram a node needs: those that may split it, and the first for the sums."""
    return np.array(sorted({0, *allowed(s, model, tree, node, d)}))


def best_split(hist: np.ndarray, columns: Sequence[int], s: Setting) -> tuple[int, int, float] | None:
    """(column, bin, gain) of a histogram (column, bin, (g, h, n)): the largest gain, then the first column and bin."""
    g, h, n = hist[0].sum(0)
    if n < s.min_split:
        return None
    best = None
    for c in columns:
        left = np.cumsum(hist[c], axis=0)[:-1]
        right = np.array([g, h, n]) - left
        fit = (left[:, 2] >= s.min_leaf) & (right[:, 2] >= s.min_leaf) & (left[:, 1] + s.penalty > 0) & (right[:, 1] + s.penalty > 0)
        if not fit.any():
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[:, 0] ** 2 / (left[:, 1] + s.penalty) + right[:, 0] ** 2 / (right[:, 1] + s.penalty) - g * g / (h + s.penalty)
        gain = np.where(fit, gain, -np.inf)
        at = int(gain.argmax())
        if gain[at] > 1e-9 and (best is None or gain[at] > best[2] + 1e-9):
            best = c, at, float(gain[at])
    return best


def fit(df: DataFrame, features: Sequence[str], settings: Sequence[Setting], label: str = "label", fold_col: str | None = "fold", weight: str | None = None,
        bins: int = 64, key: str | None = None) -> list[TreeModel]:
    """All settings, fitted in shared passes over one binned table.

    ``weight`` is used by forests (boosting is fitted without class weights). ``key`` names the column
    whose hash draws rows; without it the row's content does. Rows without a label take no part.
    """
    features, d = list(features), len(features)
    edges = bin_edges(df.where(F.col(label).isNotNull()), features, bins)
    fold = F.coalesce(F.col(fold_col).cast("int"), F.lit(-1)) if fold_col else F.lit(-1)
    source = df.where(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"), fold.alias("f"),
        F.xxhash64(*([key] if key else [label, *features])).alias("key"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = binned(np.column_stack([np.asarray(b.column(i)) for i in range(4, b.num_columns)]), edges)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array([r.tobytes() for r in raw], pa.binary())], names=["y", "w", "f", "key", "bins"])

    table = cut_lineage(source.mapInArrow(cut, "y double, w double, f int, key long, bins binary"))
    models = [TreeModel(s, features, edges, [Tree() for _ in range(s.trees)] if s.kind == "forest" else []) for s in settings]
    # open nodes by (model, tree): a forest begins with all its roots, boosting with its first tree's
    rounds = max([s.trees for s in settings if s.kind == "boosting"], default=1)
    for turn in range(max(1, rounds)):
        todo: dict[tuple[int, int], list[int]] = {}
        for m, model in enumerate(models):
            if model.setting.kind == "forest" and turn == 0:
                todo |= {(m, t): [0] for t in range(model.setting.trees)}
            elif model.setting.kind == "boosting" and turn < model.setting.trees:
                model.trees.append(Tree())
                todo[m, turn] = [0]
        level = 0
        while todo:
            found = {}
            for some in _portions(todo, max(1, HELD // (d * bins * 24))):
                found |= _level(table, models, some, d, bins)
            after: dict[tuple[int, int], list[int]] = {}
            for (m, t), nodes in todo.items():
                s, tree = models[m].setting, models[m].trees[t]
                for node in nodes:
                    r = found.get((m, t, node))
                    if r is None:
                        continue
                    scale = 1.0 if s.kind == "forest" else s.rate
                    if node == 0:
                        tree.value[0], tree.weight[0] = _leaf(r["g"], r["h"], s) * scale, r["h"]
                    if r["column"] >= 0 and level < s.depth:
                        right = r["g"] - r["gl"], r["h"] - r["hl"]
                        values = _leaf(r["gl"], r["hl"], s) * scale, _leaf(*right, s) * scale
                        children = tree.split(node, r["column"], r["bin"], values, (r["hl"], right[1]))
                        if level + 1 < s.depth:
                            after.setdefault((m, t), []).extend(children)
            todo, level = after, level + 1
    return models


def _portions(todo: Mapping[tuple[int, int], Sequence[int]], size: int) -> Iterator[dict[tuple[int, int], list[int]]]:
    """Open nodes, ``size`` at a time."""
    every = [(tree, node) for tree, nodes in todo.items() for node in nodes]
    for k in range(0, len(every), size):
        part: dict[tuple[int, int], list[int]] = {}
        for tree, node in every[k : k + size]:
            part.setdefault(tree, []).append(node)
        yield part


def _leaf(g: float, h: float, s: Setting) -> float:
    return -g / (h + s.penalty) if h + s.penalty > 0 else 0.0


def _level(table: DataFrame, models: Sequence[TreeModel], todo: Mapping[tuple[int, int], Sequence[int]], d: int, bins: int) -> dict[tuple[int, int, int], Any]:
    """The best split and the sums of every open node."""
    by_model: dict[int, list[tuple[int, Sequence[int]]]] = {}
    for (m, t), nodes in todo.items():
        by_model.setdefault(m, []).append((t, nodes))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hists = {(m, t, n): np.zeros((d, bins, 3)) for (m, t), nodes in todo.items() for n in nodes}
        columns = {(m, t, n): counted(models[m].setting, m, t, n, d) for m, t, n in hists}
        for b in batches:
            for k in range(0, b.num_rows, BLOCK):
                part = b.slice(k, BLOCK)
                y, w, fold = (np.asarray(part.column(i)) for i in range(3))
                keys = np.asarray(part.column(3)).view(np.uint64)
                x = np.frombuffer(b"".join(v.as_py() for v in part.column(4)), np.uint8).reshape(-1, d)
                drawn: dict[int, np.ndarray] = {}  # by tree, the same for all forests
                for m, trees in by_model.items():
                    s = models[m].setting
                    use = fold != s.fold if s.fold is not None else np.ones(len(y), bool)
                    if s.kind == "boosting":
                        earlier = TreeModel(s, [], [], models[m].trees[: trees[0][0]], models[m].base)
                        p = earlier.probabilities(x)
                    for t, nodes in trees:
                        if s.kind == "boosting":
                            mine = use & (uniforms(keys, t) < s.rows)
                            g, h, n = p - y, p * (1 - p), np.ones(len(y))
                        else:
                            if t not in drawn:
                                drawn[t] = draws(keys, t)
                            n = drawn[t]
                            mine = use & (n > 0)
                            g, h = -w * n * y, w * n
                        at = models[m].trees[t].node_of(x)
                        for node in nodes:
                            rows = np.flatnonzero(mine & (at == node))
                            if not len(rows):
                                continue
                            hist = hists[m, t, node]
                            cols = columns[m, t, node]
                            cell = (x[rows[:, None], cols].astype(np.int64) + np.arange(len(cols)) * bins).ravel()
                            for c, v in enumerate((g, h, n)):
                                hist[cols, :, c] += np.bincount(cell, np.repeat(v[rows], len(cols)), len(cols) * bins).reshape(-1, bins)
        for (m, t, node), hist in hists.items():
            if hist[0, :, 2].any():
                yield pa.RecordBatch.from_pydict({"m": pa.array([m], pa.int32()), "t": pa.array([t], pa.int32()), "node": pa.array([node], pa.int32()), "hist": [hist.tobytes()]})

    def choose(group: pa.Table) -> pa.Table:
        m, t, node = (group.column(c)[0].as_py() for c in ("m", "t", "node"))
        parts = sorted(v.as_py() for v in group.column("hist").combine_chunks())  # one order, whatever arrives first
        hist = sum(np.frombuffer(v).reshape(d, bins, 3) for v in parts)
        s = models[m].setting
        got = best_split(hist, allowed(s, m, t, node, d), s)
        c, at, gain = got or (-1, 0, 0.0)
        gl, hl = hist[c, : at + 1, :2].sum(0).tolist() if got else (0.0, 0.0)
        g, h = hist[0, :, :2].sum(0).tolist()
        return pa.table({"m": pa.array([m], pa.int32()), "t": pa.array([t], pa.int32()), "node": pa.array([node], pa.int32()), "column": pa.array([c], pa.int32()),
                         "bin": pa.array([at], pa.int32()), "gain": [gain], "gl": [gl], "hl": [hl], "g": [g], "h": [h]})

    states = table.mapInArrow(partial, "m int, t int, node int, hist binary")
    picked = states.groupBy("m", "t", "node").applyInArrow(choose, "m int, t int, node int, column int, bin int, gain double, gl double, hl double, g double, h double")
    return {(r["m"], r["t"], r["node"]): r.asDict() for r in picked.collect()}  # a row per open node
