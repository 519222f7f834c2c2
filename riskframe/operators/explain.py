"""Feature attribution as Spark jobs.

* Linear models: exact Shapley values on the margin, ``w_j * (x_j - E[x_j])``,
  as column expressions (E over a background table, one aggregate).
* Histogram trees: path-dependent Shapley values of every leaf's path, rows in place.
* Any fitted model: permutation-sampling Shapley over the whole background. Along each of a few orders of the
  features, the same for all rows, a feature's contribution is the change of the mean score over all rows of
  the background when the feature goes over to the explained row's value; orders come in pairs of opposites.
  Per row, phi sums to f(x) less the mean of f over the background. Every (row, background row, coalition) is
  scored, so the work grows with rows times background.
  A fitted binary logistic regression needs no such rows: a coalition's margin is a sum of the row's part and the
  background's, so the mean score is a smooth function of the row's part. One pass gathers, per coalition, the
  moments of the background's parts in cells of a sixteenth, and rows look the mean up (to about 1e-12).
  Row ids must be unique.

The result is always a long table ``(row id, feature, value, phi)``.
"""

from __future__ import annotations

import hashlib
import math
from typing import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from ..spec import RANDOM_SEED, TOP_FEATURES
from .models import LinearModel, positive_probability
from .sampling import background_sample
from .trees import Tree, TreeModel, binned


def shap_linear(df: DataFrame, model: LinearModel, id_col: str, background: DataFrame | None = None) -> DataFrame:
    """X1(a): ``(id, feature, value, phi)`` on the log-odds scale."""
    feats = list(model.weights)
    bg = background if background is not None else df
    means = bg.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in feats]).first()  # d numbers
    exprs = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                 (F.lit(float(model.weights[c])) * (F.col(c).cast("double") - F.lit(means[c]))).alias("phi"))
        for c in feats
    ]
    return df.select(id_col, F.inline(F.array(*exprs)))


def leaf_paths(tree: Tree) -> list[tuple[float, dict[int, tuple[int, int, float]]]]:
    """(value, column -> (lowest bin, highest bin, share)) of every leaf.

    The bins of a column that lead to the leaf, and the share of the weight that goes its way at the
    path's splits of that column: what the leaf gets where the column isn't known.
    """
    out, stack = [], [(0, {})]
    while stack:
        node, path = stack.pop()
        column = tree.column[node]
        if column < 0:
            out.append((tree.value[node], path))
            continue
        lo, hi, share = path.get(column, (0, 255, 1.0))
        whole = tree.weight[tree.left[node]] + tree.weight[tree.right[node]]
        for child, low, high in ((tree.left[node], lo, min(hi, tree.bin[node])), (tree.right[node], max(lo, tree.bin[node] + 1), hi)):
            stack.append((child, path | {column: (low, high, share * (tree.weight[child] / whole if whole else 0.5))}))
    return out


def path_shapley(paths: Sequence[tuple[float, dict[int, tuple[int, int, float]]]], bins: np.ndarray) -> tuple[float, np.ndarray]:
    """(expected value, Shapley value of each column for each row) of a sum of leaves, path-dependent.

    A leaf counts for a set of known columns with the product of 0 or 1 for known and shares for unknown
    columns of its path. Over the sets of a size that product sums to a coefficient of the polynomial
    ``prod(share + inside * t)`` of the path's other columns; sizes weigh ``k! (m-k-1)! / m!``.
    """
    phi, base = np.zeros(bins.shape), 0.0
    for value, path in paths:
        columns, m = list(path), len(path)
        base += value * math.prod(p[2] for p in path.values())
        inside = [((bins[:, c] >= lo) & (bins[:, c] <= hi)).astype(float) for c, (lo, hi, _) in path.items()]
        shares = [p[2] for p in path.values()]
        for j, c in enumerate(columns):
            poly = np.zeros((m, len(bins)))
            poly[0] = 1.0
            for i in range(m):
                if i != j:
                    poly[1:] = poly[1:] * shares[i] + poly[:-1] * inside[i]
                    poly[0] *= shares[i]
            weights = [math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m) for k in range(m)]
            phi[:, c] += value * (inside[j] - shares[j]) * (weights @ poly)
    return base, phi


def shap_trees(df: DataFrame, model: TreeModel, id_col: str) -> DataFrame:
    """X1 for fitted trees: ``(id, feature, value, phi, base)``, on the log-odds for boosting and the mean
    label for a forest; a row's phi sum to its margin less base. Rows stay in their partition, repeated
    and null ids give their rows each."""
    edges, trees, scale = model.edges, model.trees, 1 / max(1, len(model.trees)) if model.setting.kind == "forest" else 1.0
    names = model.features

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = [p for t in trees for p in leaf_paths(t)]
        for whole in batches:
            for k in range(0, whole.num_rows, 4096):
                b = whole.slice(k, 4096)
                x = np.column_stack([np.asarray(b.column(i)) for i in range(1, b.num_columns)])
                base, phi = path_shapley(paths, binned(x, edges))
                ids = b.column(0).take(pa.array(np.repeat(np.arange(len(x)), len(names))))
                yield pa.RecordBatch.from_arrays([ids, pa.array(names * len(x)), pa.array(x.ravel()), pa.array(phi.ravel() * scale),
                                                  pa.array(np.full(x.size, base * scale + model.base))], names=[id_col, "feature", "value", "phi", "base"])

    data = df.select(id_col, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    return data.mapInArrow(rows, f"`{id_col}` {data.dtypes[0][1]}, feature string, value double, phi double, base double")


def global_importance(phi: DataFrame, top: int = TOP_FEATURES) -> DataFrame:
    """Mean |phi| per feature, the ``top`` largest (ties by name)."""
    imp = phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("importance"))
    return imp.orderBy(F.col("importance").desc(), F.col("feature").asc()).limit(top)


def distribution(phi: DataFrame, top: int = TOP_FEATURES) -> DataFrame:
    """(id, feature, value, phi) of the top features (beeswarm data)."""
    keep = global_importance(phi, top).select("feature")
    return phi.join(F.broadcast(keep), "feature", "left_semi")  # <= top rows


def waterfall(phi: DataFrame, id_col: str, row_id, base_value: float | None = None) -> DataFrame:
    """One row's contributions by |phi| descending, with the running total
    (starting from ``base_value`` when given)."""
    one = phi.where(F.col(id_col) == F.lit(row_id))
    w = Window.partitionBy(id_col).orderBy(F.abs("phi").desc(), F.col("feature").asc()) \
        .rowsBetween(Window.unboundedPreceding, 0)  # one row's features only
    start = F.lit(float(base_value or 0.0))
    return one.select(id_col, "feature", "value", "phi", (start + F.sum("phi").over(w)).alias("running_total"),
                      F.row_number().over(Window.partitionBy(id_col).orderBy(F.abs("phi").desc(), F.col("feature").asc()))
                      .alias("order"))


def _logistic_terms(model: PipelineModel, features: Sequence[str]) -> tuple[np.ndarray, float] | None:
    """(coefficient of each feature, intercept) of an assembler and a binary logistic regression, else None."""
    stages = getattr(model, "stages", [])
    if len(stages) != 2 or not isinstance(stages[0], VectorAssembler) or not isinstance(stages[1], LogisticRegressionModel):
        return None
    names = stages[0].getInputCols()
    if stages[1].numClasses != 2 or stages[1].getFeaturesCol() != stages[0].getOutputCol() or stages[1].getProbabilityCol() != "probability":
        return None
    if len(set(names)) != len(names) or set(names) - set(features) or stages[0].getHandleInvalid() != "error":
        return None
    weights = dict(zip(names, stages[1].coefficients.toArray()))
    return np.array([weights.get(c, 0.0) for c in features]), float(stages[1].intercept)


def feature_orders(features: Sequence[str], permutations: int, seed: int = RANDOM_SEED) -> list[list[int]]:
    """Orders of the features, by hash; every second is the reverse of the one before."""
    out: list[list[int]] = []
    for m in range(permutations):
        out.append(out[-1][::-1] if m % 2 else sorted(range(len(features)), key=lambda j: hashlib.md5(f"{seed}:perm:{m}:{features[j]}".encode()).hexdigest()))
    return out


def coalitions(orders: Sequence[Sequence[int]]) -> dict[frozenset[int], np.ndarray]:
    """The distinct sets of features that come from the row along the orders, and what a set's mean score counts in each feature's value."""
    d = len(orders[0])
    out: dict[frozenset[int], np.ndarray] = {}
    for order in orders:
        for t in range(d + 1):
            share = out.setdefault(frozenset(order[:t]), np.zeros(d))
            if t:
                share[order[t - 1]] += 1 / len(orders)
            if t < d:
                share[order[t]] -= 1 / len(orders)
    return out


#: Width of a cell of margins, and how many moments of a cell are kept: the rest of the series is below 1e-12.
CELL, MOMENTS = 1 / 16, 6
#: Beyond this the logistic function is 0 or 1.
FLAT = 40
#: A mean score is interpolated between this many neighbours, from NEAR[0] to NEAR[-1] cells away.
NEAR = np.arange(-3, 5)
#: From values there to the polynomial through them.
_THROUGH = np.linalg.inv(np.vander(NEAR.astype(float), increasing=True))


def _series() -> np.ndarray:
    """(moment, cell): the logistic function's derivatives at the cells, over their factorials."""
    s = 1 / (1 + np.exp(-np.arange(-int(FLAT / CELL), int(FLAT / CELL) + 1) * CELL))
    p, out = np.polynomial.Polynomial([0, 1]), []
    for r in range(MOMENTS):
        out.append(p(s) / math.factorial(r))
        p = p.deriv() * np.polynomial.Polynomial([0, 1, -1])
    return np.array(out)


def _ranked(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct cells in order, number of each cell's)."""
    low, high = int(cells.min()), int(cells.max())
    if high - low > 4 * len(cells) + 1024:
        return np.unique(cells, return_inverse=True)
    at = cells - low
    some = np.zeros(high - low + 1, bool)
    some[at] = True
    number = np.cumsum(some) - 1
    return np.flatnonzero(some) + low, number[at]


def _added(cells: np.ndarray, moments: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The moments of equal cells summed."""
    found, at = _ranked(cells)
    return found, np.array([np.bincount(at, m, len(found)) for m in moments])


def _powers(x: np.ndarray) -> Iterator[np.ndarray]:
    out = np.ones(len(x))
    for _ in range(MOMENTS):
        yield out
        out = out * x


def _background_moments(bg: DataFrame, terms: tuple[np.ndarray, float], orders: Sequence[Sequence[int]]) -> dict[frozenset[int], tuple[np.ndarray, np.ndarray]]:
    """Per coalition but the whole one, the cells and moments of the background's part of the margin, over all rows."""
    weights, intercept = terms
    sets = {s: k for k, s in enumerate(coalitions(orders)) if len(s) < len(weights)}

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            parts = weights * _values(batch.columns)
            done = set()
            for order in orders:
                rest = np.cumsum(parts[:, order[::-1]], axis=1)[:, ::-1] + intercept
                for t in range(len(order)):
                    if (k := sets[frozenset(order[:t])]) in done or not len(parts):
                        continue
                    done.add(k)
                    cells = np.rint(rest[:, t] / CELL).astype(np.int64)
                    off = rest[:, t] - cells * CELL
                    own = held.setdefault(k, [])
                    own.append(_added(cells, _powers(off)))
                    if len(own) > 16:
                        held[k] = [_added(*(np.concatenate(x, axis=-1) for x in zip(*own)))]
        for k, own in held.items():
            cells, moments = _added(*(np.concatenate(x, axis=-1) for x in zip(*own)))
            yield pa.RecordBatch.from_pydict({"k": pa.array([k], pa.int32()), "cells": [cells.tobytes()], "moments": [moments.tobytes()]})

    def add(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["cells"], r["moments"]))  # one order, whatever arrives first
        cells, moments = _added(np.concatenate([np.frombuffer(r["cells"], np.int64) for r in rows]),
                                np.concatenate([np.frombuffer(r["moments"]).reshape(MOMENTS, -1) for r in rows], axis=1))
        return pa.table({"k": pa.array([rows[0]["k"]], pa.int32()), "cells": [cells.tobytes()], "moments": [moments.tobytes()]})

    schema = "k int, cells binary, moments binary"
    found = {r["k"]: r for r in bg.mapInArrow(gather, schema).groupBy("k").applyInArrow(add, schema).collect()}  # a row per coalition: its occupied cells
    return {s: (np.frombuffer(found[k]["cells"], np.int64), np.frombuffer(found[k]["moments"]).reshape(MOMENTS, -1)) for s, k in sets.items() if k in found}


def _values(columns: Sequence[pa.Array]) -> np.ndarray:
    x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in columns])
    if np.isnan(x).any():
        raise ValueError("a feature is missing: impute before explaining")
    return x


class _MeanScore:
    """Mean score of a coalition over the background, as a function of the explained row's part of the margin."""

    def __init__(self, cells: np.ndarray, moments: np.ndarray, series: np.ndarray):
        self.cells, self.moments, self.series = cells, moments / moments[0].sum(), series
        self.at, self.mean = np.zeros(0, np.int64), np.zeros(0)

    def _means(self, at: np.ndarray) -> np.ndarray:
        out, step, edge = np.empty(len(at)), max(1, (1 << 20) // len(self.cells)), self.series.shape[1] // 2
        for k in range(0, len(at), step):
            z = np.clip(at[k : k + step, None] + self.cells, -edge, edge) + edge
            out[k : k + step] = sum(s[z] @ m for s, m in zip(self.series, self.moments))
        return out

    def __call__(self, a: np.ndarray) -> np.ndarray:
        cell = np.floor(a / CELL)
        part = a / CELL - cell
        cells, of = _ranked(cell.astype(np.int64))
        at = np.unique(cells[:, None] + NEAR)
        new = np.setdiff1d(at, self.at, assume_unique=True)
        if len(new):
            every, means = np.concatenate([self.at, new]), np.concatenate([self.mean, self._means(new)])
            order = np.argsort(every)
            self.at, self.mean = every[order], means[order]
        near = self.mean[np.searchsorted(self.at, cells[:, None] + NEAR)]
        terms = _THROUGH @ near.T
        out = terms[-1][of]
        for q in range(len(NEAR) - 2, -1, -1):
            out *= part
            out += terms[q][of]
        if len(self.at) > 1 << 16:
            self.at, self.mean = self.at[:0], self.mean[:0]
        return out


def _logistic_values(rows: DataFrame, terms: tuple[np.ndarray, float], features: Sequence[str], id_col: str, found: Mapping[frozenset[int], tuple[np.ndarray, np.ndarray]],
                     orders: Sequence[Sequence[int]]) -> DataFrame:
    """Shapley values of ``(id, x...)``, rows in place."""
    (weights, intercept), d, names, series = terms, len(features), list(features), _series()

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means = {s: _MeanScore(*c, series) for s, c in found.items()}
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())  # rows of an id count together, rows without one don't count
            if not batch.num_rows:
                continue
            x = _values(batch.columns[1:])
            gained = np.zeros_like(x)
            for order in orders:
                known = np.cumsum((weights * x)[:, order], axis=1)
                f = np.empty((len(x), d + 1))
                f[:, 0] = means[frozenset()](np.zeros(1))
                for t in range(1, d):
                    f[:, t] = means[frozenset(order[:t])](known[:, t - 1])
                f[:, d] = 1 / (1 + np.exp(-(known[:, -1] + intercept)))
                gained[:, order] += np.diff(f, axis=1) / len(orders)
            ids = batch.column(0).dictionary_encode()
            codes = np.asarray(ids.indices)
            phi = np.zeros((len(ids.dictionary), d))
            np.add.at(phi, codes, gained)
            first = np.unique(codes, return_index=True)[1]
            yield pa.RecordBatch.from_arrays([ids.dictionary.take(pa.array(np.repeat(np.arange(len(phi)), d))), pa.array(names * len(phi)), pa.array(x[first].ravel()),
                                              pa.array(phi.ravel())], names=[id_col, "feature", "value", "phi"])

    return rows.mapInArrow(explain, f"`{id_col}` {rows.dtypes[0][1]}, feature string, value double, phi double")


def shap_sampled(df: DataFrame, model: PipelineModel, features: Sequence[str], id_col: str,
                 background: DataFrame | None = None, n_background: int | None = None, permutations: int = 8,
                 seed: int = RANDOM_SEED) -> DataFrame:
    """X1(b): permutation-sampling Shapley values of the positive-class probability, against every row of the background
    (``df`` itself if none is given). ``n_background`` draws so many rows of it instead (R5, the reference's 100)."""
    feats = list(features)
    d = len(feats)
    bg = background if background is not None else df
    if n_background is not None:
        bg = written(background_sample(bg.select(id_col, *feats), id_col, n_background, seed), "background")
    bg = bg.select(*[F.col(c).cast("double").alias(f"__b_{c}") for c in feats])
    rows = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in feats])
    orders = feature_orders(feats, permutations, seed)
    if (terms := _logistic_terms(model, feats)) is not None and (found := _background_moments(bg, terms, orders)):
        return _logistic_values(rows, terms, feats, id_col, found, orders)
    n = bg.count()
    each = df.sparkSession.createDataFrame([([j in s for j in range(d)], share.tolist()) for s, share in coalitions(orders).items()], "__known array<boolean>, __share array<double>")
    mixed = rows.where(F.col(id_col).isNotNull()).crossJoin(bg).crossJoin(F.broadcast(each)).select(  # at most permutations x (d + 1) coalitions
        id_col, "__share", *[F.col(c).alias(f"__x_{c}") for c in feats], *[F.when(F.col("__known")[j], F.col(c)).otherwise(F.col(f"__b_{c}")).alias(c) for j, c in enumerate(feats)])
    scored = model.transform(mixed).withColumn("__f", positive_probability())
    sums = scored.groupBy(id_col).agg(*[F.first(f"__x_{c}").alias(f"__x_{j}") for j, c in enumerate(feats)], *[(F.sum(F.col("__f") * F.col("__share")[j]) / n).alias(f"__phi_{j}") for j in range(d)])
    return sums.select(id_col, F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"__x_{j}").alias("value"), F.col(f"__phi_{j}").alias("phi")) for j, c in enumerate(feats)])))
