"""L2 logistic regression: every setting and fold fitted in the same passes over the rows.

Each pass carries the coefficients of all models still open and sums their losses, gradients and
Hessians in one aggregation: a partition adds up blocks of rows with matrix products and hands on one
state, states are added in groups, and one sum per model reaches the driver, which takes Newton steps.
A setting's first model is fitted so; its other folds start at its coefficients, with Hessians added
from those of the folds there, one pass for all. They differ little from the optimum's, so that passes
over losses and gradients end these models; one whose step does not shrink by ``SHRINKS`` gets a new
Hessian. About fifteen passes serve a whole grid with all its folds.

A model minimises ``|w|^2 / 2 + C * sum_i s_i * loss_i`` over the rows outside its fold; the intercept is
not penalised; ``s`` is 1 or the balanced weight ``n / (2 n_class)`` of those rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .models import LinearModel

#: States added up in one task, and rows worked on at once.
GROUP, BLOCK = 256, 4096
#: Passes after which a model that still moves is an error; a step below ``TOL`` ends a model.
PASSES, TOL = 100, 1e-8
#: A step under a kept Hessian must be this share of the one before, or the Hessian is summed again.
SHRINKS = 0.1


@dataclass(frozen=True)
class Job:
    """One model: a draw of the grid, its inverse strength and the fold left out (None: none)."""

    draw: int
    c: float
    fold: int | None


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows with a last column of ones, labels, folds) of record batches (label, fold, *features)."""
    for b in batches:
        x = np.column_stack([*(np.asarray(b.column(i)) for i in range(2, b.num_columns)), np.ones(b.num_rows)])
        if not np.isfinite(x).all():
            raise ValueError("a feature is missing or not finite: impute before fitting")
        y, fold = np.asarray(b.column(0)), np.asarray(b.column(1))
        for k in range(0, len(x), BLOCK):
            yield x[k : k + BLOCK], y[k : k + BLOCK], fold[k : k + BLOCK]


def _input(df: DataFrame, features: Sequence[str], label: str, fold_col: str | None) -> DataFrame:
    fold = F.coalesce(F.col(fold_col).cast("int"), F.lit(-1)) if fold_col else F.lit(-1)
    return df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("y"), fold.alias("f"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])


def class_weights(df: DataFrame, label: str, fold_col: str | None, jobs: Sequence[Job], balanced: bool) -> dict[int | None, tuple[float, float]]:
    """Weights of label 0 and 1 for each fold left out. A part with one class only can't be fitted."""
    rows = _input(df, [], label, fold_col).groupBy("f", "y").count().collect()  # folds x 2
    out = {}
    for fold in {j.fold for j in jobs}:
        n = [sum(r["count"] for r in rows if r["y"] == y and (fold is None or r["f"] != fold)) for y in (0.0, 1.0)]
        if not all(n):
            raise ValueError(f"without fold {fold} the rows have one class only")
        out[fold] = tuple(sum(n) / (2 * k) if balanced else 1.0 for k in n)
    return out


def _added(rows: DataFrame, state_of, size: int) -> np.ndarray:
    """The sum over partitions of ``state_of(blocks)``, an array of ``size`` numbers, in the partitions' order."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, state = TaskContext.get().partitionId(), state_of(_blocks(batches))
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "state": pa.array([state.tobytes()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(table.column("part").combine_chunks()))
        total = np.zeros(size)
        for i in order.tolist():  # the same order whatever arrives first
            total += np.frombuffer(table.column("state")[i].as_py())
        return pa.table({"part": pa.array([table.column("part")[int(order[0])].as_py() // GROUP], pa.int64()), "state": pa.array([total.tobytes()], pa.binary())})

    schema = "part long, state binary"
    states = rows.mapInArrow(partial, schema)
    if rows.rdd.getNumPartitions() > GROUP:  # the driver adds at most GROUP states, else tasks do
        groups = states.groupBy((F.col("part") / GROUP).cast("long")).applyInArrow(add, schema)
        states = groups.groupBy((F.col("part") * 0).alias("all")).applyInArrow(add, schema)
    return sum((np.frombuffer(r["state"]) for r in sorted(states.collect(), key=lambda r: r["part"])), np.zeros(size))


def _loss_and_probability(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    e = np.exp(-np.abs(z))
    return np.log1p(e) + np.maximum(z, 0) - y[:, None] * z, np.where(z >= 0, 1.0, e) / (1 + e)


def sums(rows: DataFrame, jobs: Sequence[Job], weights: Mapping[int | None, tuple[float, float]], coef: np.ndarray,
         curved: Sequence[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Losses, gradients and Hessians of all jobs at their coefficients, unpenalised, in one pass; Hessians
    of the jobs ``curved`` only, if given (the others' are 0).

    What travels is one state per partition of ``len(jobs) * (1 + d) + len(curved) * d * d`` numbers.
    """
    m, d = coef.shape
    curved = list(range(m)) if curved is None else list(curved)

    def state_of(blocks) -> np.ndarray:
        loss, grad, hess = np.zeros(m), np.zeros((m, d)), np.zeros((len(curved), d, d))
        for x, y, fold in blocks:
            losses, p = _loss_and_probability(x @ coef.T, y)
            w = np.empty_like(p)
            for f in {j.fold for j in jobs}:
                w[:, [k for k, j in enumerate(jobs) if j.fold == f]] = (np.where(y > 0, weights[f][1], weights[f][0]) * (fold != f if f is not None else 1.0))[:, None]
            loss += (w * losses).sum(0)
            grad += (w * (p - y[:, None])).T @ x
            for i, k in enumerate(curved):
                hess[i] += x.T @ (x * (w[:, k] * p[:, k] * (1 - p[:, k]))[:, None])
        return np.concatenate([loss, grad.ravel(), hess.ravel()])

    total = _added(rows, state_of, m + m * d + len(curved) * d * d)
    loss, grad, some = np.split(total, np.cumsum([m, m * d]))
    hess = np.zeros((m, d, d))
    hess[curved] = some.reshape(len(curved), d, d)
    return loss, grad.reshape(m, d), hess


def fold_hessians(rows: DataFrame, folds: Sequence[int], coef: np.ndarray) -> np.ndarray:
    """Hessians by (coefficients, fold, label), unweighted; the last fold stands for the rows of all others.

    A row adds to one of them, so that all folds' training parts cost one pass at one Hessian per model."""
    m, d = coef.shape
    folds = np.array(sorted(folds))

    def state_of(blocks) -> np.ndarray:
        hess = np.zeros((m, len(folds) + 1, 2, d, d))
        for x, y, fold in blocks:
            _, p = _loss_and_probability(x @ coef.T, y)
            at = np.searchsorted(folds, fold)
            at = np.where(np.append(folds, 0)[at] == fold, at, len(folds)) if len(folds) else np.zeros(len(fold), np.int64)
            for f, label in {*zip(at.tolist(), (y > 0).tolist())}:
                mine = (at == f) & ((y > 0) == label)
                some, q = x[mine], p[mine]
                for k in range(m):
                    hess[k, f, int(label)] += some.T @ (some * (q[:, k] * (1 - q[:, k]))[:, None])
        return hess.ravel()

    return _added(rows, state_of, m * (len(folds) + 1) * 2 * d * d).reshape(m, len(folds) + 1, 2, d, d)


def newton(df: DataFrame, features: Sequence[str], jobs: Sequence[Job], label: str = "label", fold_col: str | None = "fold", balanced: bool = True) -> np.ndarray:
    """Coefficients (the intercept last) of all jobs. An objective that grows halves the step."""
    weights = class_weights(df, label, fold_col, jobs, balanced)
    rows = _input(df, features, label, fold_col)
    d = len(features) + 1
    ridge = np.diag([1.0] * (d - 1) + [0.0])
    coef, trial = np.zeros((len(jobs), d)), np.zeros((len(jobs), d))
    least, moved = np.full(len(jobs), np.inf), np.full(len(jobs), np.inf)
    kept: dict[int, np.ndarray] = {}  # unpenalised Hessians that models go on with

    def descend(todo: list[int]) -> None:
        for _ in range(PASSES):
            curved = [i for i, k in enumerate(todo) if k not in kept]
            loss, grad, hess = sums(rows, [jobs[k] for k in todo], weights, trial[todo], curved)
            left = []
            for i, (k, l, g) in enumerate(zip(todo, loss, grad)):
                w = trial[k] * np.diag(ridge)
                objective = w @ w / 2 + jobs[k].c * l
                if objective > least[k] * (1 + 1e-12):
                    trial[k] = (coef[k] + trial[k]) / 2
                    kept.pop(k, None)
                    left.append(k)
                    continue
                coef[k], least[k] = trial[k], objective
                h = kept.get(k, hess[i])
                step = np.linalg.lstsq(jobs[k].c * h + ridge, jobs[k].c * g + w, rcond=None)[0]
                trial[k] = coef[k] - step
                size = np.abs(step).max()
                if size <= TOL * (1 + np.abs(coef[k]).max()):
                    continue
                left.append(k)
                if size <= SHRINKS * moved[k] if np.isfinite(moved[k]) else k in kept:
                    kept[k] = h
                else:
                    kept.pop(k, None)
                moved[k] = size
            todo = left
            if not todo:
                return
        raise RuntimeError(f"{len(todo)} models still move after {PASSES} passes")

    first: dict[tuple[int, float], int] = {}
    for k, j in enumerate(jobs):  # the model of all rows, if there is one
        lead = first.setdefault((j.draw, j.c), k)
        if j.fold is None and jobs[lead].fold is not None:
            first[j.draw, j.c] = k
    leads = list(first.values())
    descend(leads)
    others = [k for k in range(len(jobs)) if k not in leads]
    if others:
        folds = sorted({jobs[k].fold for k in others if jobs[k].fold is not None})
        parts = fold_hessians(rows, folds, trial[leads])
        for k in others:
            lead = first[jobs[k].draw, jobs[k].c]
            in_part = [i for i in range(len(folds) + 1) if i == len(folds) or folds[i] != jobs[k].fold]
            of_label = parts[leads.index(lead)][in_part].sum(0)
            kept[k] = sum(s * h for s, h in zip(weights[jobs[k].fold], of_label))
            trial[k] = coef[k] = trial[lead]
        descend(others)
    return trial


def linear_model(features: Sequence[str], coef: np.ndarray) -> LinearModel:
    return LinearModel(float(coef[-1]), {c: float(w) for c, w in zip(features, coef)})


@dataclass
class Search:
    """A fitted grid: ``models`` by (draw, fold left out or None) and ``recalls`` (draw, c, fold, n_positive, n_found, recall)."""

    models: dict[tuple[int, int | None], LinearModel]
    recalls: DataFrame


def search(df: DataFrame, features: Sequence[str], settings: Sequence[Mapping[str, Any]], label: str = "label", fold_col: str = "fold", balanced: bool = True) -> Search:
    """M4 for the logistic family: every setting on every fold's training part and on all rows, in shared
    passes; recall of the held-out rows at 0.5 (0 where a fold has no positives) in one more."""
    folds = sorted(r[0] for r in df.where(F.col(fold_col).isNotNull()).select(fold_col).distinct().collect())  # a row per fold
    jobs = [Job(i, float(s.get("C", 1.0)), f) for i, s in enumerate(settings) for f in [*folds, None]]
    coef = newton(df, features, jobs, label, fold_col, balanced)
    held = [(k, j) for k, j in enumerate(jobs) if j.fold is not None]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(held), 2), np.int64)
        for x, y, fold in _blocks(batches):
            z = x @ coef.T
            for i, (k, j) in enumerate(held):
                mine = (fold == j.fold) & (y > 0)
                n[i] += mine.sum(), (mine & (z[:, k] >= 0)).sum()
        yield pa.RecordBatch.from_pydict({"draw": [j.draw for _, j in held], "c": [j.c for _, j in held], "fold": [j.fold for _, j in held],
                                          "n_positive": n[:, 0], "n_found": n[:, 1]},
                                         schema=pa.schema([("draw", pa.int32()), ("c", pa.float64()), ("fold", pa.int32()), ("n_positive", pa.int64()), ("n_found", pa.int64())]))

    counted = _input(df, features, label, fold_col).mapInArrow(count, "draw int, c double, fold int, n_positive long, n_found long")
    total = counted.groupBy("draw", "c", "fold").agg(F.sum("n_positive").alias("n_positive"), F.sum("n_found").alias("n_found"))
    recalls = total.withColumn("recall", F.coalesce(F.try_divide("n_found", "n_positive"), F.lit(0.0)))
    return Search({(j.draw, j.fold): linear_model(features, c) for j, c in zip(jobs, coef)}, recalls)


def gradients(df: DataFrame, features: Sequence[str], settings: Sequence[Mapping[str, Any]], found: Search, label: str = "label", fold_col: str = "fold",
              balanced: bool = True) -> dict[tuple[int, int | None], float]:
    """The largest part of each model's penalised gradient, per unit of C times the rows' weight: 0 at an optimum."""
    jobs = [Job(d, float(settings[d].get("C", 1.0)), f) for d, f in found.models]
    coef = np.array([[*m.weights.values(), m.intercept] for m in found.models.values()])
    rows, weights = _input(df, features, label, fold_col), class_weights(df, label, fold_col, jobs, balanced)
    _, grad, _ = sums(rows, jobs, weights, coef)
    pull = np.column_stack([coef[:, :-1], np.zeros(len(jobs))])
    n = rows.count()
    return {(j.draw, j.fold): float(np.abs(j.c * g + w).max() / (j.c * n)) for j, g, w in zip(jobs, grad, pull)}


def out_of_fold(df: DataFrame, models: Mapping[int, LinearModel], fold_col: str = "fold"):
    """The probability of each row by the model that didn't see its fold (a ``Column``)."""
    p = F.lit(None).cast("double")
    for fold, model in models.items():
        p = F.when(F.col(fold_col) == fold, model.probability()).otherwise(p)
    return p
