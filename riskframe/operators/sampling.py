"""Stratified split and folds, class weights, background samples, setting draws.

Randomness is a hash of (seed, stream, key), so the split of a row never
depends on partitioning or on a re-run after an executor loss.
"""

from __future__ import annotations

import itertools
import math
from typing import Any, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_key
from ..spec import CV_FOLDS, RANDOM_SEED, TEST_SIZE
from ..session import written
from .rank import hash_rank, null_safe_join


def class_counts(df: DataFrame, label: str) -> dict[Any, int]:
    """Rows per class (one row per class reaches the driver)."""
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def class_test_counts(df: DataFrame, label: str, test_size: float = TEST_SIZE) -> DataFrame:
    """``(label, n, __lim)``: :func:`allocate_test_counts` over the table of classes."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()  # over the per-class table: one row per class
    n_test = F.ceil(F.lit(test_size) * F.sum("n").over(every))
    share = counts.withColumn("__c", n_test * F.col("n") / F.sum("n").over(every)).withColumn("__t", n_test)
    share = share.withColumn("__f", F.floor("__c"))
    left = F.col("__t") - F.sum("__f").over(every)
    order = Window.orderBy((F.col("__c") - F.col("__f")).desc(), F.col(label).asc_nulls_last())
    return share.select(label, "n", (F.col("__f") + (F.row_number().over(order) <= left).cast("int")).cast("bigint").alias("__lim"))


def allocate_test_counts(counts: Mapping[Any, int], test_size: float = TEST_SIZE) -> dict[Any, int]:
    """Test rows per class: total ``ceil(test_size * n)``, shares by largest
    remainder, ties broken by class value."""
    n = sum(counts.values())
    n_test = math.ceil(test_size * n)
    keys = sorted(counts, key=lambda k: (k is None, k))
    cont = {k: n_test * counts[k] / n for k in keys}
    alloc = {k: math.floor(cont[k]) for k in keys}
    need = n_test - sum(alloc.values())
    order = sorted(keys, key=lambda k: (-(cont[k] - alloc[k]), (k is None, k)))
    for k in order[:need]:
        alloc[k] += 1
    return alloc


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = TEST_SIZE,
                     seed: int = RANDOM_SEED, split_col: str = "split", tie: str | None = None) -> DataFrame:
    """Exact stratified split: each class keeps its share in the test part.

    Rows are ranked inside their class by ``md5(seed:split:key)``; the first
    ``n_test_c`` rows of class c are ``test``. Rows of one key follow ``tie``.
    """
    ranked = hash_rank(df, [label], key, seed, "split", rank_col="__r", tie=tie)
    limits = written(class_test_counts(df, label, test_size).select(label, "__lim"), "split-limits")
    out = null_safe_join(ranked, limits, [label], how="left")  # one row per class
    return out.withColumn(split_col, F.when(F.col("__r") <= F.col("__lim"), F.lit("test")).otherwise(F.lit("train"))) \
              .drop("__r", "__lim")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = CV_FOLDS, seed: int = RANDOM_SEED,
                     fold_col: str = "fold", tie: str | None = None) -> DataFrame:
    """Fold = (rank inside class - 1) mod k: class shares differ by at most one row per fold."""
    ranked = hash_rank(df, [label], key, seed, "fold", rank_col="__r", tie=tie)
    return ranked.withColumn(fold_col, ((F.col("__r") - 1) % F.lit(k)).cast("int")).drop("__r")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, weight)`` with the balanced weight n / (k * n_c)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # over the per-class table: one row per class
    return counts.select(
        label, F.col("n").cast("bigint").alias("n"),
        (F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Attach the balanced weight to each row (a table of one row per class, written first so that rows aren't shuffled for it)."""
    w = written(class_weights(df, label).select(label, F.col("weight").alias(weight_col)), "class-weights")
    return null_safe_join(df, w, [label], how="left")


def background_sample(df: DataFrame, key: str, k: int, seed: int = RANDOM_SEED, stream: str = "background") -> DataFrame:
    """At most ``k`` rows, the smallest ``md5(seed:stream:key)`` (a top-k, not a scan of all to the driver)."""
    return df.withColumn("__h", hash_key(seed, stream, key)).orderBy("__h", key).limit(k).drop("__h")


def param_combinations(grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    names = list(grid)
    return [dict(zip(names, values)) for values in itertools.product(*[grid[n] for n in names])]


def draw_settings(grid: Mapping[str, Sequence[Any]], n_iter: int, seed: int = RANDOM_SEED) -> list[dict[str, Any]]:
    """Draw ``min(n_iter, combinations)`` settings without replacement, hash-ordered."""
    import hashlib

    combos = param_combinations(grid)
    order = sorted(range(len(combos)), key=lambda i: hashlib.md5(f"{seed}:params:{i}".encode()).hexdigest())
    return [combos[i] for i in order[: min(n_iter, len(combos))]]
