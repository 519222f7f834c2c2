"""Global order at scale: ranks and running totals without a single-task window.

A window partitioned by a two-valued label, or not partitioned at all, runs
in one task. Both helpers here split the order into buckets that follow it
(a hex prefix of an md5 key, or ranges of a sort key), count per
bucket (a small table: partitions x buckets), turn those counts into
offsets with a window over the small table, and finish with a window inside
each bucket plus the offset.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_bucket, hash_key
from ..session import scratch_path, written


def null_safe_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (a NULL class is a class).

    No broadcast is asked for: Spark broadcasts ``small`` if its measured bytes allow it.
    """
    right = small.select(*[F.col(c).alias(f"__j_{c}") if c in keys else F.col(c) for c in small.columns])
    cond = None
    for k in keys:
        c = big[k].eqNullSafe(right[f"__j_{k}"])
        cond = c if cond is None else cond & c
    return big.join(right, cond, how).drop(*[f"__j_{k}" for k in keys])


def hex_chars_for(n_rows: int, rows_per_bucket: int = 200_000) -> int:
    """Hex prefix length so that a bucket holds about ``rows_per_bucket`` rows."""
    if n_rows <= rows_per_bucket * 16:
        return 1
    return max(1, min(15, math.ceil(math.log(n_rows / rows_per_bucket, 16))))


def hash_rank(
    df: DataFrame,
    partition_cols: Sequence[str],
    key_col: str,
    seed: int,
    stream: str,
    rank_col: str = "rank",
    n_rows: int | None = None,
    rows_per_bucket: int = 200_000,
    tie: str | None = None,
) -> DataFrame:
    """1-based rank inside ``partition_cols`` ordered by ``md5(seed:stream:key)``, then key, then ``tie``.

    Equal to ``row_number() OVER (PARTITION BY p ORDER BY md5(..), key)``.
    """
    h = "__h"
    b = "__b"
    if n_rows is None:
        n_rows = df.count()
    chars = hex_chars_for(n_rows, rows_per_bucket)
    # the digest travels as 16 bytes, which order as their hex does
    digest = hash_key(seed, stream, key_col)
    keyed = df.withColumns({h: F.unhex(digest), b: hash_bucket(digest, chars)})
    counts = keyed.groupBy(*partition_cols, b).agg(F.count(F.lit(1)).alias("__n"))
    wo = Window.partitionBy(*partition_cols).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(counts.withColumn("__off", F.coalesce(F.sum("__n").over(wo), F.lit(0))).drop("__n"), "rank-offsets")
    joined = null_safe_join(keyed, offsets, [*partition_cols, b])
    wi = Window.partitionBy(*partition_cols, b).orderBy(h, key_col, *([tie] if tie else []))
    return joined.withColumn(rank_col, (F.row_number().over(wi) + F.col("__off")).cast("bigint")).drop(h, b, "__off")


def running_totals(
    df: DataFrame,
    order_col: str,
    sum_cols: Sequence[str],
    descending: bool = False,
    partition_cols: Sequence[str] = (),
    prefix: str = "cum_",
) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in ``order_col`` order inside
    ``partition_cols`` (ties must be pre-aggregated: one row per distinct
    order value and partition).

    Rows are dealt by ranges of (partition, order value) and written, so that a
    row's range is fixed; the sums of the ranges (as many rows as ranges, and
    partitions that meet them) give each range its offset, and a window runs
    inside each range.
    """
    key, b = "__k", "__b"
    parts = list(partition_cols)
    data = df.withColumn(key, (-F.col(order_col) if descending else F.col(order_col)).cast("double"))
    path = scratch_path(df.sparkSession, "running-totals")
    data.repartitionByRange(*parts, key).withColumn(b, F.spark_partition_id()).write.parquet(path)
    ranged = df.sparkSession.read.parquet(path)
    totals = ranged.groupBy(*parts, b).agg(*[F.sum(c).alias(f"__t{i}") for i, c in enumerate(sum_cols)])
    wo = Window.partitionBy(*parts).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*parts, b, *[F.coalesce(F.sum(f"__t{i}").over(wo), F.lit(0)).alias(f"__o{i}")
                                         for i in range(len(sum_cols))])
    joined = null_safe_join(ranged, offsets, [*parts, b])
    wi = Window.partitionBy(*parts, b).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    out = joined.withColumns({
        f"{prefix}{c}": F.sum(c).over(wi) + F.col(f"__o{i}") for i, c in enumerate(sum_cols)
    })
    return out.drop(key, b, *[f"__o{i}" for i in range(len(sum_cols))])
