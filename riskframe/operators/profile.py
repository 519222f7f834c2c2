"""Column profiles: NULL counts, distinct values, modes, moments, quantiles.

All profiles of many columns are computed in one aggregate pass where the
statistic allows it (partial aggregation on the map side, a tiny final merge).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_null, n_rows)`` for every column, one pass over the table."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"__z{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', __z{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, n_null)", "__n AS n_rows").select(
        "column", F.col("n_null").cast("bigint").alias("n_null"), F.col("n_rows").cast("bigint").alias("n_rows")
    )


def null_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns with at least one NULL, with their count."""
    return null_profile(df, cols).where(F.col("n_null") > 0)


def unpivot_values(df: DataFrame, cols: Sequence[str], value_type: str = "double",
                   ids: Sequence[str] = ()) -> DataFrame:
    """Long form ``(*ids, column, value)``; NULL values are dropped."""
    cast = df.select(*ids, *[F.col(c).cast(value_type).alias(c) for c in cols])
    long = cast.unpivot(list(ids), list(cols), "column", "value")
    return long.where(F.col("value").isNotNull())


def distinct_values(df: DataFrame, cols: Sequence[str], value_type: str = "string") -> DataFrame:
    """Distinct non-NULL ``(column, value)`` pairs (shuffled on the pair)."""
    return unpivot_values(df, cols, value_type).distinct()


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(value, n)`` per value of one column, NULL included as a group."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def mode_values(df: DataFrame, cols: Sequence[str], value_type: str = "double") -> DataFrame:
    """Most frequent non-NULL value per column; the smallest value on a tie.

    Counts per ``(column, value)`` are combined map-side; the pick is a
    ``min(struct(-count, value))`` aggregate, so no group is ever collected.
    """
    counts = unpivot_values(df, cols, value_type).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("value"))).alias("b"))
    return best.select("column", F.col("b.value").alias("value"), (-F.col("b.neg")).alias("n"))


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, mean, std)`` with the population standard deviation."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(F.col(c).cast("double")).alias(f"__m{i}"), F.stddev_pop(F.col(c).cast("double")).alias(f"__s{i}")]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', __m{i}, __s{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, mean, std)")


# ---------------------------------------------------------------------------
# Exact quantiles with linear interpolation, scalable.
# ---------------------------------------------------------------------------

#: Leading bits of a key that the first pass counts by, and that each later pass adds.
_DIGIT = 16
#: Values of one prefix that are sorted together; a prefix with more gets another digit.
_SORTED = 1 << _DIGIT
_SMALLEST_NORMAL, _LARGEST = 2.0**-1022, 1.7976931348623157e308


def with_order_key(df: DataFrame, x: str, key: str) -> DataFrame:
    """Adds a 64-bit integer that orders as the double ``x`` does: the bits of its size, negated below zero.

    Both zeros have key 0; NULL gives NULL, NaN isn't meant to come. Powers of two are exact, so
    dividing by one loses nothing and a power guessed too high or too low shows in the quotient.
    """
    size = F.abs(x)
    normal = F.least(F.greatest(size, F.lit(_SMALLEST_NORMAL)), F.lit(_LARGEST))
    df = df.withColumn("__e", F.least(F.floor(F.log2(normal)).cast("double"), F.lit(1023.0)))
    df = df.withColumn("__f", normal / F.pow(F.lit(2.0), "__e"))
    e, f = F.col("__e"), F.col("__f")
    exponent = e + F.when(f >= 2.0, 1.0).when(f < 1.0, -1.0).otherwise(0.0)
    fraction = F.when(f >= 2.0, f * 0.5).when(f < 1.0, f * 2.0).otherwise(f) - 1.0
    whole = (exponent + 1023).cast("bigint") * F.lit(1 << 52) + (fraction * 2.0**52).cast("bigint")
    tiny = (F.least(size, F.lit(_SMALLEST_NORMAL)) * 2.0**537 * 2.0**537).cast("bigint")
    bits = F.when(size < _SMALLEST_NORMAL, tiny).when(size > _LARGEST, F.lit(2047 << 52)).otherwise(whole)
    return df.withColumn("__b", bits).withColumn(key, F.when(F.col(x) < 0, -F.col("__b")).otherwise(F.col("__b"))).drop("__e", "__f", "__b")


@dataclass
class _Open:
    """Wanted ranks of a column whose keys begin with ``prefix``."""

    column: int
    prefix: int
    below: int  # rows of the column with smaller keys
    size: int
    lo: float  # smallest and largest value of the prefix
    hi: float
    ranks: list[int]


def rank_values(
    df: DataFrame,
    exprs: dict[str, Column],
    wanted: Callable[[dict[str, int]], dict[str, Iterable[int]]],
    extra_aggs: Sequence[Column] = (),
    extra_out: dict | None = None,
) -> tuple[dict[str, int], dict[tuple[str, int], float]]:
    """Counts of non-NULL, non-NaN values and the values at the wanted 0-based ranks, exactly, at any scale.

    A radix search over :func:`with_order_key`. The first pass counts the leading 16 bits of all
    columns' values, combined before the shuffle; its at most 65 536 counts a column (some hundreds
    for values of ordinary spread) are gathered and tell which prefix holds each rank that
    ``wanted`` names for the counts. A prefix of one value ends its ranks, so ties cost nothing. The
    values of a prefix with at most 65 536 rows are sorted in one group; a larger one is counted by
    its next 16 bits, at most twice more. Of the later passes one row per open prefix comes back.
    """
    names = list(exprs)
    if not names:
        return {}, {}
    if extra_aggs:
        extra = df.agg(*extra_aggs).collect()[0].asDict()
        if extra_out is not None:
            extra_out.update(extra)
    e = [F.when(~F.isnan(exprs[n].cast("double")), exprs[n].cast("double")) for n in names]

    def cells(used: Sequence[int]) -> DataFrame:
        pairs = ", ".join(f"{i}, x{i}" for i in used)
        return df.select(*[e[i].alias(f"x{i}") for i in used]).selectExpr(f"stack({len(used)}, {pairs}) AS (c, x)").where("x IS NOT NULL")

    def histogram(rows: DataFrame, left: int, *by: str) -> DataFrame:
        return with_order_key(rows, "x", "k").groupBy("c", *by, F.shiftright("k", left).alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))

    out: dict[tuple[str, int], float] = {}

    def settle(column: int, ranks: Iterable[int], buckets: Iterable, below: int = 0) -> list[_Open]:
        """Finds the bucket of each rank; returns those of more than one value."""
        again: list[_Open] = []
        for h in sorted(buckets, key=lambda h: h["b"]):
            here = [r for r in sorted(set(ranks)) if below <= r < below + h["n"]]
            if here and h["lo"] == h["hi"]:
                out.update({(names[column], r): h["lo"] for r in here})
            elif here:
                again.append(_Open(column, h["b"], below, h["n"], h["lo"], h["hi"], here))
            below += h["n"]
        return again

    left = 64 - _DIGIT
    first: dict[int, list] = {i: [] for i in range(len(names))}
    for h in histogram(cells(range(len(names))), left).toArrow().to_pylist():
        first[h["c"]].append(h)
    counts = {n: sum(h["n"] for h in first[i]) for i, n in enumerate(names)}
    ranks = wanted(counts)
    todo = [t for i, n in enumerate(names) if ranks.get(n) for t in settle(i, ranks[n], first[i])]
    while todo:
        at = df.sparkSession.sql("SELECT * FROM VALUES " + ", ".join(
            f"({t.column}, {t.prefix}L, double('{t.lo!r}'), double('{t.hi!r}'), {str(t.size <= _SORTED).lower()}, array({', '.join(f'{r - t.below}L' for r in t.ranks)}))"
            for t in todo) + " AS t(c, p, lo, hi, small, within)")  # a row per open prefix
        rows = cells(sorted({t.column for t in todo})).join(at, "c").where("x >= lo AND x <= hi").select("c", "p", "small", "within", "x")
        opened = {(t.column, t.prefix): t for t in todo}
        nexts: list[_Open] = []
        if any(t.size <= _SORTED for t in todo):
            packs = rows.where("small").groupBy("c", "p", "within").agg(F.sort_array(F.collect_list("x")).alias("xs"))
            for r in packs.select("c", "p", F.transform("within", lambda i: F.get("xs", i)).alias("v")).collect():
                t = opened[r.c, r.p]
                out.update({(names[t.column], rank): v for rank, v in zip(t.ranks, r.v)})
        if any(t.size > _SORTED for t in todo):
            hist = histogram(rows.where("NOT small"), left - _DIGIT, "p", "within")
            upto = hist.withColumn("upto", F.sum("n").over(Window.partitionBy("c", "p").orderBy("b")))
            hit = upto.where(F.exists("within", lambda i: (i < F.col("upto")) & (i >= F.col("upto") - F.col("n"))))
            for h in hit.collect():
                t = opened[h.c, h.p]
                nexts += settle(h.c, t.ranks, [h], t.below + h.upto - h.n)
        todo, left = nexts, left - _DIGIT
    return counts, out


def between_ranks(n: int, p: float) -> tuple[int, int, float]:
    """Lower rank, upper rank and the fraction between them of the ``p`` quantile of ``n`` values."""
    h = p * (n - 1)
    return math.floor(h), math.ceil(h), h - math.floor(h)


def interpolate(lo: float, hi: float, frac: float) -> float:
    return lo if frac == 0.0 or lo == hi else lo + (hi - lo) * frac


def exact_quantiles(
    df: DataFrame,
    exprs: dict[str, Column],
    probs: Sequence[float],
    extra_aggs: Sequence[Column] = (),
    extra_out: dict | None = None,
) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles (pandas / ``quantile_cont``) by :func:`rank_values`.

    ``extra_aggs`` ride along in the first pass (their values go to ``extra_out``). The result is a
    small dict (columns x probabilities numbers); a column without values gives None.
    """
    def wanted(counts: dict[str, int]) -> dict[str, list[int]]:
        return {n: [r for p in probs for r in between_ranks(c, float(p))[:2]] for n, c in counts.items() if c}

    counts, values = rank_values(df, exprs, wanted, extra_aggs, extra_out)
    result: dict[str, list[float | None]] = {n: [None] * len(probs) for n in exprs}
    for n, c in counts.items():
        for j, p in enumerate(probs if c else ()):
            lo, hi, frac = between_ranks(c, float(p))
            result[n][j] = interpolate(values[n, lo], values[n, hi], frac)
    return result


def median_and_imputed_quantiles(
    df: DataFrame,
    exprs: dict[str, Column],
    probs: Sequence[float],
    extra_aggs: Sequence[Column] = (),
    extra_out: dict | None = None,
) -> dict[str, tuple[float | None, list[float | None]]]:
    """Per column the median m, and the quantiles of the column with m in place of NULL, in one search.

    With z NULLs the value at rank r of the imputed column is the raw value at r if that is at most
    m; else m, unless the raw value at r - z is above m, which then it is.
    """
    rows_out: dict = {} if extra_out is None else extra_out
    n_of: dict[str, int] = {}

    def wanted(counts: dict[str, int]) -> dict[str, list[int]]:
        total = rows_out["__rows"]
        out = {}
        for n, c in counts.items():
            n_of[n] = total - c
            if c:
                ranks = {*between_ranks(c, 0.5)[:2]}
                for p in probs:
                    for r in between_ranks(total, float(p))[:2]:
                        ranks |= {min(r, c - 1), max(r - n_of[n], 0)}
                out[n] = sorted(ranks)
        return out

    counts, values = rank_values(df, exprs, wanted, [*extra_aggs, F.count(F.lit(1)).alias("__rows")], rows_out)
    result: dict[str, tuple[float | None, list[float | None]]] = {}
    for n, c in counts.items():
        if not c:
            result[n] = None, [None] * len(probs)
            continue
        lo, hi, frac = between_ranks(c, 0.5)
        m, z = interpolate(values[n, lo], values[n, hi], frac), n_of[n]

        def at(r: int) -> float:
            if r < c and values[n, r] <= m:
                return values[n, r]
            return max(m, values[n, r - z]) if r >= z else m

        qs = []
        for p in probs:
            lo, hi, frac = between_ranks(c + z, float(p))
            qs.append(interpolate(at(lo), at(hi), frac))
        result[n] = m, qs
    return result


def approx_quantiles(df: DataFrame, exprs: dict[str, Column], probs: Sequence[float],
                     accuracy: int = 10_000) -> dict[str, list[float | None]]:
    """One pass, rank error <= n / accuracy (the large-data option)."""
    names = list(exprs)
    if not names:
        return {}
    arr = F.array(*[F.lit(float(p)) for p in probs])
    row = df.agg(*[F.percentile_approx(exprs[n].cast("double"), arr, accuracy).alias(f"q{i}")
                   for i, n in enumerate(names)]).collect()[0]
    return {n: (list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs)) for i, n in enumerate(names)}


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``(column, p, value)`` long table of exact quantiles."""
    q = exact_quantiles(df, {c: F.col(c) for c in cols}, probs)
    rows = [(c, float(p), q[c][j]) for c in cols for j, p in enumerate(probs)]
    return df.sparkSession.createDataFrame(rows, "column string, p double, value double")


def approx_quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """Large-data option: one pass, rank error <= n / accuracy."""
    aggs = [F.percentile_approx(F.col(c).cast("double"), F.array(*[F.lit(float(p)) for p in probs]), accuracy).alias(f"q{i}")
            for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', q{i}" for i, c in enumerate(cols))
    long = wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, qs)")
    return long.select("column", F.posexplode("qs").alias("pi", "value")).select(
        "column", F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("pi") + 1).alias("p"), "value"
    )
