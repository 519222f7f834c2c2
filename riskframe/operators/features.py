"""Derived features and correlation-based column dropping.

Derived columns are row expressions (NULL counts as 0 in the sums, the
product does not skip NULL). The correlation drop is fitted state: the list
of dropped names is learned once and re-applied, never re-derived from the
rows being scored.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import null_sum
from ..spec import CORRELATION_THRESHOLD, SURVEY_BINARY

# Derived features and their inputs.
SMOKING_IMPACT = ("smoking_impact", ("smoker", "pack_years"))
ROW_SUMS = (
    ("clinical_severity_score", ("chest_pain", "fatigue", "xray_abnormal")),
    ("SYMPTOM_COUNT", SURVEY_BINARY),
    ("lifestyle_health_score", ("exercise_hours_per_week", "diet_quality", "healthcare_access")),
    ("respiratory_condition_score", ("copd", "asthma", "previous_tb", "chronic_cough", "shortness_of_breath")),
)


def derived_feature_exprs(columns: Sequence[str]) -> dict:
    """F1-F5 as column expressions over the columns that exist."""
    have = set(columns)
    out = {}
    name, (a, b) = SMOKING_IMPACT
    if a in have and b in have:
        out[name] = F.col(a).cast("double") * F.col(b).cast("double")
    for name, inputs in ROW_SUMS:
        avail = [c for c in inputs if c in have]
        if avail:
            out[name] = null_sum(avail)
    return out


def add_derived_features(df: DataFrame) -> DataFrame:
    exprs = derived_feature_exprs(df.columns)
    return df.withColumns(exprs) if exprs else df


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def corr_matrix(df: DataFrame, cols: Sequence[str], pairwise_complete: bool = True) -> DataFrame:
    """``(col_a, col_b, corr)`` for every pair a before b, one pass.

    Pearson on pairwise-complete rows; a constant column gives NULL (no
    division error, no NaN that would compare greater than a threshold).
    """
    cols = list(cols)
    aggs = []
    pairs = []
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            a, b = F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double")
            k = len(pairs)
            aggs.append(F.covar_pop(a, b).alias(f"c{k}"))
            if pairwise_complete:
                aggs.append(F.stddev_pop(F.when(b.isNotNull(), a)).alias(f"sa{k}"))
                aggs.append(F.stddev_pop(F.when(a.isNotNull(), b)).alias(f"sb{k}"))
            pairs.append((cols[i], cols[j]))
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    if not pairwise_complete:
        return _corr_dense(df, cols)
    wide = df.agg(*aggs)
    parts = []
    idx = {c: i for i, c in enumerate(cols)}
    for k, (a, b) in enumerate(pairs):
        sa, sb = (f"sa{k}", f"sb{k}") if pairwise_complete else (f"s{idx[a]}", f"s{idx[b]}")
        parts.append(f"'{a}', '{b}', c{k} / nullif({sa} * {sb}, 0D)")
    return wide.selectExpr(f"stack({len(pairs)}, {', '.join(parts)}) AS (col_a, col_b, corr)")


def _corr_dense(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL-free input: Pearson matrix from one Gramian aggregation (Spark ML).

    The k x k matrix (columns, not rows) comes back to the driver; a constant
    column gives NaN, reported as NULL.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    # a column that is NULL throughout has no correlation with any other
    some = df.agg(*[F.count(c).alias(c) for c in cols]).first()
    known = [c for c in cols if some[c]]
    at = {c: i for i, c in enumerate(known)}
    m = []
    if known:
        vec = VectorAssembler(inputCols=known, outputCol="__v", handleInvalid="error").transform(
            df.select(*[F.col(c).cast("double").alias(c) for c in known]))
        m = Correlation.corr(vec, "__v", "pearson").first()[0].toArray()
    rows = []
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            v = float(m[at[cols[i]]][at[cols[j]]]) if cols[i] in at and cols[j] in at else math.nan
            rows.append((cols[i], cols[j], None if math.isnan(v) else v))
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")


def correlated_to_drop(df: DataFrame, cols: Sequence[str], threshold: float = CORRELATION_THRESHOLD,
                       pairwise_complete: bool = True) -> list[str]:
    """F6 fit: drop column j when any earlier column has |corr| > threshold.

    The earlier column may itself be dropped; a NULL correlation never drops.
    The k x k matrix is tiny (columns, not rows) and is read on the driver.
    """
    cols = list(cols)
    if len(cols) < 2:
        return []
    order = {c: i for i, c in enumerate(cols)}
    drop = set()
    for r in corr_matrix(df, cols, pairwise_complete).collect():
        v = r["corr"]
        if v is None or (isinstance(v, float) and math.isnan(v)):
            continue
        if abs(float(v)) > threshold:
            drop.add(r["col_b"] if order[r["col_b"]] > order[r["col_a"]] else r["col_a"])
    return [c for c in cols if c in drop]


def build_features(df: DataFrame, exclude: Sequence[str] = (), dropped: Sequence[str] | None = None,
                   threshold: float = CORRELATION_THRESHOLD, null_free: bool = False) -> tuple[DataFrame, list[str]]:
    """derived features, then the correlation drop (fitted when ``dropped`` is None).

    ``null_free`` (true after imputation) takes the one-pass Gramian path.
    """
    out = add_derived_features(df)
    if dropped is None:
        num = numeric_columns(out, exclude)
        dropped = correlated_to_drop(out, num, threshold, pairwise_complete=not null_free)
    return out.drop(*dropped), list(dropped)
