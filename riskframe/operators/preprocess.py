"""Fit/transform preprocessing: encode, remap 1/2 flags, impute, cap, scale.

``fit`` learns every value once (a handful of aggregate passes over the
table) and returns :class:`PreprocessParams`; ``transform`` applies them as
literals in one projection, so scoring never re-infers state from the rows
it scores. The parameter table is persisted as parquet.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import clip, encode_text
from ..spec import IQR_FACTOR, TableSpec
from .profile import approx_quantiles, exact_quantiles, median_and_imputed_quantiles, mode_values

PARAM_SCHEMA = (
    "column string, role string, remap boolean, fill double, fill_text string, cap_lo double, cap_hi double, "
    "mean double, std double"
)


@dataclass
class ColumnParams:
    column: str
    role: str  # binary | numeric | categorical | target
    remap: bool = False
    fill: float | None = None
    cap_lo: float | None = None
    cap_hi: float | None = None
    mean: float | None = None
    std: float | None = None
    fill_text: str | None = None  # mode of a text category


@dataclass
class PreprocessParams:
    columns: dict[str, ColumnParams] = field(default_factory=dict)

    def to_rows(self) -> list[tuple]:
        return [
            (p.column, p.role, p.remap, p.fill, p.fill_text, p.cap_lo, p.cap_hi, p.mean, p.std)
            for p in self.columns.values()
        ]

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.to_rows(), PARAM_SCHEMA)

    @classmethod
    def from_df(cls, df: DataFrame) -> "PreprocessParams":
        out = cls()
        for r in df.collect():  # one row per column: bounded by the schema width
            out.columns[r["column"]] = ColumnParams(
                r["column"], r["role"], bool(r["remap"]), r["fill"], r["cap_lo"], r["cap_hi"], r["mean"], r["std"],
                r["fill_text"],
            )
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        self.to_df(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "PreprocessParams":
        return cls.from_df(spark.read.parquet(path))


# ---------------------------------------------------------------------------
# Encoding stage (no fitted state: the branch is chosen by the schema type)
# ---------------------------------------------------------------------------

def _is_string(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.StringType)


def encode_target_expr(df: DataFrame, spec: TableSpec) -> Column:
    """Text target -> mapping on upper-case text (unmapped -> NULL); numbers -> INT."""
    c = spec.target
    if _is_string(df, c):
        return encode_text(F.col(c), spec.target_mapping)
    return F.col(c).cast("int")


def encode_gender_expr(df: DataFrame, spec: TableSpec) -> Column:
    c = spec.gender
    if _is_string(df, c):
        return encode_text(F.col(c), spec.gender_mapping)
    return F.col(c).cast("int")


def encode(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Target and gender encoding; binary flags as INT, numerics as DOUBLE.

    NaN in a numeric column becomes NULL here, so later aggregates and
    comparisons see one kind of missing value.
    """
    out = {}
    if spec.target and spec.target in df.columns:
        out[spec.target] = encode_target_expr(df, spec)
    if spec.gender and spec.gender in df.columns:
        out[spec.gender] = encode_gender_expr(df, spec)
    for c in spec.binary:
        if c in df.columns and c not in out:
            out[c] = F.col(c).cast("int")
    for c in spec.numeric:
        if c in df.columns and c not in out:
            d = F.col(c).cast("double")
            out[c] = F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)
    return df.withColumns(out) if out else df


# ---------------------------------------------------------------------------
# Fit
# ---------------------------------------------------------------------------

class Preprocessor:
    """Learns the values ``transform`` applies."""

    def __init__(self, spec: TableSpec, iqr_factor: float = IQR_FACTOR, accuracy: int = 10_000, exact: bool = True):
        """``exact=False`` takes medians and quartiles from one ``percentile_approx``
        pass each (rank error <= n / accuracy) instead of the exact search."""
        self.spec = spec
        self.iqr_factor = iqr_factor
        self.accuracy = accuracy
        self.exact = exact

    def _medians_and_quartiles(self, df, numeric, extra_aggs, extra):
        """``{column: (median, [q1, q3] of the imputed column)}`` and the extra aggregates."""
        exprs = {c: F.col(c) for c in numeric}
        if self.exact:
            return median_and_imputed_quantiles(df, exprs, [0.25, 0.75], extra_aggs, extra)
        if extra_aggs:
            extra.update(df.agg(*extra_aggs).collect()[0].asDict())
        med = approx_quantiles(df, exprs, [0.5], self.accuracy)
        qs = approx_quantiles(df, {c: _fill(F.col(c), med[c][0]) for c in numeric}, [0.25, 0.75], self.accuracy)
        return {c: (med[c][0], qs[c]) for c in numeric}

    def fit(self, raw: DataFrame) -> PreprocessParams:
        spec = self.spec
        df = encode(raw, spec)
        binary = [c for c in spec.binary if c in df.columns]
        numeric = [c for c in spec.numeric if c in df.columns and c not in binary]
        categorical = [c for c in spec.categorical if c in df.columns and c not in binary and c not in numeric]
        params = PreprocessParams()

        # Which flags are coded 1/2 (no non-NULL value outside {1, 2}): counted in
        # the first pass of the rank search. Modes commute with the x - 1 map, so they are
        # taken on the encoded values and shifted afterwards.
        remap_aggs = [F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(1, 2)).alias(f"__x{i}")
                      for i, c in enumerate(binary)]
        extra: dict = {}
        fills: dict[str, float | None] = {}
        found = self._medians_and_quartiles(df, numeric, remap_aggs, extra) if numeric else {}
        fills.update({c: m for c, (m, _) in found.items()})
        if not numeric and remap_aggs:
            extra = df.agg(*remap_aggs).collect()[0].asDict()
        remap = {c: extra[f"__x{i}"] == 0 for i, c in enumerate(binary)}

        if binary:
            for r in mode_values(df, binary).collect():  # one row per column
                v = r["value"]
                fills[r["column"]] = (v - 1.0 if remap.get(r["column"]) else v)
        text_fills: dict[str, str | None] = {}
        if categorical:
            text_cols = [c for c in categorical if isinstance(df.schema[c].dataType, T.StringType)]
            num_cols = [c for c in categorical if c not in text_cols]
            if num_cols:
                for r in mode_values(df, num_cols).collect():
                    fills[r["column"]] = r["value"]
            if text_cols:
                for r in mode_values(df, text_cols, value_type="string").collect():
                    text_fills[r["column"]] = r["value"]

        # Quartiles after imputation -> caps.
        imputed = {c: _fill(F.col(c), fills.get(c)) for c in numeric}
        caps: dict[str, tuple[float | None, float | None]] = {}
        if numeric:
            for c in numeric:
                q1, q3 = found[c][1]
                if q1 is None or q3 is None:
                    caps[c] = (None, None)
                else:
                    iqr = q3 - q1
                    caps[c] = (q1 - self.iqr_factor * iqr, q3 + self.iqr_factor * iqr)

        # Mean / population std after capping.
        stats: dict[str, tuple[float | None, float | None]] = {}
        if numeric:
            capped = {c: clip(imputed[c], *caps[c]) for c in numeric}
            aggs = []
            for i, c in enumerate(numeric):
                aggs += [F.avg(capped[c]).alias(f"m{i}"), F.stddev_pop(capped[c]).alias(f"s{i}")]
            row = df.agg(*aggs).collect()[0]
            for i, c in enumerate(numeric):
                stats[c] = (row[f"m{i}"], row[f"s{i}"])

        for c in binary:
            params.columns[c] = ColumnParams(c, "binary", remap=remap[c], fill=fills.get(c))
        for c in categorical:
            params.columns[c] = ColumnParams(c, "categorical", fill=fills.get(c), fill_text=text_fills.get(c))
        for c in numeric:
            lo, hi = caps[c]
            m, s = stats[c]
            params.columns[c] = ColumnParams(c, "numeric", fill=fills.get(c), cap_lo=lo, cap_hi=hi, mean=m, std=s)
        if spec.target and spec.target in df.columns:
            params.columns[spec.target] = ColumnParams(spec.target, "target")
        return params


def _fill(c: Column, v: float | None) -> Column:
    return c if v is None else F.coalesce(c, F.lit(float(v)))


# ---------------------------------------------------------------------------
# Transform
# ---------------------------------------------------------------------------

def binary_expr(p: ColumnParams) -> Column:
    c = F.col(p.column)
    if p.remap:
        c = c - F.lit(1)
    if p.fill is not None:
        c = F.coalesce(c, F.lit(int(p.fill)))
    return c.cast("int")


def numeric_expr(p: ColumnParams, impute: bool = True, cap: bool = True, scale: bool = True) -> Column:
    c = F.col(p.column).cast("double")
    if impute:
        c = _fill(c, p.fill)
    if cap:
        c = clip(c, p.cap_lo, p.cap_hi)
    if scale and p.mean is not None:
        std = p.std if p.std not in (None, 0.0) else 1.0
        c = (c - F.lit(p.mean)) / F.lit(std)
    return c


def transform(raw: DataFrame, spec: TableSpec, params: PreprocessParams, scale: bool = True,
              impute: bool = True, cap: bool = True) -> DataFrame:
    """Apply learned values; one projection, target moved to the end."""
    df = encode(raw, spec)
    exprs = {}
    for name, p in params.columns.items():
        if name not in df.columns:
            continue
        if p.role == "binary":
            exprs[name] = binary_expr(p) if impute else (F.col(name) - F.lit(1) if p.remap else F.col(name)).cast("int")
        elif p.role == "categorical":
            if not impute:
                exprs[name] = F.col(name)
            elif p.fill_text is not None:
                exprs[name] = F.coalesce(F.col(name), F.lit(p.fill_text))
            else:
                exprs[name] = _fill(F.col(name), p.fill)
        elif p.role == "numeric":
            exprs[name] = numeric_expr(p, impute=impute, cap=cap, scale=scale)
    out = df.withColumns(exprs) if exprs else df
    if spec.target and spec.target in out.columns:
        cols = [c for c in out.columns if c != spec.target] + [spec.target]
        out = out.select(*cols)
    return out


def preprocess(raw: DataFrame, spec: TableSpec, params: PreprocessParams | None = None,
               **fit_kw) -> tuple[DataFrame, PreprocessParams]:
    """Fit when no parameters are given, then transform."""
    if params is None:
        params = Preprocessor(spec, **fit_kw).fit(raw)
    return transform(raw, spec, params), params


# ---------------------------------------------------------------------------
# Single-purpose operators (the reference's helpers, generic)
# ---------------------------------------------------------------------------

def iqr_caps(df: DataFrame, cols: Sequence[str], factor: float = IQR_FACTOR) -> dict:
    """``{col: (q1, q3, lo, hi)}`` of the IQR rule."""
    qs = exact_quantiles(df, {c: F.col(c) for c in cols}, [0.25, 0.75])
    out = {}
    for c in cols:
        q1, q3 = qs[c]
        if q1 is None:
            out[c] = (None, None, None, None)
        else:
            out[c] = (q1, q3, q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return out


def cap_outliers_iqr(df: DataFrame, cols: Sequence[str], factor: float = IQR_FACTOR) -> DataFrame:
    """Clip every listed column to its [Q1 - f IQR, Q3 + f IQR]."""
    caps = iqr_caps(df, cols, factor)
    return df.withColumns({c: clip(F.col(c).cast("double"), caps[c][2], caps[c][3]) for c in cols})


def outlier_counts(df: DataFrame, cols: Sequence[str], factor: float = IQR_FACTOR) -> DataFrame:
    """``(column, q1, q3, cap_lo, cap_hi, n_outliers)``."""
    caps = iqr_caps(df, cols, factor)
    aggs = []
    for i, c in enumerate(cols):
        lo, hi = caps[c][2], caps[c][3]
        cond = (F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi)) if lo is not None else F.lit(False)
        aggs.append(F.count_if(cond).alias(f"o{i}"))
    wide = df.agg(*aggs)
    parts = ", ".join(
        f"'{c}', CAST({_lit(caps[c][0])} AS DOUBLE), CAST({_lit(caps[c][1])} AS DOUBLE), "
        f"CAST({_lit(caps[c][2])} AS DOUBLE), CAST({_lit(caps[c][3])} AS DOUBLE), o{i}"
        for i, c in enumerate(cols)
    )
    return wide.selectExpr(f"stack({len(cols)}, {parts}) AS (column, q1, q3, cap_lo, cap_hi, n_outliers)")


def _lit(v) -> str:
    return "NULL" if v is None else repr(float(v))


def standard_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / std_pop, zero std divides by 1."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}")]
    row = df.agg(*aggs).collect()[0]
    exprs = {}
    for i, c in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        if m is None:
            continue
        exprs[c] = (F.col(c).cast("double") - F.lit(m)) / F.lit(s if s else 1.0)
    return df.withColumns(exprs)


def remap_binary(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict[str, bool]]:
    """Remap 1/2 flags to 0/1 where a column holds nothing outside {1, 2}."""
    row = df.agg(*[
        F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(1, 2)).alias(f"x{i}") for i, c in enumerate(cols)
    ]).collect()[0]
    flags = {c: row[f"x{i}"] == 0 for i, c in enumerate(cols)}
    return df.withColumns({c: (F.col(c) - F.lit(1)).cast("int") for c in cols if flags[c]}), flags


def impute(df: DataFrame, numeric: Sequence[str], modal: Sequence[str]) -> tuple[DataFrame, dict]:
    """Numeric NULL <- median, flag/category NULL <- mode (lowest on a tie)."""
    fills: dict[str, float | None] = {}
    if numeric:
        med = exact_quantiles(df, {c: F.col(c) for c in numeric}, [0.5])
        fills.update({c: med[c][0] for c in numeric})
    if modal:
        for r in mode_values(df, modal).collect():
            fills[r["column"]] = r["value"]
    exprs = {}
    for c in numeric:
        exprs[c] = _fill(F.col(c).cast("double"), fills.get(c))
    for c in modal:
        v = fills.get(c)
        exprs[c] = F.col(c) if v is None else F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
    return df.withColumns(exprs), fills


def fill_missing_columns(df: DataFrame, required, default=0) -> DataFrame:
    """Add every absent required column with a constant default."""
    missing = {c: F.lit(default) for c in required if c not in df.columns}
    return df.withColumns(missing) if missing else df
