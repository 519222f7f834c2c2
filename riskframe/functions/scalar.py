"""Scalar column expressions."""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import NEGATIVE_LABEL_TEXT, POSITIVE_LABEL_TEXT, RISK_BANDS, RISK_TOP_BAND


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode_text(col: Column | str, mapping: Mapping[str, int]) -> Column:
    """Upper-case a text column and look it up; unmapped text gives NULL."""
    c = F.upper(_c(col).cast("string"))
    expr = None
    for k, v in mapping.items():
        cond = c == F.lit(str(k).upper())
        expr = F.when(cond, F.lit(int(v))) if expr is None else expr.when(cond, F.lit(int(v)))
    return expr.otherwise(F.lit(None).cast("int")) if expr is not None else F.lit(None).cast("int")


def clip(col: Column | str, lo: float | None, hi: float | None) -> Column:
    """Clip to [lo, hi] keeping NULL (``greatest``/``least`` would skip NULL)."""
    c = _c(col)
    if lo is None and hi is None:
        return c
    out = None
    if lo is not None:
        out = F.when(c < F.lit(lo), F.lit(lo))
    if hi is not None:
        out = F.when(c > F.lit(hi), F.lit(hi)) if out is None else out.when(c > F.lit(hi), F.lit(hi))
    return out.otherwise(c)


def null_sum(cols: Iterable[Column | str]) -> Column:
    """Row sum that treats NULL as 0 (pandas row sums skip missing)."""
    parts = [F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in cols]
    if not parts:
        return F.lit(0.0)
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def logistic(score: Column, center: float = 0.4, slope: float = 10.0) -> Column:
    """``1 / (1 + exp(-(score - center) * slope))``."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(score - F.lit(center)) * F.lit(slope)))


def risk_level(p: Column | str) -> Column:
    """Risk band of an unrounded probability."""
    c = _c(p)
    out = None
    for bound, name in RISK_BANDS:
        out = F.when(c < F.lit(bound), F.lit(name)) if out is None else out.when(c < F.lit(bound), F.lit(name))
    return out.otherwise(F.lit(RISK_TOP_BAND))


def label_text(pred: Column | str) -> Column:
    return F.when(_c(pred) == 1, F.lit(POSITIVE_LABEL_TEXT)).otherwise(F.lit(NEGATIVE_LABEL_TEXT))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when the denominator is 0 (the library's zero_division=0)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))
