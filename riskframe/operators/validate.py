"""Validation: required columns, types, value domains, row rules, quarantine.

Table-level checks collect every problem before raising (the reference
collects domain errors and raises them together). Row-level rules never
raise: each row gets an ``errors`` array, empty for accepted rows, and the
quarantine is the complement; ``errors[0]`` is the message the single-record
validator would have raised first.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import Rule, TableSpec


class ValidationError(ValueError):
    pass


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in required if c not in have]


def check_columns(df: DataFrame, required: Iterable[str]) -> None:
    """V1: raise listing every absent required column (metadata only)."""
    miss = missing_columns(df, required)
    if miss:
        raise ValidationError(f"Missing required columns: {miss}")


def check_numeric(df: DataFrame, cols: Iterable[str]) -> None:
    """V2: raise when a listed column is present but not numeric."""
    bad = [c for c in cols if c in df.columns and not isinstance(df.schema[c].dataType, T.NumericType)]
    if bad:
        raise ValidationError(f"Non-numeric columns: {bad}")


def schema_report(df: DataFrame, spec: TableSpec, numeric_check: Sequence[str] = ()) -> list[tuple[str, bool, bool | None]]:
    """(column, present, numeric) for each required column."""
    out = []
    for c in spec.required:
        present = c in df.columns
        num = isinstance(df.schema[c].dataType, T.NumericType) if present else None
        out.append((c, present, num if (not numeric_check or c in numeric_check) else None))
    return out


def domain_violations(df: DataFrame, cols: Sequence[str], allowed: Sequence = (0, 1)) -> DataFrame:
    """V3: ``(column, value, n)`` for every distinct value outside ``allowed``; NULL is ignored.

    Counts per (column, value) are combined map-side.
    """
    cols = [c for c in cols if c in df.columns]
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    bad = long.where(F.col("value").isNotNull() & ~F.col("value").isin(*[float(a) for a in allowed]))
    return bad.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


#: Distinct bad values that an error message spells out per column; the table has them all.
SHOWN = 100


def domain_messages(df: DataFrame, cols: Sequence[str], allowed: Sequence = (0, 1)) -> list[str]:
    """One message per column with bad values: their number and the smallest of them."""
    w = Window.partitionBy("column").orderBy("value")
    bad = domain_violations(df, cols, allowed)
    n = bad.groupBy("column").agg(F.count(F.lit(1)).alias("n_bad"))
    shown = bad.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= SHOWN).groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("v"))
    out = {}
    for r in n.join(shown, "column").collect():  # one row per bad column
        more = f" and {r['n_bad'] - len(r['v'])} more" if r["n_bad"] > len(r["v"]) else ""
        out[r["column"]] = f"{r['column']} has invalid values: {','.join(map(str, r['v']))}{more}"
    return [out[c] for c in cols if c in out]


def validate_data(df: DataFrame, spec: TableSpec, numeric_check: Sequence[str] = ("age", "gender")) -> bool:
    """V1-V3 together: absent columns raise at once; types and the 0/1 domains
    of the flags and the target are checked together and raised in one error."""
    check_columns(df, spec.required)
    errors = [f"{c} is not numeric" for c in numeric_check if c in df.columns and not _is_numeric_type(df, c)]
    cols = [c for c in (*spec.binary, spec.target) if c and _is_numeric_type(df, c)]
    errors += domain_messages(df, cols)
    if errors:
        raise ValidationError("Data validation failed: " + "; ".join(errors))
    return True


# ---------------------------------------------------------------------------
# Row rules
# ---------------------------------------------------------------------------

def _is_numeric_type(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.NumericType)


def rule_violation(df: DataFrame, rule: Rule) -> Column:
    """Boolean column: the row breaks the rule (a missing column breaks every row)."""
    if rule.column not in df.columns:
        return F.lit(True)
    c = F.col(rule.column)
    if rule.kind == "required":
        return c.isNull()
    if rule.kind == "range":
        num = c.cast("double") if _is_numeric_type(df, rule.column) else c.cast("string").try_cast("double")
        bad = c.isNotNull() & num.isNull()
        if rule.lo is not None:
            bad = bad | (num < F.lit(float(rule.lo)))
        if rule.hi is not None:
            bad = bad | (num > F.lit(float(rule.hi)))
        return F.coalesce(bad, F.lit(False))
    if rule.kind == "in":
        allowed = list(rule.allowed or ())
        if _is_numeric_type(df, rule.column) and all(isinstance(a, (int, float)) for a in allowed):
            inside = c.isin(*allowed)
        else:
            text = c.cast("string")
            if rule.upper:
                text = F.upper(text)
            inside = text.isin(*[str(a).upper() if rule.upper else str(a) for a in allowed])
        return c.isNotNull() & ~inside
    if rule.kind == "numeric":
        return c.isNotNull() & c.cast("string").try_cast("double").isNull()
    raise ValueError(f"unknown rule kind {rule.kind}")


def with_errors(df: DataFrame, rules: Sequence[Rule], col: str = "errors") -> DataFrame:
    """Add ``errors ARRAY<STRING>`` with the codes of every broken rule, in rule order."""
    codes = [F.when(rule_violation(df, r), F.lit(r.error_code)) for r in rules]
    return df.withColumn(col, F.array_compact(F.array(*codes)) if codes else F.array().cast("array<string>"))


def quarantine_split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows without ``errors``, quarantined rows with ``errors``)."""
    tagged = with_errors(df, rules)
    accepted = tagged.where(F.size("errors") == 0).drop("errors")
    quarantined = tagged.where(F.size("errors") > 0)
    return accepted, quarantined
