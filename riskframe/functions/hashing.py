"""Hash-of-key randomness.

``rand()``, ``randomSplit`` and ``monotonically_increasing_id`` depend on the
partitioning, so a re-run after an executor loss could give other rows. All
randomness here is a pure function of ``(seed, stream, key)`` through md5,
which Spark and DuckDB compute identically.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_52 = float(2**52)


def hash_key(seed: int, stream: str, key: Column | str) -> Column:
    """md5 hex of ``"seed:stream:key"``."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(stream), k.cast("string")))


def uniform(seed: int, stream: str, key: Column | str) -> Column:
    """U[0,1) from the first 52 bits of the md5 hex (exact in a double)."""
    h = hash_key(seed, stream, key)
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(_TWO_52)


def hash_bucket(hex_col: Column, chars: int) -> Column:
    """Integer bucket from the first ``chars`` hex characters of an md5 column."""
    return F.conv(F.substring(hex_col, 1, chars), 16, 10).cast("bigint")


def sql_uniform(seed: int, stream: str, key_sql: str) -> str:
    """DuckDB text of :func:`uniform` for oracles and tests."""
    return (
        f"(CAST(('0x' || substr(md5('{seed}:{stream}:' || CAST({key_sql} AS VARCHAR)), 1, 13))::BIGINT AS DOUBLE)"
        f" / CAST(4503599627370496 AS DOUBLE))"
    )
