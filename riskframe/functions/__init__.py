"""Column expressions (JVM-side, codegen) used by the operators."""

from .hashing import hash_bucket, hash_key, uniform
from .scalar import (
    clip,
    encode_text,
    logistic,
    null_sum,
    risk_level,
    safe_ratio,
)

__all__ = [
    "hash_bucket",
    "hash_key",
    "uniform",
    "clip",
    "encode_text",
    "logistic",
    "null_sum",
    "risk_level",
    "safe_ratio",
]
