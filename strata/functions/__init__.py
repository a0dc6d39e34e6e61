"""Column-level building blocks (missing-value predicates, hash split, formatting)."""

from strata.functions.columns import (
    as_double,
    is_float_type,
    is_missing,
    is_numeric_type,
    nan_to_null,
    numeric_columns,
    pct,
    rnd,
    safe_ratio,
)
from strata.functions.split import split_bucket, split_label

__all__ = [
    "as_double",
    "is_float_type",
    "is_missing",
    "is_numeric_type",
    "nan_to_null",
    "numeric_columns",
    "pct",
    "rnd",
    "safe_ratio",
    "split_bucket",
    "split_label",
]
