"""Type-aware column expressions.

Missing means null for every type and additionally NaN for float / double
columns.  ``isnan`` is never applied to strings or timestamps: it fails at
analysis for timestamps and raises a cast error for non-numeric strings under
ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_float_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, _FLOATING)


def is_numeric_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, _INTEGRAL + _FLOATING + (T.DecimalType,))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric column names in schema order, minus ``exclude``."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric_type(f.dataType) and f.name not in skip]


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for float / double columns."""
    c = F.col(name)
    if is_float_type(_dtype(df, name)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def nan_to_null(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null (float / double only), same name."""
    c = F.col(name)
    if is_float_type(_dtype(df, name)):
        return F.nanvl(c, F.lit(None).cast(_dtype(df, name))).alias(name)
    return c.alias(name)


def as_double(df: DataFrame, name: str) -> Column:
    """NaN → null, then cast to double (integers impute as 1.5, not 1)."""
    return nan_to_null(df, name).cast("double").alias(name)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double, null when den is 0 (ANSI mode raises otherwise)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """Percentage rounded half-up to ``digits`` (null when den is 0)."""
    return rnd(F.lit(100.0) * safe_ratio(num, den), digits)


def rnd(col: Column, digits: int) -> Column:
    """Half-up rounding of a published double, stable across summation orders.

    Means of decimal data often sit exactly on a rounding tie (2995.11 / 60000
    = 0.0499185); float sums in another order land a few ulps on either side.
    Rounding first to ``digits + 6`` places takes that noise off and leaves
    real digits, then the half-up rounding is decided on the decimal.
    -0.0 becomes 0.0 (adding 0.0 changes nothing else).
    """
    return F.round(F.round(col, digits + 6), digits) + F.lit(0.0)
