"""Cleaning: mean imputation, whole-row duplicates, completeness checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import as_double, is_missing
from strata.operators.profile import missing_total


class IncompleteTableError(ValueError):
    """Raised by ``assert_complete`` when missing values remain."""


def fit_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Means of ``cols`` ignoring null and NaN; one job, one row to the driver.

    An all-missing column (or an empty table) gives None instead of raising.
    """
    clean = df.select(*[as_double(df, c) for c in cols])
    row = clean.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return {c: (None if row is None else row[c]) for c in cols}


def impute(
    df: DataFrame,
    cols: Sequence[str],
    strategy: str = "mean",
    fit_on: DataFrame | None = None,
    means: dict[str, float | None] | None = None,
) -> DataFrame:
    """Replace null / NaN in ``cols`` by the column mean (columns become double).

    The means come from ``fit_on`` (default: ``df`` itself), so a model can be
    fitted on the training rows only and applied to all rows.  Columns whose
    mean is undefined stay null.
    """
    if strategy != "mean":
        raise ValueError("only strategy='mean' is supported")
    fitted = means if means is not None else fit_means(fit_on if fit_on is not None else df, cols)
    targets = set(cols)
    out = []
    for f in df.schema.fields:
        if f.name in targets:
            m = fitted.get(f.name)
            col = as_double(df, f.name)
            out.append(F.coalesce(col, F.lit(m).cast("double")).alias(f.name) if m is not None else col)
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(n_rows, n_distinct, n_duplicates) over whole rows (NaN equals NaN, null equals null).

    One ``groupBy`` on the row with map-side combine: a hot duplicated row is
    pre-aggregated in every task before the exchange.
    """
    names = list(cols) if cols is not None else df.columns
    groups = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_k"))
    return groups.agg(
        F.coalesce(F.sum("_k"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
    ).withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))


def dedup(df: DataFrame, cols: Sequence[str] | None = None, keep_min: Sequence[str] = ()) -> DataFrame:
    """Whole-row distinct, or distinct on ``cols``.

    With ``keep_min`` the surviving row of each duplicate group is the one
    with the smallest (keep_min...) tuple — repeatable, unlike
    ``dropDuplicates(cols)``, which keeps whichever row it meets first.  Same
    single shuffle on ``cols`` with map-side combine.
    """
    if cols is None:
        return df.dropDuplicates()
    if not keep_min:
        return df.dropDuplicates(list(cols))
    others = [c for c in df.columns if c not in set(cols)]
    first = F.min(F.struct(*keep_min, *[c for c in others if c not in set(keep_min)])).alias("_first")
    picked = df.groupBy(*cols).agg(first)
    return picked.select(*[F.col(c) if c in set(cols) else F.col(f"_first.{c}").alias(c) for c in df.columns])


def assert_complete(df: DataFrame, cols: Sequence[str] | None = None) -> int:
    """Raise ``IncompleteTableError`` when a missing value remains; returns 0 otherwise."""
    row = missing_total(df, cols).first()
    total = int(row["total_missing"]) if row is not None else 0
    if total:
        raise IncompleteTableError(f"{total} missing values remain")
    return 0


def missing_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows still holding a missing value, with the offending column names."""
    names = list(cols)
    flagged = F.filter(
        F.array(*[F.when(is_missing(df, c), F.lit(c)) for c in names]), lambda x: x.isNotNull()
    )
    return df.withColumn("missing_in", flagged).filter(F.size("missing_in") > 0)


__all__ = [
    "IncompleteTableError",
    "assert_complete",
    "dedup",
    "duplicate_count",
    "fit_means",
    "impute",
    "missing_violations",
]
