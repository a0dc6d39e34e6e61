"""Data-quality and regression checks expressed as single aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import as_double, rnd, safe_ratio


def range_violations(df: DataFrame, rules: Sequence[tuple[str, float | None, float | None]]) -> DataFrame:
    """(column, lo, hi, n_checked, n_violations) for each (column, lo, hi) rule, in one pass.

    Missing values are not checked; a None bound is open.
    """
    aggs, cells = [], []
    for i, (c, lo, hi) in enumerate(rules):
        x = as_double(df, c)
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (x < F.lit(float(lo)))
        if hi is not None:
            bad = bad | (x > F.lit(float(hi)))
        aggs += [F.count(x).alias(f"_c{i}"), F.count_if(bad).alias(f"_v{i}")]
        cells.append(
            F.struct(
                F.lit(c).alias("column"),
                F.lit(lo).cast("double").alias("lo"),
                F.lit(hi).cast("double").alias("hi"),
                F.col(f"_c{i}").alias("n_checked"),
                F.col(f"_v{i}").alias("n_violations"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def regression_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = (), digits: int | None = 6) -> DataFrame:
    """n, RMSE, MAE and R² per group from one aggregation (closed form), over the rows that have both values."""
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    err = y - p
    out = df.where(y.isNotNull() & p.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        # null for a constant target (ANSI mode raises on x / 0.0)
        (F.lit(1.0) - safe_ratio(F.sum(err * err), F.count(F.lit(1)) * F.var_pop(y))).alias("r2"),
    )
    if digits is not None:
        for c in ("rmse", "mae", "r2"):
            out = out.withColumn(c, rnd(F.col(c), digits))
    return out


def grouped_describe(df: DataFrame, value: str, by: Sequence[str], digits: int | None = 6) -> DataFrame:
    """count / mean / stddev / min / max of one value column per class (one grouped pass)."""
    x = F.col(value).cast("double")
    stats = {
        "mean": F.avg(x),
        "stddev": F.stddev_samp(x),
        "min": F.min(x),
        "max": F.max(x),
    }
    cols = [F.count(x).alias("count")]
    cols += [(rnd(e, digits) if digits is not None else e).alias(k) for k, e in stats.items()]
    return df.groupBy(*by).agg(*cols)


__all__ = ["grouped_describe", "range_violations", "regression_metrics"]
