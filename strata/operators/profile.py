"""Profiling: row / missing counts, label distribution, describe, schema, preview.

Each report is one aggregation pass over the input (partial aggregation on the
map side, one tiny exchange), turned into long form afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import as_double, is_missing, nan_to_null, numeric_columns, pct, rnd


def _cols(df: DataFrame, cols: Sequence[str] | None, exclude: Sequence[str] = ()) -> list[str]:
    chosen = list(cols) if cols is not None else [c for c in df.columns if c not in set(exclude)]
    unknown = [c for c in chosen if c not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns {unknown}")
    return chosen


def _long(wide: DataFrame, names: Sequence[str], fields: Sequence[str], key: str = "column") -> DataFrame:
    """One-row wide aggregate with columns ``{name}__{field}`` → one row per name."""
    structs = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(n).alias(key),
            *[F.col(f"`{n}__{f}`").alias(f) for f in fields],
        )
        for i, n in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*structs)))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def schema_profile(df: DataFrame) -> DataFrame:
    """(position, column, type, nullable) from the schema; runs no job over the data."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: n_rows, n_missing, missing_pct (2 decimals), needs_imputation.

    Missing is null, or NaN on float columns.  One pass with ``count_if``.
    """
    names = _cols(df, cols)
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count_if(is_missing(df, c)).alias(f"{c}__n_missing") for c in names]
    wide = df.agg(*aggs)
    out = wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("position"),
                        F.lit(c).alias("column"),
                        F.col("__n").alias("n_rows"),
                        F.col(f"`{c}__n_missing`").alias("n_missing"),
                    )
                    for i, c in enumerate(names)
                ]
            )
        )
    )
    return out.select(
        "position",
        "column",
        "n_rows",
        "n_missing",
        pct(F.col("n_missing"), F.col("n_rows")).alias("missing_pct"),
        (F.col("n_missing") > 0).alias("needs_imputation"),
    )


def missing_total(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: total missing cells over ``cols`` and whether the table is complete."""
    names = _cols(df, cols)
    total = sum((F.count_if(is_missing(df, c)) for c in names), F.lit(0).cast("bigint"))
    return df.agg(total.alias("total_missing")).withColumn("complete", F.col("total_missing") == 0)


def missing_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows with at least one missing value in ``cols`` (a filter, pushed to the scan where possible)."""
    names = _cols(df, cols)
    cond = F.lit(False)
    for c in names:
        cond = cond | is_missing(df, c)
    return df.filter(cond)


def label_distribution(
    df: DataFrame, label: str, names: Mapping[int, str] | None = None, digits: int = 2
) -> DataFrame:
    """(label, [label_name], count, pct) ordered by label.

    The share is a window over the aggregated frame, whose size is the
    number of classes.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    out = counts.withColumn("pct", pct(F.col("count"), total, digits))
    if names:
        out = out.withColumn("label_name", decode_label(F.col(label), names))
        out = out.select(label, "label_name", "count", "pct")
    return out.orderBy(label)


def label_counts_wide(df: DataFrame, label: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """One row: total and one ``n_<class>`` column per class, by ``count_if``."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(F.col(label) == F.lit(k)).alias(f"n_{k}") for k in classes]
    return df.agg(*aggs)


def decode_label(col, names: Mapping[int, str]):
    """CASE label WHEN k THEN name ... END (unknown → null)."""
    expr = None
    for k, v in names.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr


def describe_long(df: DataFrame, cols: Sequence[str] | None = None, digits: int | None = 6) -> DataFrame:
    """Per column: count, mean, stddev (sample), min, max — one pass, long form.

    Same semantics as ``DataFrame.describe`` (nulls skipped, NaN kept) but
    typed doubles instead of strings.
    """
    names = _cols(df, cols) if cols is not None else numeric_columns(df)
    aggs = []
    for c in names:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"{c}__count"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__stddev"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    out = _long(df.agg(*aggs), names, ["count", "mean", "stddev", "min", "max"])
    if digits is not None:
        out = out.select(
            "position", "column", "count", *[rnd(c, digits).alias(c) for c in ["mean", "stddev", "min", "max"]]
        )
    return out


def feature_stats(df: DataFrame, cols: Sequence[str] | None = None, label: str | None = None, digits: int = 4) -> DataFrame:
    """mean / sample std / min / max per feature (NaN treated as missing), rounded.

    With no ``cols`` every numeric column but ``label`` is a feature.
    """
    names = _cols(df, cols) if cols is not None else numeric_columns(df, exclude=[label] if label else [])
    clean = df.select(*[as_double(df, c) for c in names])
    aggs = []
    for c in names:
        aggs += [
            F.avg(c).alias(f"{c}__mean"),
            F.stddev_samp(c).alias(f"{c}__std"),
            F.min(c).alias(f"{c}__min"),
            F.max(c).alias(f"{c}__max"),
        ]
    out = _long(clean.agg(*aggs), names, ["mean", "std", "min", "max"])
    return out.select("position", "column", *[rnd(c, digits).alias(c) for c in ["mean", "std", "min", "max"]])


def column_means(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """(column, mean, mean_reported): full-precision mean and its rounded report value."""
    clean = df.select(*[as_double(df, c) for c in cols])
    wide = clean.agg(*[F.avg(c).alias(f"{c}__mean") for c in cols])
    out = _long(wide, cols, ["mean"])
    return out.withColumn("mean_reported", rnd("mean", digits))


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First ``n`` rows in a total order (TakeOrderedAndProject, repeatable)."""
    if not order_by:
        raise ValueError("preview needs an order so the rows are repeatable")
    return df.orderBy(*order_by).limit(n)


def class_filter(df: DataFrame, label: str, value) -> DataFrame:
    return df.filter(F.col(label) == F.lit(value))


def feature_long(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), drop_missing: bool = True) -> DataFrame:
    """Unpivot ``cols`` into (by..., feature, value double); each feature drops its own missing rows."""
    names = list(cols)
    clean = df.select(*by, *[as_double(df, c) for c in names])
    long = clean.unpivot(list(by), names, "feature", "value")
    return long.filter(F.col("value").isNotNull()) if drop_missing else long


__all__ = [
    "class_filter",
    "column_means",
    "decode_label",
    "describe_long",
    "feature_long",
    "feature_stats",
    "label_counts_wide",
    "label_distribution",
    "missing_profile",
    "missing_rows",
    "missing_total",
    "nan_to_null",
    "preview",
    "row_count",
    "schema_profile",
]
