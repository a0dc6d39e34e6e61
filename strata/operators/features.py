"""Feature assembly, standard scaling and the layout-independent split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import as_double, rnd
from strata.functions.split import split_bucket, split_label


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features_raw", handle_invalid: str = "keep") -> DataFrame:
    """VectorAssembler; ``keep`` turns null into NaN, ``skip`` drops the row, ``error`` raises."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)


def scaler_stage(in_col: str = "features_raw", out_col: str = "features") -> StandardScaler:
    """StandardScaler with mean and (sample) std, for pipelines."""
    return StandardScaler(inputCol=in_col, outputCol=out_col, withMean=True, withStd=True)


def fit_scaling(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """(mean, sample std) per column from one aggregation."""
    clean = df.select(*[as_double(df, c) for c in cols])
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__m"), F.stddev_samp(c).alias(f"{c}__s")]
    row = clean.agg(*aggs).first()
    return {c: (row[f"{c}__m"], row[f"{c}__s"]) for c in cols}


def standard_scale(
    df: DataFrame,
    cols: Sequence[str],
    fit_on: DataFrame | None = None,
    suffix: str = "",
    digits: int | None = None,
) -> DataFrame:
    """Column form of the scaler: (x - mean) / std, statistics from ``fit_on`` (default ``df``).

    A constant column (std 0) scales to 0.0, as MLlib's scaler does.
    """
    stats = fit_scaling(fit_on if fit_on is not None else df, cols)
    targets = set(cols)
    out = []
    for f in df.schema.fields:
        if f.name not in targets or suffix:
            out.append(F.col(f.name))
        if f.name not in targets:
            continue
        m, s = stats[f.name]
        x = as_double(df, f.name)
        if m is None:
            val = F.lit(None).cast("double")
        elif not s:
            val = F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
        else:
            val = (x - F.lit(m)) / F.lit(s)
        if digits is not None:
            val = rnd(val, digits)
        out.append(val.alias(f.name + suffix))
    return df.select(*out)


def hash_split(df: DataFrame, keys: Sequence[str], train_pct: int = 80, col: str = "split") -> DataFrame:
    """Add ``col`` = 'train' / 'test' from md5 of the integer keys (independent of partitioning)."""
    return df.withColumn(col, split_label(keys, train_pct))


def split_frames(df: DataFrame, keys: Sequence[str], train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """(train, test) as two filters over one bucket expression."""
    b = split_bucket(keys)
    return df.filter(b < train_pct), df.filter(b >= train_pct)


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """``randomSplit`` as an option; depends on the partition layout of ``df``."""
    return df.randomSplit(list(weights), seed=seed)


def fold_column(keys: Sequence[str], folds: int = 5, col: str = "fold") -> Column:
    """Fold id 0..folds-1 from the same hash as the split (for CrossValidator's foldCol)."""
    return (split_bucket(keys) % F.lit(folds)).alias(col)


__all__ = [
    "assemble",
    "fit_scaling",
    "fold_column",
    "hash_split",
    "random_split",
    "scaler_stage",
    "split_frames",
    "standard_scale",
]
