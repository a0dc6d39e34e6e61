"""Correlation, histograms and box statistics, computed on executors.

* correlation: one aggregation with n(n+1)/2 ``corr`` terms, or for wide
  vectors Gram matrices summed by task and cell (pairwise complete: a pair
  skips rows where either side is missing).
* histogram: per (feature, class) bounds in one aggregation, then bins in a
  second aggregation with the bounds broadcast (size-checked); empty bins
  are emitted with count 0.
* box statistics: exact quartiles from range slices, of which only those that
  hold a wanted rank are sorted (or ``percentile_approx`` with a bounded
  sketch); whiskers and outlier counts from the slices' ends and totals, and
  the rows of slices that a fence cuts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import as_double, rnd
from strata.operators.profile import feature_long
from strata.operators.ranking import Running, quantiles_from_counts, value_counts
from strata.plans.physical import join_groups, materialize


def correlation_long(df: DataFrame, cols: Sequence[str], digits: int | None = 6) -> DataFrame:
    """Full Pearson matrix in long form: (i, j, col_a, col_b, corr)."""
    names = list(cols)
    clean = df.select(*[as_double(df, c) for c in names])
    aggs, cells = [], []
    for i, a in enumerate(names):
        for j in range(i, len(names)):
            b = names[j]
            aggs.append(F.corr(a, b).alias(f"c_{i}_{j}"))
    wide = clean.agg(*aggs)
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            lo, hi = min(i, j), max(i, j)
            val = F.col(f"c_{lo}_{hi}")
            if digits is not None:
                val = rnd(val, digits)
            cells.append(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), val.alias("corr")))
    return wide.select(F.inline(F.array(*cells)))


def correlation_vector(df: DataFrame, vec_col: str, names: Sequence[str] | None = None, digits: int | None = 6) -> DataFrame:
    """Pearson matrix of a vector / array column in long form (i, j, col_a, col_b, corr), pairwise complete.

    For wide inputs each task sums the Gram matrices of its rows, and those of
    their masks, with matrix products; the cells of all tasks meet in one
    grouped sum, so no matrix reaches the driver.  A pair skips the rows where
    either side is null, NaN or beyond the vector's end; values are taken
    relative to the first row's, so that a large mean costs no digits.  A task
    holds 32 bytes a cell; null vectors and empty tables give no cells.
    """
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import types as T

    array = F.col(vec_col) if isinstance(df.schema[vec_col].dataType, T.ArrayType) else vector_to_array(F.col(vec_col))
    vec = df.select(array.cast("array<double>").alias("_v")).where("_v is not null")
    first = vec.first()
    shift = np.nan_to_num(np.array(first["_v"] if first else [], float))  # one vector

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, 0, 0))
        for batch in batches:
            x = _padded(batch["_v"], len(shift))
            x[:, : len(shift)] -= shift
            grown = np.zeros((4, max(x.shape[1], sums.shape[1]), max(x.shape[1], sums.shape[1])))
            grown[:, : sums.shape[1], : sums.shape[1]] = sums
            there = ~np.isnan(x)
            x, m = np.where(there, x, 0.0), there.astype(float)
            for k, (left, right) in enumerate(((m, m), (x, m), (x * x, m), (x, x))):
                grown[k, : x.shape[1], : x.shape[1]] += left.T @ right
            sums = grown
        n, sx, sxx, sxy = sums
        for i in range(len(n)):  # one row of cells at a time
            j = np.arange(i, len(n))
            cells = (np.full(len(j), i, np.int32), j.astype(np.int32), n[i, i:], sx[i, i:], sx[i:, i], sxx[i, i:], sxx[i:, i], sxy[i, i:])
            yield pa.RecordBatch.from_arrays([*map(pa.array, cells)], names=_CELL)

    kinds = "i int, j int, " + ", ".join(f"{c} double" for c in _CELL[2:])
    cell = vec.mapInArrow(partial, kinds).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in _CELL[2:]])
    spread = lambda s, q: F.col(q) - F.col(s) * F.col(s) / F.col("n")
    both = spread("sx", "sxx") * spread("sy", "syy")
    corr = F.when((F.col("n") > 1) & (both > 0), (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / F.sqrt(both))
    half = cell.select("i", "j", (rnd(corr, digits) if digits is not None else corr).alias("corr"))
    whole = half.unionByName(half.where("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "corr"))
    given = F.array(*map(F.lit, names)) if names is not None else None
    label = lambda c: F.element_at(given, F.col(c) + 1) if names is not None else F.concat(F.lit(f"{vec_col}["), F.col(c).cast("string"), F.lit("]"))
    return whole.select("i", "j", label("i").alias("col_a"), label("j").alias("col_b"), "corr")


_CELL = ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"]


def _padded(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Rows of at least ``width`` columns, NaN for nulls and beyond a vector's end."""
    length = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    out = np.full((len(length), max(width, length.max(initial=0))), np.nan)
    row = np.repeat(np.arange(len(length)), length)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
    return out


def correlation_lower(corr_long: DataFrame) -> DataFrame:
    """Strict lower triangle (the complement of the upper-triangle mask)."""
    return corr_long.filter(F.col("i") > F.col("j"))


def histogram(
    df: DataFrame,
    cols: Sequence[str],
    by: Sequence[str] = (),
    bins: int = 40,
    density: bool = True,
    digits: int | None = 8,
) -> DataFrame:
    """Equal-width histogram per (feature, by...) like ``numpy.histogram``.

    Returns (feature, by..., bin, lo, hi, count, [density]).  The last bin is
    closed; a constant group is widened to [v - 0.5, v + 0.5].
    """
    if bins < 1:
        raise ValueError("bins must be positive")
    keys = ["feature", *by]
    long = feature_long(df, cols, by)
    bounds = long.groupBy(*keys).agg(
        F.min("value").alias("_min"), F.max("value").alias("_max"), F.count(F.lit(1)).alias("_n")
    )
    same = F.col("_min") == F.col("_max")
    bounds = bounds.select(
        *keys,
        F.when(same, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_lo"),
        F.when(same, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("_hi"),
        "_n",
    ).withColumn("_w", (F.col("_hi") - F.col("_lo")) / F.lit(float(bins)))
    binned = join_groups(long, bounds, keys).select(
        *keys,
        F.least(F.floor((F.col("value") - F.col("_lo")) / F.col("_w")).cast("int"), F.lit(bins - 1)).alias("bin"),
    )
    counts = binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = bounds.select(*keys, "_lo", "_w", "_n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = join_groups(grid, counts, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_w")).alias("lo"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
        "_n",
        "_w",
    )
    cols_out = [*keys, "bin", "lo", "hi", "count"]
    if digits is not None:
        out = out.withColumn("lo", rnd("lo", digits)).withColumn("hi", rnd("hi", digits))
    if density:
        dens = F.col("count") / (F.col("_n") * F.col("_w"))
        out = out.withColumn("density", rnd(dens, digits) if digits is not None else dens)
        cols_out.append("density")
    return out.select(*cols_out)


def box_stats(
    df: DataFrame,
    cols: Sequence[str],
    by: Sequence[str] = (),
    whisker: float = 1.5,
    method: str = "exact",
    accuracy: int = 10_000,
    digits: int | None = 6,
) -> DataFrame:
    """Per (feature, by...): n, q1, median, q3, iqr, fences, whiskers, outlier count.

    Whiskers are the most extreme *data* values inside the fences.
    ``method='exact'`` interpolates linearly like ``percentile``;
    ``method='approx'`` uses ``percentile_approx`` (bounded memory per group).
    """
    keys = ["feature", *by]
    long = feature_long(df, cols, by)
    if method == "exact":
        # (feature, class, value, count): far smaller than the rows when values repeat
        q, run = quantiles_from_counts(value_counts(long, keys, "value"), keys, "value", [0.25, 0.5, 0.75])
        quart = q.groupBy(*keys).agg(
            F.first("n").alias("n"),
            F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
            F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
            F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"),
        )
    elif method == "approx":
        pa = F.percentile_approx("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), accuracy)
        run = None
        quart = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), pa.alias("_q")).select(
            *keys, "n", F.col("_q")[0].cast("double").alias("q1"), F.col("_q")[1].cast("double").alias("median"), F.col("_q")[2].cast("double").alias("q3")
        )
    else:
        raise ValueError("method must be 'exact' or 'approx'")
    iqr = F.col("q3") - F.col("q1")
    fences = quart.select(
        *keys,
        "n",
        "q1",
        "median",
        "q3",
        iqr.alias("iqr"),
        (F.col("q1") - F.lit(whisker) * iqr).alias("lo_fence"),
        (F.col("q3") + F.lit(whisker) * iqr).alias("hi_fence"),
    )
    edges = fences.select(*keys, "lo_fence", "hi_fence")
    tails = _tails(long.withColumn("_c", F.lit(1)), edges, keys) if run is None else _sliced_tails(run, materialize(edges, "fences"), keys)
    # both sides hold one row per (feature, class)
    out = join_groups(tails, fences, keys).withColumn(
        "n_outliers", F.col("n_low") + F.col("n_high")
    )
    dbl = ["q1", "median", "q3", "iqr", "lo_fence", "hi_fence", "whisker_lo", "whisker_hi"]
    if digits is not None:
        for c in dbl:
            out = out.withColumn(c, rnd(c, digits))
    return out.select(*keys, "n", *dbl, "n_low", "n_high", "n_outliers")


_TAILS = ("whisker_lo", F.min), ("whisker_hi", F.max), ("n_low", F.sum), ("n_high", F.sum)


def _tails(counts: DataFrame, edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., whisker_lo, whisker_hi, n_low, n_high) of (keys..., value, _c) rows."""
    v, c = F.col("value"), F.col("_c")
    inside = (v >= F.col("lo_fence")) & (v <= F.col("hi_fence"))
    return join_groups(counts, edges, keys).groupBy(*keys).agg(
        F.min(F.when(inside, v)).alias("whisker_lo"),
        F.max(F.when(inside, v)).alias("whisker_hi"),
        F.coalesce(F.sum(F.when(v < F.col("lo_fence"), c)), F.lit(0)).cast("bigint").alias("n_low"),
        F.coalesce(F.sum(F.when(v > F.col("hi_fence"), c)), F.lit(0)).cast("bigint").alias("n_high"),
    )


def _sliced_tails(run: Running, edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same, reading only rows of slices that a fence cuts; the others are judged by their totals and ends."""
    lo, hi, low, high, t = (F.col(c) for c in ("lo_fence", "hi_fence", "_low", "_high", "_t__c"))
    judged = join_groups(run.slices, edges, keys)
    cut = (low <= hi) & (high >= lo) & ((low < lo) | (high > hi))
    inside = (low >= lo) & (high <= hi)
    whole = judged.filter(~cut).select(
        *keys,
        F.when(inside, low).alias("whisker_lo"),
        F.when(inside, high).alias("whisker_hi"),
        F.when(high < lo, t).otherwise(0).cast("bigint").alias("n_low"),
        F.when(low > hi, t).otherwise(0).cast("bigint").alias("n_high"),
    )
    rows = join_groups(run.stored, materialize(judged.filter(cut).select("_slice", *keys), "cut"), ["_slice", *keys]).drop("_slice")
    return whole.unionByName(_tails(rows, edges, keys)).groupBy(*keys).agg(*[f(c).alias(c) for c, f in _TAILS])


def outlier_rows(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), whisker: float = 1.5, method: str = "exact") -> DataFrame:
    """Long (by..., feature, value) rows lying outside their group's fences."""
    keys = ["feature", *by]
    stats = box_stats(df, cols, by, whisker=whisker, method=method, digits=None)
    long = feature_long(df, cols, by)
    # stored, so that its size is known before the join: the rows are neither shuffled nor sorted by their few groups
    joined = join_groups(long, materialize(stats.select(*keys, "lo_fence", "hi_fence"), "fences"), keys)
    return joined.filter((F.col("value") < F.col("lo_fence")) | (F.col("value") > F.col("hi_fence"))).drop(
        "lo_fence", "hi_fence"
    )


__all__ = ["box_stats", "correlation_long", "correlation_lower", "histogram", "outlier_rows"]
