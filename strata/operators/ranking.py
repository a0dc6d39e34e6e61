"""Exact running totals and quantiles without funnelling a group into one task.

A window ``PARTITION BY group ORDER BY key`` puts a whole group on one task;
when one class or model holds a third of all rows that task holds a third of
the data.  Here the (pre-aggregated) rows are range-partitioned on
(group, key) instead, so a hot group is cut into many slices.  Each slice
computes its local running sum; the totals of earlier slices of the same group
(a frame of at most slices + groups rows) are added as an offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.plans.physical import join_groups, materialize


class Running:
    """Result of ``running_totals``: rows with ``cum_<w>``, per-group totals, the stored input (with ``_slice``) and its slices."""

    def __init__(self, rows: DataFrame, totals: DataFrame, stored: DataFrame, slices: DataFrame):
        self.rows = rows
        self.totals = totals
        self.stored = stored
        self.slices = slices


def running_totals(
    df: DataFrame,
    group_cols: Sequence[str],
    order_col: str,
    weight_cols: Sequence[str],
    slices: int | None = None,
) -> Running:
    """Inclusive running sum ``cum_<w>`` of each weight within its group, in ``order_col`` order.

    ``df`` must be unique on (group_cols, order_col) — aggregate first.  The
    range-partitioned rows are stored once with their slice id, so the slice
    totals and the local sums always agree, also after executor loss.
    ``slices`` has, per (slice, group), the totals ``_t_<w>``, the totals of the
    group's earlier slices ``_o_<w>`` and the least and greatest key
    (``_low``, ``_high``); it holds at most slices + groups - 1 rows.
    """
    groups = list(group_cols)
    # Range bounds are sampled from ``df``; an aggregated input is re-read from its
    # shuffle files for that, not recomputed.  Without an explicit slice count AQE
    # may merge adjacent small ranges; slices stay contiguous either way.
    keys = [*groups, order_col]
    ranged = df.repartitionByRange(int(slices), *keys) if slices else df.repartitionByRange(*keys)
    ranged = ranged.withColumn("_slice", F.spark_partition_id())
    stored = materialize(ranged, "ranked")
    totals = stored.groupBy("_slice", *groups).agg(
        *[F.sum(w).alias(f"_t_{w}") for w in weight_cols], F.min(order_col).alias("_low"), F.max(order_col).alias("_high")
    )
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # a written table has a known size, so the joins with it below are broadcast only if it is small
    parts = materialize(
        totals.select("*", *[F.coalesce(F.sum(f"_t_{w}").over(before), F.lit(0)).alias(f"_o_{w}") for w in weight_cols]), "slices"
    )
    offsets = parts.select("_slice", *groups, *[f"_o_{w}" for w in weight_cols])
    rows = _accumulate(stored, offsets, groups, order_col, weight_cols).select(*df.columns, *[f"cum_{w}" for w in weight_cols])
    group_totals = parts.groupBy(*groups).agg(*[F.sum(f"_t_{w}").alias(f"total_{w}") for w in weight_cols])
    return Running(rows, group_totals, stored, parts)


def _accumulate(stored: DataFrame, offsets: DataFrame, groups: Sequence[str], order_col: str, weight_cols: Sequence[str]) -> DataFrame:
    """Rows of the slices named in ``offsets``, with ``cum_<w>``; other slices are dropped before anything is sorted."""
    inside = Window.partitionBy("_slice", *groups).orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = join_groups(stored, offsets, ["_slice", *groups])
    return wanted.select("*", *[(F.col(f"_o_{w}") + F.sum(w).over(inside)).alias(f"cum_{w}") for w in weight_cols])


def value_counts(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """(group..., value, _c): rows per distinct value, nulls skipped (map-side combined)."""
    return df.filter(F.col(value_col).isNotNull()).groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_c"))


def quantiles_from_counts(
    counts: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    probs: Sequence[float],
    slices: int | None = None,
) -> tuple[DataFrame, Running]:
    """Continuous quantiles from a (group, value, _c) frame; returns (quantiles, the running-total run).

    Quantiles are (group..., p, n, q) with linear interpolation between the
    values at ranks floor(p(n-1)) and ceil(p(n-1)), like ``percentile`` and
    DuckDB's ``quantile_cont``.
    """
    groups = list(group_cols)
    run = running_totals(counts, groups, value_col, ["_c"], slices)
    target = run.totals.select(
        *groups,
        F.col("total__c").alias("n"),
        F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"),
    ).withColumn("pos", F.col("p") * (F.col("n") - 1).cast("double"))
    target = target.withColumn("lo", F.floor("pos").cast("bigint")).withColumn("hi", F.ceil("pos").cast("bigint"))
    ranks = target.groupBy(*groups).agg(F.array_distinct(F.flatten(F.collect_list(F.array("lo", "hi")))).alias("_ranks"))
    # the slices that hold a wanted rank, at most 2 * len(probs) per group, told by the slice totals alone
    held = F.exists("_ranks", lambda r: (F.col("_o__c") <= r) & (r < F.col("_o__c") + F.col("_t__c")))
    wanted_slices = materialize(join_groups(run.slices, ranks, groups).filter(held).select("_slice", *groups, "_o__c", "_ranks"), "wanted")
    # rows whose rank interval [cum - c, cum) holds a wanted rank: at most 2 * len(probs) per group
    covering = (
        _accumulate(run.stored, wanted_slices, groups, value_col, ["_c"])
        .filter(F.exists("_ranks", lambda r: (F.col("cum__c") - F.col("_c") <= r) & (r < F.col("cum__c"))))
        .select(*groups, value_col, (F.col("cum__c") - F.col("_c")).alias("_from"), F.col("cum__c").alias("_to"))
    )
    wanted = target.select(
        *groups, "p", "n", "pos", "lo",
        F.inline(F.array(F.struct(F.lit(0).alias("_hi"), F.col("lo").alias("_rank")), F.struct(F.lit(1).alias("_hi"), F.col("hi").alias("_rank")))),
    ).alias("t")
    c = covering.alias("c")
    cond = [F.col(f"t.{g}").eqNullSafe(F.col(f"c.{g}")) for g in groups] + [
        F.col("c._from") <= F.col("t._rank"),
        F.col("t._rank") < F.col("c._to"),
    ]
    matched = wanted.join(c, cond, "left").select(
        *[F.col(f"t.{g}").alias(g) for g in groups], "t.p", "t.n", "t.pos", "t.lo", "t._hi", F.col(f"c.{value_col}").cast("double").alias("_v")
    )
    pair = matched.groupBy(*groups, "p", "n", "pos", "lo").agg(
        F.max(F.when(F.col("_hi") == 0, F.col("_v"))).alias("_vlo"),
        F.max(F.when(F.col("_hi") == 1, F.col("_v"))).alias("_vhi"),
    )
    q = F.col("_vlo") + (F.col("pos") - F.col("lo").cast("double")) * (F.col("_vhi") - F.col("_vlo"))
    return pair.select(*groups, "p", "n", q.alias("q")), run


def exact_quantiles(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    probs: Sequence[float],
    slices: int | None = None,
) -> DataFrame:
    """Continuous quantiles per group: (group..., p, n, q); nulls skipped.

    One aggregation to (group, value, count), stored in ranges; the ranges'
    totals tell which of them hold a wanted rank, and only those rows are
    sorted and summed.  No group is ever gathered into a single task.
    """
    counts = value_counts(df, group_cols, value_col)
    return quantiles_from_counts(counts, group_cols, value_col, probs, slices)[0]


__all__ = ["Running", "exact_quantiles", "quantiles_from_counts", "running_totals", "value_counts"]
