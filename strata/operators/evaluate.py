"""Classifier evaluation as grouped aggregations over a long predictions table.

Input is any frame with a label, a prediction and (for AUC) a score column,
optionally with grouping columns such as ``model``.  All models and metrics
come out of one pass each instead of one job per (model, metric).

Conventions (same as MLlib's multiclass metrics): classes are those seen in
the label column, weights are label frequencies, 0/0 counts as 0.  AUC is the
exact rank statistic with half credit for tied scores; it is null when one
class is absent (MLlib returns 1.0 there).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import safe_ratio, rnd
from strata.plans.physical import join_groups

METRICS = ["accuracy", "f1", "weighted_precision", "weighted_recall"]

# Targets per metric and the literature accuracies quoted next
# to the models (constants, not measured).
DEFAULT_TARGETS = {"accuracy": 0.95, "f1": 0.94, "weighted_precision": 0.94, "weighted_recall": 0.94, "auc": 0.90}
LITERATURE_ACCURACY = {"SVM": 0.95, "KNN": 0.92, "Decision Tree": 0.93}


def confusion_long(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., label, prediction, count); cells that never occur are absent."""
    return (
        df.groupBy(*by, F.col(label).cast("int").alias("label"), F.col(pred).cast("int").alias("prediction"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def confusion_wide(df: DataFrame, label: str, pred: str, by: Sequence[str] = (), positive: int = 1, digits: int = 4) -> DataFrame:
    """Binary TN / FP / FN / TP per group (missing cells are 0) with shares correct / wrong."""
    y = F.col(label).cast("int") == F.lit(positive)
    p = F.col(pred).cast("int") == F.lit(positive)
    out = df.groupBy(*by).agg(
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(y & p).alias("tp"),
        F.count(F.lit(1)).alias("n"),
    )
    return out.withColumn("share_correct", rnd(safe_ratio(F.col("tn") + F.col("tp"), F.col("n")), digits)).withColumn(
        "share_wrong", rnd(safe_ratio(F.col("fp") + F.col("fn"), F.col("n")), digits)
    )


def per_class_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., class, support, tp, n_predicted, precision, recall, f1) for every class in the label column."""
    by = list(by)
    conf = confusion_long(df, label, pred, by)
    lab = conf.groupBy(*by, F.col("label").alias("class")).agg(
        F.sum("count").alias("support"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(F.lit(0))).alias("tp"),
    )
    prd = conf.groupBy(*by, F.col("prediction").alias("class")).agg(F.sum("count").alias("n_predicted"))
    pc = join_groups(lab, prd, [*by, "class"], "left").withColumn("n_predicted", F.coalesce("n_predicted", F.lit(0)))
    precision = F.coalesce(safe_ratio(F.col("tp"), F.col("n_predicted")), F.lit(0.0))
    recall = F.coalesce(safe_ratio(F.col("tp"), F.col("support")), F.lit(0.0))
    pc = pc.withColumn("precision", precision).withColumn("recall", recall)
    f1 = F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    return pc.withColumn("f1", f1).select(*by, "class", "support", "tp", "n_predicted", "precision", "recall", "f1")


def classification_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = (), digits: int | None = 6) -> DataFrame:
    """accuracy, weighted F1 / precision / recall per group (one scan + tiny frames)."""
    pc = per_class_metrics(df, label, pred, by)
    n = F.sum("support")
    out = pc.groupBy(*by).agg(
        safe_ratio(F.sum("tp"), n).alias("accuracy"),
        safe_ratio(F.sum(F.col("f1") * F.col("support")), n).alias("f1"),
        safe_ratio(F.sum(F.col("precision") * F.col("support")), n).alias("weighted_precision"),
        safe_ratio(F.sum(F.col("recall") * F.col("support")), n).alias("weighted_recall"),
        n.alias("n"),
    )
    if digits is not None:
        for m in METRICS:
            out = out.withColumn(m, rnd(m, digits))
    return out


def auc_roc(
    df: DataFrame,
    label: str,
    score: str,
    by: Sequence[str] = (),
    positive: int = 1,
    digits: int | None = 6,
    slices: int | None = None,
) -> DataFrame:
    """Exact area under ROC per group: P(score+ > score-) + ½ P(score+ = score-).

    Rows are first counted per (group, score) and dealt to score ranges, so
    neither a hot group nor a continuous score lands in a single task.  Each
    range is passed once in order, giving its own credit, positives and
    negatives per group; a positive of a later range beats all negatives of the
    earlier ones, which a running sum over the ranges tells.
    """
    by = list(by)
    y = F.col(label).cast("int") == F.lit(positive)
    g = df.filter(F.col(score).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("_s")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")
    )
    keys = [*by, "_s"]
    ranged = (g.repartitionByRange(int(slices), *keys) if slices else g.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    local = ranged.select(F.spark_partition_id().alias("_slice"), *by, "pos", "neg")
    kinds = ", ".join([f"_slice int, {', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in g.select(*by).schema.fields)}".rstrip(", "), "_credit double, pos long, neg long"])
    ranks = local.mapInArrow(_range_credit, kinds)
    # at most ranges + groups rows
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranks.withColumn("_below", F.coalesce(F.sum("neg").over(before), F.lit(0)))
    credit = F.col("_credit") + F.col("pos").cast("double") * F.col("_below").cast("double")
    out = parts.groupBy(*by).agg(F.sum(credit).alias("_c"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    auc = safe_ratio(F.col("_c"), F.col("n_pos").cast("double") * F.col("n_neg").cast("double"))
    if digits is not None:
        auc = rnd(auc, digits)
    return out.select(*by, auc.alias("auc"), "n_pos", "n_neg")


def _range_credit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slice, group..., credit, positives, negatives) of rows sorted by group and score; a group's tallies are carried from batch to batch."""
    held = None  # [key, credit, pos, neg] of the last group
    for batch in batches:
        n, width = batch.num_rows, batch.num_columns - 2
        if not n:
            continue
        names, kinds = batch.schema.names[:width], [f.type for f in batch.schema][:width]
        new = np.zeros(n, bool)
        for column in batch.columns[:width]:
            code = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            new[1:] |= code[1:] != code[:-1]
        start = np.flatnonzero(np.concatenate(([True], new[1:])))
        pos, neg = (batch.column(width + k).to_numpy().astype(float) for k in range(2))
        below = np.cumsum(neg) - neg
        below -= np.repeat(below[start], np.diff(np.append(start, n)))
        sums = [np.add.reduceat(x, start).tolist() for x in (pos * (below + neg / 2), pos, neg)]
        at = [tuple(c[int(i)].as_py() for c in batch.columns[:width]) for i in start]
        done = []
        for key, c, p, q in zip(at, *sums):
            if held and all(x == y or (x != x and y != y) for x, y in zip(held[0], key)):
                held = [key, held[1] + c + p * held[3], held[2] + p, held[3] + q]
            else:
                done += [held] if held else []
                held = [key, c, p, q]
        yield _credit_rows(done, names, kinds)
    if held:
        yield _credit_rows([held], names, kinds)


def _credit_rows(rows: list, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    keys = [pa.array([r[0][k] for r in rows], t) for k, t in enumerate(kinds)]
    tallies = [pa.array([r[1] for r in rows], pa.float64()), *(pa.array([int(r[k]) for r in rows], pa.int64()) for k in (2, 3))]
    return pa.RecordBatch.from_arrays([*keys, *tallies], names=[*names, "_credit", "pos", "neg"])


def evaluate(df: DataFrame, label: str, pred: str, score: str | None = None, by: Sequence[str] = (), digits: int | None = 6) -> DataFrame:
    """Classification metrics plus AUC (when a score is given), one row per group."""
    m = classification_metrics(df, label, pred, by, digits)
    if score is None:
        return m
    a = auc_roc(df, label, score, by, digits=digits).select(*by, "auc")
    if by:
        return join_groups(m, a, by, "left")
    # both sides are one row; join on a constant key
    return m.withColumn("_k", F.lit(0)).join(a.withColumn("_k", F.lit(0)), "_k", "left").drop("_k")


def metrics_long(metrics: DataFrame, by: Sequence[str], names: Sequence[str] = (*METRICS, "auc")) -> DataFrame:
    """Unpivot a metrics frame to (by..., metric, value)."""
    present = [m for m in names if m in metrics.columns]
    return metrics.select(*by, *[F.col(m).cast("double").alias(m) for m in present]).unpivot(list(by), present, "metric", "value")


def best_row(df: DataFrame, metric: str, name: str = "model") -> DataFrame:
    """The row with the highest ``metric``; ties go to the smallest ``name`` (top-1, no full sort)."""
    return df.orderBy(F.col(metric).desc_nulls_last(), F.col(name).asc()).limit(1)


def mark_best(df: DataFrame, metric: str, name: str = "model") -> DataFrame:
    """Add ``is_best`` (argmax of ``metric``, ties by name) — computed, never hard-coded."""
    w = Window.partitionBy().orderBy(F.col(metric).desc_nulls_last(), F.col(name).asc())
    return df.withColumn("is_best", F.row_number().over(w) == 1)


def targets_frame(spark, targets: Mapping[str, float] | None = None) -> DataFrame:
    rows = sorted((targets or DEFAULT_TARGETS).items())
    return spark.createDataFrame(rows, "metric string, target double")


def target_check(long_metrics: DataFrame, targets: DataFrame) -> DataFrame:
    """Join (…, metric, value) with (metric, target); ``target_met`` = value ≥ target."""
    out = join_groups(long_metrics, targets, "metric")
    return out.withColumn("target_met", F.col("value") >= F.col("target")).withColumn(
        "status", F.when(F.col("target_met"), F.lit("met")).otherwise(F.format_string(">= %.2f", F.col("target")))
    )


def baseline_comparison(own: DataFrame, metric: str = "accuracy", name: str = "model", baselines: Mapping[str, float] | None = None) -> DataFrame:
    """Own (name, metric) rows next to quoted constants, with the gap to the best row."""
    spark = own.sparkSession
    quoted = spark.createDataFrame(sorted((baselines or LITERATURE_ACCURACY).items()), f"{name} string, value double").withColumn(
        "source", F.lit("literature")
    )
    mine = own.select(F.col(name).cast("string").alias(name), F.col(metric).cast("double").alias("value"), F.lit("measured").alias("source"))
    both = mine.unionByName(quoted)
    return both.withColumn("gap_to_best", rnd(F.col("value") - F.max("value").over(Window.partitionBy()), 6))


def format_metric(col, digits: int = 4):
    """'0.6556 (65.56%)' text used in reports."""
    return F.format_string(f"%.{digits}f (%.2f%%)", rnd(col, digits), rnd(col * 100.0, 2))


__all__ = [
    "DEFAULT_TARGETS",
    "LITERATURE_ACCURACY",
    "METRICS",
    "auc_roc",
    "baseline_comparison",
    "best_row",
    "classification_metrics",
    "confusion_long",
    "confusion_wide",
    "evaluate",
    "format_metric",
    "mark_best",
    "metrics_long",
    "per_class_metrics",
    "target_check",
    "targets_frame",
]
