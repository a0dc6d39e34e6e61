"""A hot group (most of the rows) is cut across slices and results stay exact."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import evaluate as E
from strata.operators.ranking import exact_quantiles, running_totals, value_counts


def hot_frame(spark):
    rng = np.random.default_rng(7)
    hot = [("hot", float(v)) for v in rng.normal(size=6000)]
    cold = [(f"c{k}", float(v)) for k in range(5) for v in rng.normal(size=40)]
    return spark.createDataFrame(hot + cold, "g string, v double"), hot + cold


def test_hot_group_spans_many_slices(spark):
    df, _ = hot_frame(spark)
    run = running_totals(value_counts(df, ["g"], "v"), ["g"], "v", ["_c"], slices=12)
    spans = {r["g"]: r["n"] for r in run.stored.groupBy("g").agg(F.countDistinct("_slice").alias("n")).collect()}
    assert spans["hot"] >= 8
    biggest = run.stored.groupBy("_slice").count().agg(F.max("count")).first()[0]
    assert biggest < 6000 / 4
    totals = {r["g"]: r["total__c"] for r in run.totals.collect()}
    assert totals["hot"] == 6000


def test_hot_group_results_exact(spark):
    df, rows = hot_frame(spark)
    q = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(df, ["g"], "v", [0.5, 0.99], slices=12).collect()}
    hot = np.array([v for g, v in rows if g == "hot"])
    assert q[("hot", 0.5)] == pytest.approx(np.quantile(hot, 0.5)) and q[("hot", 0.99)] == pytest.approx(np.quantile(hot, 0.99))
    # AUC where one model holds almost all rows
    pred = df.select(F.when(F.col("g") == "hot", "big").otherwise("small").alias("model"), (F.col("v") > 0).cast("int").alias("label"), F.col("v").alias("score"))
    auc = {r["model"]: r["auc"] for r in E.auc_roc(pred, "label", "score", ["model"], slices=12).collect()}
    assert auc["big"] == 1.0 and auc["small"] == 1.0



def test_auc_of_hot_null_and_nan_groups_over_many_batches(spark):
    rng = np.random.default_rng(3)
    groups = [None, float("nan"), 1.5]
    rows = [(groups[int(g)], int(rng.integers(0, 2)), float(np.round(s, 2))) for g, s in zip(rng.choice(3, 4000, p=[0.8, 0.15, 0.05]), rng.normal(size=4000))]
    df = spark.createDataFrame(rows, "g double, label int, score double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = {str(r["g"]): r for r in E.auc_roc(df, "label", "score", ["g"], digits=None, slices=9).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 3
    for g in groups:
        mine = [(y, s) for k, y, s in rows if str(k) == str(g)]
        pos, neg = (np.array([s for y, s in mine if y == k]) for k in (1, 0))
        want = ((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / (len(pos) * len(neg))
        assert got[str(g)]["auc"] == pytest.approx(want) and (got[str(g)]["n_pos"], got[str(g)]["n_neg"]) == (len(pos), len(neg))


def test_quantile_plan_sorts_pruned_rows_only(spark):
    """After the range partition the stored rows meet a broadcast list of wanted slices before any exchange."""
    df, _ = hot_frame(spark)
    plan = exact_quantiles(df, ["g"], "v", [0.5], slices=12)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Window [") :]
    below = below[: below.index("FileScan")]
    assert below.index("Exchange hashpartitioning(_slice") < below.index("BroadcastHashJoin") and "SortMergeJoin" not in below
    assert "Exchange" not in below[below.index("BroadcastHashJoin") :].split("Project")[-1]
