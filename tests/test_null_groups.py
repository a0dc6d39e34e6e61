"""Null classes and segments are groups like any other; missing values are no observations."""

from pyspark.sql import functions as F

from strata.functions.columns import rnd
from strata.operators import evaluate as E
from strata.operators import quality as Q
from strata.operators import stats as S
from strata.operators.models import class_weights


def test_null_class_in_histogram_and_box(spark):
    df = spark.createDataFrame([(float(v), k) for k in (None, "a") for v in (1, 2, 3, 4, 100)], "v double, k string")
    h = S.histogram(df, ["v"], ["k"], bins=2).groupBy("k").agg(F.sum("count").alias("n")).collect()
    assert {r.k: r.n for r in h} == {None: 5, "a": 5}
    box = {r.k: r for r in S.box_stats(df, ["v"], ["k"]).collect()}
    assert box[None].asDict() | {"k": "a"} == box["a"].asDict() and box[None].n_outliers == 1
    assert {(r.k, r.value) for r in S.outlier_rows(df, ["v"], ["k"]).collect()} == {(None, 100.0), ("a", 100.0)}


def test_null_segment_in_metrics(spark):
    rows = [(s, y, y, float(y)) for s in (None, "x") for y in (0, 1, 1)]
    df = spark.createDataFrame(rows, "seg string, y int, p int, s double")
    out = {r.seg: r for r in E.evaluate(df, "y", "p", "s", ["seg"]).collect()}
    assert out[None].asDict() | {"seg": "x"} == out["x"].asDict()
    assert out[None].f1 == 1.0 and out[None].accuracy == 1.0 and out[None].auc == 1.0


def test_null_label_gets_its_class_weight(spark):
    df = spark.createDataFrame([(0,), (0,), (1,), (None,)], "y int")
    w = {r.y: r.weight for r in class_weights(df, "y").distinct().collect()}
    assert abs(w[0] - 4 / 6) < 1e-12 and abs(w[None] - 4 / 3) < 1e-12


def test_missing_values_are_not_observations(spark):
    df = spark.createDataFrame([(1.0, 1.1), (2.0, 1.9), (3.0, 3.2), (None, 5.0), (9.0, None)], "y double, p double")
    r = Q.regression_metrics(df, "y", "p").first()
    assert r.n == 3 and abs(r.r2 - (1 - (0.01 + 0.01 + 0.04) / 2)) < 1e-6
    v = Q.range_violations(spark.createDataFrame([(1.0,), (float("nan"),), (None,), (20.0,)], "x double"), [("x", 0.0, 14.0)]).first()
    assert (v.n_checked, v.n_violations) == (2, 1)


def test_rounding_near_ties(spark):
    r = spark.range(1).select(rnd(F.lit(0.0049951), 2).alias("a"), rnd(F.lit(12.344961), 2).alias("b"), rnd(F.lit(2995.11 / 60000), 6).alias("c")).first()
    assert (r.a, r.b, r.c) == (0.0, 12.34, 0.049919)
