import math

import pytest

from strata.operators.models import class_weights, uncertainty_flag
from strata.operators.quality import grouped_describe, range_violations, regression_metrics


def test_range_violations_skip_missing_and_open_bounds(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (None,), (-2.0,)], "x double")
    r = range_violations(df, [("x", 0.0, 4.0), ("x", None, 4.0)]).collect()
    assert [(x["n_checked"], x["n_violations"]) for x in r] == [(3, 2), (3, 1)]


def test_regression_metrics_closed_form(spark):
    rows = [(1.0, 1.5), (2.0, 2.0), (3.0, 2.0)]
    df = spark.createDataFrame(rows, "y double, p double")
    r = regression_metrics(df, "y", "p", digits=None).first()
    errs = [a - b for a, b in rows]
    assert r["rmse"] == pytest.approx(math.sqrt(sum(e * e for e in errs) / 3))
    assert r["mae"] == pytest.approx(sum(abs(e) for e in errs) / 3)
    assert r["r2"] == pytest.approx(1 - sum(e * e for e in errs) / 2.0)
    const = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    assert regression_metrics(const, "y", "p").first()["r2"] is None


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    w = {r["y"]: r["weight"] for r in class_weights(df, "y").select("y", "weight").distinct().collect()}
    assert w[0] == pytest.approx(8 / (2 * 6)) and w[1] == pytest.approx(8 / (2 * 2))


def test_uncertainty_flag(spark):
    df = spark.createDataFrame([(0.52,), (0.9,), (0.45,)], "p1 double")
    assert [r["needs_review"] for r in uncertainty_flag(df, "p1", 0.1).collect()] == [True, False, True]


def test_grouped_describe(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "k string, v double")
    r = {x["k"]: x for x in grouped_describe(df, "v", ["k"]).collect()}
    assert r["a"]["count"] == 2 and r["a"]["mean"] == 2.0 and r["b"]["stddev"] is None
