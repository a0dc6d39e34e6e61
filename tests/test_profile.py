import math

from pyspark.sql import functions as F

from strata.operators import profile as P
from strata.operators.clean import assert_complete, dedup, duplicate_count, fit_means, impute, IncompleteTableError

import pytest


def small(spark):
    # a double, y int, b double — nulls, a NaN and one duplicated row
    rows = [(1.0, 1, 10.0), (float("nan"), 0, 20.0), (None, 1, None), (3.0, 0, 40.0), (3.0, 0, 40.0)]
    return spark.createDataFrame(rows, "a double, y int, b double")


def test_missing_counts_null_and_nan(spark):
    out = {r["column"]: r for r in P.missing_profile(small(spark)).collect()}
    assert out["a"]["n_missing"] == 2 and out["y"]["n_missing"] == 0 and out["b"]["n_missing"] == 1
    assert out["a"]["missing_pct"] == 40.0 and out["a"]["needs_imputation"]
    assert out["a"]["n_rows"] == 5


def test_missing_does_not_call_isnan_on_strings_and_timestamps(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('x', TIMESTAMP'2020-01-01 00:00:00', 1.0), (NULL, NULL, double('NaN')), ('z', TIMESTAMP'2020-01-02 00:00:00', NULL) AS t(s, ts, v)"
    )
    out = {r["column"]: r["n_missing"] for r in P.missing_profile(df).collect()}
    assert out == {"s": 1, "ts": 1, "v": 2}


def test_distinct_and_duplicates(spark):
    r = duplicate_count(small(spark)).first()
    assert (r["n_rows"], r["n_distinct"], r["n_duplicates"]) == (5, 4, 1)
    d = dedup(small(spark))
    assert d.count() == 4 and dedup(d).count() == 4  # idempotent


def test_impute_mean_skips_null_and_nan(spark):
    m = fit_means(small(spark), ["a", "b"])
    assert m["a"] == pytest.approx(7 / 3) and m["b"] == pytest.approx(27.5)
    out = impute(small(spark), ["a", "b"]).collect()
    assert all(not math.isnan(r["a"]) for r in out)
    assert P.missing_total(impute(small(spark), ["a", "b"])).first()["total_missing"] == 0


def test_impute_int_column_as_double(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    out = [r["k"] for r in impute(df, ["k"]).orderBy("k").collect()]
    assert out == [1.0, 1.5, 2.0]


def test_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 3.0)], "a double, b double")
    assert fit_means(df, ["a"])["a"] is None
    assert impute(df, ["a", "b"]).filter(F.col("a").isNull()).count() == 3
    with pytest.raises(IncompleteTableError):
        assert_complete(impute(df, ["a", "b"]))


def test_empty_table_reports(spark):
    df = spark.createDataFrame([], "a double, y int")
    mp = P.missing_profile(df).collect()
    assert [r["n_rows"] for r in mp] == [0, 0] and all(r["missing_pct"] is None for r in mp)
    assert P.label_distribution(df, "y").count() == 0
    d = P.describe_long(df, ["a"]).first()
    assert d["count"] == 0 and d["mean"] is None
    assert duplicate_count(df).first()["n_rows"] == 0


def test_label_distribution_shares(spark):
    out = P.label_distribution(small(spark), "y", {0: "no", 1: "yes"}).collect()
    assert [(r["y"], r["label_name"], r["count"], r["pct"]) for r in out] == [(0, "no", 3, 60.0), (1, "yes", 2, 40.0)]


def test_describe_long_matches_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    r = P.describe_long(df, ["x"]).first()
    assert (r["count"], r["mean"], r["min"], r["max"]) == (3, round(7 / 3, 6), 1.0, 4.0)
    assert r["stddev"] == round(math.sqrt(((1 - 7 / 3) ** 2 + (2 - 7 / 3) ** 2 + (4 - 7 / 3) ** 2) / 2), 6)


def test_preview_needs_order(spark):
    with pytest.raises(ValueError):
        P.preview(small(spark), 2, [])
    assert P.preview(small(spark), 2, ["b"]).count() == 2


def test_schema_profile(spark):
    out = P.schema_profile(small(spark)).collect()
    assert [(r["column"], r["type"]) for r in out] == [("a", "double"), ("y", "int"), ("b", "double")]


def test_missing_violations_name_the_columns(spark):
    from strata.operators.clean import missing_violations

    out = missing_violations(small(spark), ["a", "b"]).collect()
    assert sorted(tuple(r["missing_in"]) for r in out) == [("a",), ("a", "b")]


def test_dedup_on_content_keeps_smallest_key(spark):
    df = spark.createDataFrame([(3, 1.0, 0), (1, 1.0, 0), (2, 2.0, 1)], "k int, x double, y int")
    out = sorted(tuple(r) for r in dedup(df, ["x", "y"], keep_min=["k"]).collect())
    assert out == [(1, 1.0, 0), (2, 2.0, 1)]
    assert dedup(df, ["x", "y"], keep_min=["k"]).columns == ["k", "x", "y"]
