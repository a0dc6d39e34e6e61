import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import stats as S
from strata.operators.ranking import exact_quantiles, running_totals


def test_correlation_symmetric_unit_diagonal(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=200)
    rows = [(float(a), float(a * 0.5 + b), None if i % 7 == 0 else float(b)) for i, (a, b) in enumerate(zip(x, rng.normal(size=200)))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    m = {(r["col_a"], r["col_b"]): r["corr"] for r in S.correlation_long(df, ["a", "b", "c"]).collect()}
    for k in "abc":
        assert m[(k, k)] == pytest.approx(1.0)
    assert m[("a", "b")] == m[("b", "a")]
    keep = [i for i in range(200) if i % 7 != 0]
    ref = np.corrcoef([rows[i][0] for i in keep], [rows[i][2] for i in keep])[0, 1]
    assert m[("a", "c")] == pytest.approx(ref, abs=1e-6)
    assert S.correlation_lower(S.correlation_long(df, ["a", "b", "c"])).count() == 3


def test_histogram_matches_numpy_and_integrates_to_one(spark):
    rng = np.random.default_rng(2)
    vals = rng.gamma(2.0, size=500)
    df = spark.createDataFrame([(float(v), i % 2) for i, v in enumerate(vals)], "x double, k int")
    h = S.histogram(df, ["x"], ["k"], bins=40, digits=None).filter("k = 0").orderBy("bin").collect()
    ref, edges = np.histogram(vals[0::2], bins=40, density=True)
    assert len(h) == 40
    assert np.allclose([r["density"] for r in h], ref)
    assert sum(r["density"] * (r["hi"] - r["lo"]) for r in h) == pytest.approx(1.0)


def test_histogram_constant_group_is_widened(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "x double")
    h = S.histogram(df, ["x"], bins=40, digits=None).collect()
    nonzero = [r for r in h if r["count"] > 0]
    assert len(h) == 40 and len(nonzero) == 1 and nonzero[0]["count"] == 4
    assert min(r["lo"] for r in h) == 4.5 and max(r["hi"] for r in h) == 5.5


def test_exact_quantiles_match_numpy_on_skewed_groups(spark):
    rng = np.random.default_rng(3)
    # group 'hot' holds most rows; many slices cut it
    rows = [("hot", float(v)) for v in rng.normal(size=3000)] + [("cold", float(v)) for v in rng.integers(0, 5, size=31)]
    df = spark.createDataFrame(rows, "g string, v double")
    q = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(df, ["g"], "v", [0.1, 0.25, 0.5, 0.75, 1.0], slices=16).collect()}
    for g in ("hot", "cold"):
        arr = np.array([v for k, v in rows if k == g])
        for p in (0.1, 0.25, 0.5, 0.75, 1.0):
            assert q[(g, p)] == pytest.approx(np.quantile(arr, p), abs=1e-12)


def test_running_totals_across_slices(spark):
    rows = [("a", i, 1) for i in range(100)] + [("b", i, 2) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, k int, w int")
    out = {(r["g"], r["k"]): r["cum_w"] for r in running_totals(df, ["g"], "k", ["w"], slices=7).rows.collect()}
    assert out[("a", 99)] == 100 and out[("a", 49)] == 50 and out[("b", 9)] == 20


def test_box_stats_whiskers_are_data_values(spark):
    vals = [1.0, 2.0, 2.5, 3.0, 3.5, 4.0, 30.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    b = S.box_stats(df, ["x"], digits=None).first()
    q1, q3 = np.quantile(vals, 0.25), np.quantile(vals, 0.75)
    hi = q3 + 1.5 * (q3 - q1)
    assert b["q1"] == pytest.approx(q1) and b["q3"] == pytest.approx(q3)
    assert b["whisker_hi"] == max(v for v in vals if v <= hi) and b["n_high"] == 1 and b["n_outliers"] == 1
    approx = S.box_stats(df, ["x"], method="approx", digits=None).first()
    assert approx["n"] == 7 and approx["median"] == 3.0


def test_constant_column_box_iqr_zero(spark):
    df = spark.createDataFrame([(2.0,)] * 4, "x double")
    b = S.box_stats(df, ["x"]).first()
    assert b["iqr"] == 0.0 and b["n_outliers"] == 0 and b["whisker_lo"] == 2.0


def test_empty_table_statistics_and_metrics(spark):
    from strata.operators import evaluate as E
    from strata.plans.reports import bronze_report

    empty = spark.createDataFrame([], "x double, y int, score double, prediction int")
    assert S.histogram(empty, ["x"], ["y"]).count() == 0
    assert S.box_stats(empty, ["x"], ["y"]).count() == 0
    auc = E.auc_roc(empty, "y", "score").collect()
    assert len(auc) == 1 and auc[0]["auc"] is None
    m = E.classification_metrics(empty, "y", "prediction").collect()
    assert len(m) == 1 and m[0]["accuracy"] is None
    kpi = {(r["section"], r["key"]): r["value"] for r in bronze_report(empty.select("x", "y"), "y").collect()}
    assert kpi[("table", "total_rows")] == 0.0 and kpi[("table", "duplicates")] == 0.0


def test_wide_correlation_is_pairwise_complete(spark):
    """Nulls, NaN, null vectors, short vectors and a large mean, against numpy pair by pair."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 7)) + [0, 1e7, 0, 0, 0, 0, 0]
    x[:, 2] += x[:, 0]
    x[:, 5] = 4.0
    rows = [[None if rng.random() < 0.1 else float(v) for v in r] for r in x]
    rows[3][4], rows[7] = float("nan"), rows[7][:4]
    df = spark.createDataFrame([(r,) for r in rows] + [(None,)], "v array<double>").repartition(5)
    got = {(r.i, r.j): r["corr"] for r in S.correlation_vector(df, "v", digits=None).collect()}
    full = np.array([[np.nan if v is None else v for v in r + [None] * (7 - len(r))] for r in rows], float)
    assert len(got) == 49
    for i in range(7):
        for j in range(7):
            keep = ~np.isnan(full[:, i]) & ~np.isnan(full[:, j])
            if 5 in (i, j):
                assert got[i, j] is None
            else:
                assert got[i, j] == pytest.approx(np.corrcoef(full[keep, i], full[keep, j])[0, 1], abs=1e-6)
    named = S.correlation_vector(df, "v", names=list("abcdefg")).where("i = 0 and j = 2").first()
    assert (named.col_a, named.col_b) == ("a", "c")
    assert S.correlation_vector(df.where("1 = 0"), "v").count() == 0


def test_outlier_rows_are_not_gathered_by_group(spark):
    rows = [(float(v), k) for k in (0, 1) for v in [*range(40), 1000 + k]]
    out = S.outlier_rows(spark.createDataFrame(rows, "x double, k int"), ["x"], ["k"])
    assert sorted(map(tuple, out.select("k", "feature", "value").collect())) == [(0, "x", 1000.0), (1, "x", 1001.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
