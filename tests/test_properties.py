"""Randomised checks of the core operators against brute force (numpy / pure Python)."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators import evaluate as E
from strata.operators import profile as P
from strata.operators.clean import duplicate_count
from strata.operators.ranking import exact_quantiles

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

small_floats = st.one_of(st.none(), st.just(float("nan")), st.integers(-5, 5).map(float))


@SETTINGS
@given(
    values=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(-20, 20).map(float)), min_size=1, max_size=80),
    slices=st.integers(1, 9),
)
def test_exact_quantiles_equal_numpy(spark, values, slices):
    df = spark.createDataFrame(values, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(df, ["g"], "v", probs, slices=slices).collect()}
    for g in {k for k, _ in values}:
        arr = np.array([v for k, v in values if k == g])
        for p in probs:
            assert got[(g, p)] == pytest.approx(float(np.quantile(arr, p)), abs=1e-9)


@SETTINGS
@given(
    rows=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6).map(lambda x: x / 6.0)), min_size=2, max_size=60),
    slices=st.integers(1, 7),
)
def test_auc_equals_pairwise_definition(spark, rows, slices):
    df = spark.createDataFrame(rows, "label int, score double")
    got = E.auc_roc(df, "label", "score", digits=None, slices=slices).first()["auc"]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        assert got is None
        return
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    assert got == pytest.approx(wins / (len(pos) * len(neg)))


@SETTINGS
@given(rows=st.lists(st.tuples(small_floats, small_floats), min_size=0, max_size=40))
def test_missing_and_duplicates_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double")
    miss = {r["column"]: r["n_missing"] for r in P.missing_profile(df).collect()}

    def missing(v):
        return v is None or (isinstance(v, float) and math.isnan(v))

    assert miss == {"a": sum(missing(a) for a, _ in rows), "b": sum(missing(b) for _, b in rows)}

    def key(v):
        return "null" if v is None else ("nan" if math.isnan(v) else v + 0.0)

    distinct = {(key(a), key(b)) for a, b in rows}
    d = duplicate_count(df).first()
    assert (d["n_rows"], d["n_distinct"]) == (len(rows), len(distinct))
