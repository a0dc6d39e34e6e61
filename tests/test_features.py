import pytest
from pyspark.sql import functions as F

from strata_paths import SF001
from strata.operators import features as FE
from strata.plans.readings import FEATURES, KEYS, readings


def test_split_disjoint_complete_and_layout_independent(spark):
    r = readings(spark, SF001)
    a = FE.hash_split(r, KEYS).select(*KEYS, "split")
    b = FE.hash_split(r.repartition(13), KEYS).select(*KEYS, "split")
    assert a.exceptAll(b).count() == 0
    train, test = FE.split_frames(r, KEYS)
    n, nt, ns = r.count(), train.count(), test.count()
    assert nt + ns == n and train.join(test, KEYS).count() == 0
    assert 0.78 < nt / n < 0.82


def test_scaled_mean_zero_std_one(spark):
    r = readings(spark, SF001)
    s = FE.standard_scale(r, FEATURES)
    row = s.agg(*[F.avg(c).alias(f"m_{c}") for c in FEATURES], *[F.stddev_samp(c).alias(f"s_{c}") for c in FEATURES]).first()
    for c in FEATURES:
        assert row[f"m_{c}"] == pytest.approx(0.0, abs=1e-9) and row[f"s_{c}"] == pytest.approx(1.0, abs=1e-9)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,), (3.0,)], "x double")
    assert [r["x"] for r in FE.standard_scale(df, ["x"]).collect()] == [0.0, 0.0, None, 0.0]


def test_assemble_keep_turns_null_into_nan(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    v = [r["features_raw"].toArray().tolist() for r in FE.assemble(df, ["a", "b"]).collect()]
    assert v[1] == [2.0, 3.0] and v[0][0] == 1.0 and v[0][1] != v[0][1]
