"""Fits do not hang on the input's layout, and closed forms agree."""

import pytest
from pyspark.sql import functions as F

from strata.operators.features import hash_split
from strata.operators.models import MODEL_PARAMS, build_pipeline, prediction_contract, predictions_long, root_split
from strata.plans.gold import fixed_layout
from strata.plans.readings import FEATURES, KEYS, LABEL, readings
from strata_paths import SF0001

IMPUTED = ["qty", "price", "tax"]


def test_forest_is_the_same_from_any_layout(spark):
    rows = hash_split(readings(spark, SF0001), KEYS)
    forests, sizes = [], []
    for layout in (rows.repartition(8), rows.repartition(64, "l_suppkey"), rows.orderBy(F.desc("price")).coalesce(2)):
        laid = fixed_layout(layout, KEYS)
        sizes.append(laid.rdd.getNumPartitions())
        model = build_pipeline("rf", FEATURES, LABEL, impute=IMPUTED, numTrees=6, maxDepth=5, seed=42).fit(laid)
        forests.append(model.stages[-1].toDebugString.split("\n", 1)[1])
    assert forests[0] == forests[1] == forests[2] and len(set(sizes)) == 1


def test_equal_rows_are_spread_by_their_keys(spark):
    same = spark.range(20_000).select(F.col("id"), F.lit(1.0).alias("x"))
    counts = [r["count"] for r in fixed_layout(same, ["id"]).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(counts) >= 5 and max(counts) < 2 * min(counts)


def test_contract_tells_bad_rows(spark):
    good = ("m", 1, 1, 1, 0.7, 0.7, 0.3)
    bad = [("m", 2, 1, 0, 0.7, 0.7, 0.3), ("m", 3, 1, 1, 0.7, 0.7, 0.4)]
    svm = [("s", 4, 1, 1, 0.2, None, None), ("s", 5, 0, 1, -0.2, None, None)]
    df = spark.createDataFrame([good, *bad, *svm], "model string, k int, label int, prediction int, score double, p1 double, p0 double")
    assert {r.k: r.consistent for r in prediction_contract(df, ["k"]).collect()} == {1: True, 2: False, 3: False, 4: True, 5: False}


def test_root_split_of_a_known_table(spark):
    df = spark.createDataFrame([(float(x), int(x > 3)) for x in (1, 2, 3, 4, 5, 6)] * 3, "x double, y int")
    model = build_pipeline("dt", ["x"], "y", scale=False, **{**MODEL_PARAMS["dt"], "maxDepth": 1}).fit(df)
    assert root_split(model) == {"feature": 0.0, "threshold": 3.5, "gain": pytest.approx(0.5), "left": 0.0, "right": 1.0}
    scored = predictions_long({"t": model}, df, ["x"], "y")
    assert prediction_contract(scored, ["x"]).where("not consistent").count() == 0
