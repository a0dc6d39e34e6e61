import tempfile

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from strata_paths import SF001
from strata.operators import evaluate as E
from strata.operators.models import build_pipeline, importances, predictions_long
from strata.operators.features import hash_split
from strata.operators.models import MODEL_PARAMS
from strata.plans.gold import model_comparison
from strata.plans.readings import FEATURES, KEYS, LABEL, readings

IMPUTED = ["qty", "price", "tax"]


@pytest.fixture(scope="module")
def split(spark):
    df = hash_split(readings(spark, SF001), KEYS)
    # fixed layout so forests are repeatable
    df = df.repartition(4, *KEYS).sortWithinPartitions(*KEYS)
    train = df.filter("split = 'train'").persist()
    test = df.filter("split = 'test'").persist()
    return train, test


def test_models_beat_majority_class(spark, split):
    train, test = split
    rate = test.agg(F.avg(F.col(LABEL))).first()[0]
    base = max(rate, 1 - rate)
    for kind, floor in [("dt", 0.85), ("rf", 0.85), ("lr", 0.75), ("gbt", 0.85)]:
        m = build_pipeline(kind, FEATURES, LABEL, impute=IMPUTED, **MODEL_PARAMS[kind]).fit(train)
        acc = E.classification_metrics(predictions_long({kind: m}, test, KEYS, LABEL), "label", "prediction").first()["accuracy"]
        assert acc >= floor and acc > base, kind


def test_saved_model_gives_identical_predictions(spark, split):
    train, test = split
    m = build_pipeline("dt", FEATURES, LABEL, impute=IMPUTED, **MODEL_PARAMS["dt"]).fit(train)
    path = tempfile.mkdtemp(prefix="strata-model-") + "/m"
    m.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = predictions_long({"x": m}, test, KEYS, LABEL)
    b = predictions_long({"x": again}, test, KEYS, LABEL)
    assert a.exceptAll(b).count() == 0


def test_importances_sum_to_one_and_rank(spark, split):
    train, _ = split
    m = build_pipeline("dt", FEATURES, LABEL, impute=IMPUTED, **MODEL_PARAMS["dt"]).fit(train)
    imp = importances(m, FEATURES, "dt").orderBy("rank").collect()
    assert sum(r["importance"] for r in imp) == pytest.approx(1.0)
    assert [r["rank"] for r in imp] == [1, 2, 3, 4]
    assert all(imp[i]["importance"] >= imp[i + 1]["importance"] for i in range(3))


def test_model_comparison_marks_argmax(spark):
    df = hash_split(readings(spark, SF001), KEYS)
    out = model_comparison(df, FEATURES, IMPUTED, LABEL, KEYS, kinds=("dt", "lr")).collect()
    assert len(out) == 2 and sum(r["is_best"] for r in out) == 1
    best = max(out, key=lambda r: (r["accuracy"], [-ord(ch) for ch in r["model"]]))
    assert best["is_best"] and all(r["auc"] is not None for r in out)


def test_reference_forest_settings_and_class_weights(spark, split):
    from strata.operators.models import class_weights

    train, test = split
    params = {"numTrees": 5, "maxDepth": 4, "seed": 42, "minInstancesPerNode": 2, "featureSubsetStrategy": "sqrt"}
    m = build_pipeline("rf", FEATURES, LABEL, impute=IMPUTED, **params).fit(train)
    rf = m.stages[-1]
    assert rf.getMinInstancesPerNode() == 2 and rf.getFeatureSubsetStrategy() == "sqrt" and rf.getNumTrees == 5
    weighted = class_weights(train, LABEL)
    mw = build_pipeline("lr", FEATURES, LABEL, impute=IMPUTED, weight_col="weight", maxIter=20).fit(weighted)
    r = E.classification_metrics(predictions_long({"w": mw}, test, KEYS, LABEL), "label", "prediction").first()
    assert r["accuracy"] > 0.7


def test_hash_folds_cover_all_rows(spark):
    from strata.operators.features import fold_column

    df = readings(spark, SF001).select(fold_column(KEYS, 5))
    counts = {r["fold"]: r["count"] for r in df.groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2, 3, 4} and sum(counts.values()) == 60000
