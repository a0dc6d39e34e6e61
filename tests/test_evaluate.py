import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from strata_paths import SF001
from strata.operators import evaluate as E
from strata.plans.rules import rule_predictions


def cm_frame(spark, tn, fp, fn, tp, model="m"):
    rows = [(model, 0, 0)] * tn + [(model, 0, 1)] * fp + [(model, 1, 0)] * fn + [(model, 1, 1)] * tp
    return spark.createDataFrame(rows, "model string, label int, prediction int")


# published confusion matrices on 601 test rows and their rounded metrics
GOLDEN = [
    ((344, 35, 172, 50), (0.6556, 0.6051, 0.6377, 0.6556)),
    ((303, 76, 152, 70), (0.6206, 0.5987, 0.5971, 0.6206)),
    ((379, 0, 221, 1), (0.6323, 0.4916, 0.7677, 0.6323)),
    ((316, 63, 145, 77), (0.6539, 0.6316, 0.6354, 0.6539)),
]


@pytest.mark.parametrize("cm,expected", GOLDEN)
def test_golden_metrics_from_confusion(spark, cm, expected):
    r = E.classification_metrics(cm_frame(spark, *cm), "label", "prediction", ["model"], digits=None).first()
    got = tuple(round(r[m], 4) for m in ["accuracy", "f1", "weighted_precision", "weighted_recall"])
    assert got == expected
    w = E.confusion_wide(cm_frame(spark, *cm), "label", "prediction").first()
    assert (w["tn"], w["fp"], w["fn"], w["tp"]) == cm and w["n"] == 601


FIXTURE4 = {
    "by_qty": (0.748583, 0.750229, 0.761177, 0.748583, 0.829367),
    "by_disc": (0.743733, 0.744714, 0.746884, 0.743733, 0.827713),
    "never": (0.58065, 0.426602, 0.337154, 0.58065, 0.5),
}


def test_rule_models_match_published_fixture_values(spark):
    p = rule_predictions(spark, SF001)
    m = {r["model"]: r for r in E.evaluate(p, "y", "prediction", "score", by=["model"]).collect()}
    for name, vals in FIXTURE4.items():
        got = tuple(m[name][k] for k in ["accuracy", "f1", "weighted_precision", "weighted_recall", "auc"])
        assert got == pytest.approx(vals, abs=1e-6), name


def test_metrics_equal_mllib_evaluators(spark):
    p = rule_predictions(spark, SF001).filter("model = 'by_qty'")
    p = p.withColumn("label", F.col("y").cast("double")).withColumn("prediction", F.col("prediction").cast("double"))
    ours = E.evaluate(p, "label", "prediction", "score", digits=None).first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for ours_name, ml_name in [("accuracy", "accuracy"), ("f1", "f1"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall")]:
        assert ours[ours_name] == pytest.approx(ev.evaluate(p, {ev.metricName: ml_name}), abs=1e-9)
    raw = p.withColumn("raw", array_to_vector(F.array(F.lit(1.0) - F.col("score"), F.col("score"))))
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="raw", metricName="areaUnderROC").evaluate(raw)
    assert ours["auc"] == pytest.approx(auc, abs=1e-9)


def test_auc_independent_of_slices(spark):
    p = rule_predictions(spark, SF001)
    a = {r["model"]: r["auc"] for r in E.auc_roc(p, "y", "score", ["model"], slices=1).collect()}
    b = {r["model"]: r["auc"] for r in E.auc_roc(p, "y", "score", ["model"], slices=37).collect()}
    assert a == b


def test_one_class_only(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.2), (1, 1, 0.7)], "label int, prediction int, score double")
    r = E.evaluate(df, "label", "prediction", "score", digits=None).first()
    assert r["auc"] is None  # undefined, not 1.0
    assert r["accuracy"] == pytest.approx(2 / 3)
    pc = {x["class"]: x for x in E.per_class_metrics(df, "label", "prediction").collect()}
    assert set(pc) == {1}


def test_zero_predictions_of_a_class_count_as_zero_precision(spark):
    r = E.classification_metrics(cm_frame(spark, 5, 0, 3, 0), "label", "prediction", digits=None).first()
    assert r["weighted_precision"] == pytest.approx(5 / 8 * 5 / 8)


def test_best_model_ties_go_to_name(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.1)], "model string, accuracy double")
    assert E.best_row(df, "accuracy").first()["model"] == "a"
    marked = {r["model"]: r["is_best"] for r in E.mark_best(df, "accuracy").collect()}
    assert marked == {"a": True, "b": False, "c": False}


def test_target_check_and_baselines(spark):
    df = spark.createDataFrame([("m", 0.96, 0.5)], "model string, accuracy double, f1 double")
    long = E.metrics_long(df, ["model"])
    out = {r["metric"]: r["target_met"] for r in E.target_check(long, E.targets_frame(spark)).collect()}
    assert out == {"accuracy": True, "f1": False}
    b = {r["model"]: r["gap_to_best"] for r in E.baseline_comparison(df).collect()}
    assert b["m"] == 0.0 and b["SVM"] == pytest.approx(-0.01)
