"""Runs become visible whole: a run killed half-way changes nothing, and nothing of an older run stays."""

import tempfile

import pytest
from pyspark.ml import PipelineModel

from strata.plans import medallion
from strata.plans.documents import SCHEMA, document_rows, layer_document
from strata.plans.readings import FEATURES, KEYS, LABEL, readings
from strata.sources.io import read_table
from strata.sources.layers import read_layer
from strata.sources.publication import Publication, manifest, retire
from strata_paths import SF0001

IMPUTED = ["qty", "price", "tax"]


def run(raw, root, kinds, **more):
    return medallion.run_medallion(raw, root, "readings", LABEL, FEATURES, IMPUTED, KEYS, kinds=kinds, **more)


def test_killed_run_leaves_the_last_one(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="strata-publish-")
    raw = readings(spark, SF0001)
    first = run(raw.withColumn("note", raw.l_orderkey.cast("string")), root, ("dt",))
    before = manifest(spark, root)
    assert read_layer(spark, root, "bronze", "readings").columns == [*raw.columns, "note"]
    assert read_layer(spark, root, "gold", "feature_importance").count() == len(FEATURES)
    assert PipelineModel.load(first["model_decision_tree"]).stages
    # exports and documents
    assert read_layer(spark, root, "gold", "predictions_sample_csv").count() == 50
    assert read_layer(spark, root, "silver", "readings_csv").count() == read_layer(spark, root, "silver", "readings").count()
    gold = document_rows(read_table(spark, first["metrics_json"], fmt="json", schema=SCHEMA)).collect()
    assert [r.text for r in gold if r.section == "best_model"] == ["Decision Tree"]
    assert any(r.section == "hyperparameters" and r.text == "gini" for r in gold)
    bronze = document_rows(read_table(spark, first["readings_stats_json"], fmt="json", schema=SCHEMA)).collect()
    assert {r.section for r in bronze} >= {"table", "label_distribution"}

    def killed(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(medallion, "gold_report", killed)
    with pytest.raises(RuntimeError):
        run(raw.limit(50), root, ("dt",))
    monkeypatch.undo()
    assert manifest(spark, root) == before
    assert read_layer(spark, root, "bronze", "readings").count() == raw.count()
    assert read_layer(spark, root, "gold", "metrics").count() > 0

    # a run that writes no importances leaves none behind
    run(raw, root, ("lr",), params={"lr": {"maxIter": 5}})
    assert read_layer(spark, root, "gold", "model_comparison").count() == 1
    with pytest.raises(LookupError):
        read_layer(spark, root, "gold", "feature_importance")
    assert retire(spark, root, keep=1) == [before["run"]]
    assert read_layer(spark, root, "bronze", "readings").count() == raw.count()


def test_runs_that_end_together_get_their_own_numbers(spark):
    root = tempfile.mkdtemp(prefix="strata-publish-")
    one, two = Publication(spark, root), Publication(spark, root)
    df = spark.range(3)
    one.put(df, "bronze", "t")
    two.put(df.limit(1), "bronze", "t")
    assert (one.switch(), two.switch()) == (1, 2)
    assert read_layer(spark, root, "bronze", "t").count() == 1
    with pytest.raises(ValueError):
        one.path("platinum", "t")
    with pytest.raises(ValueError):
        one.path("gold", "a/b")


def test_documents_keep_types_and_nulls(spark):
    kpis = spark.createDataFrame([("x", "s", "a", 1.5), ("x", "s", "b", None), ("x", "t", "a", -0.0)], "layer string, section string, key string, value double")
    words = spark.createDataFrame([("x", "w", "k", 'quo"ted\n')], "layer string, section string, key string, text string")
    docs = layer_document(kpis, words)
    assert docs.count() == 1
    got = {(r.section, r.key, r.value, r.text) for r in document_rows(docs).collect()}
    assert got == {("s", "a", 1.5, None), ("s", "b", None, None), ("t", "a", 0.0, None), ("w", "k", None, 'quo"ted\n')}
    assert layer_document(kpis.where("1 = 0")).count() == 0
