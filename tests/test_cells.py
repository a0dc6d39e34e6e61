"""Trees fitted on counted cells are those fitted on the rows."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from strata.operators.cells import binning, candidate_thresholds, count_cells, fit_cells, fits_on_cells
from strata.operators.models import MODEL_PARAMS, NOTEBOOK_FOREST, classifier
from strata.plans.gold import model_predictions, preprocessing, regression_baselines


@pytest.fixture(scope="module")
def rows(spark):
    """9,000 rows of few cells, with missing values; the label is a noisy rule."""
    r = F.col("id")
    a, b = (r * 7919 % 40).cast("double"), (r * 104729 % 11 / 10).cast("double")
    noise = F.pmod(F.xxhash64("id"), F.lit(100))
    return spark.range(9000).select(
        "id", F.when(r % 13 != 0, a).alias("a"), b.alias("b"), ((a * b > 12) != (noise < 7)).cast("int").alias("y"),
        (a * 3 + b * 50 + noise / 100).alias("z"), F.when(r % 5 == 0, "test").otherwise("train").alias("split"),
    )


@pytest.mark.parametrize("kind,params", [("dt", MODEL_PARAMS["dt"]), ("gbt", {"maxIter": 4, "maxDepth": 4, "seed": 42})])
def test_trees_of_cells_are_those_of_rows(rows, kind, params):
    prep = preprocessing(["a", "b"], ["a"]).fit(rows)
    data = prep.transform(rows)
    stages = binning(data, ["a", "b"])
    cells = count_cells(data, ["a", "b"], "y", stages)
    assert cells.count() < 1000 and cells.agg(F.sum("cell_rows")).first()[0] == 9000
    of_cells = fit_cells(classifier(kind, label="y", **params), cells, stages).transform(data).withColumnRenamed("probability", "p")
    of_rows = classifier(kind, label="y", **params).fit(data).transform(data)
    from pyspark.ml.functions import vector_to_array

    far = of_cells.select("id", vector_to_array("p")[1].alias("p")).join(of_rows.select("id", vector_to_array("probability")[1].alias("q")), "id")
    assert far.where("abs(p - q) > 1e-9").count() == 0


def test_fits_use_cells_and_forests_do_not(spark, rows, monkeypatch):
    from strata.plans import gold

    seen = []
    monkeypatch.setattr(gold, "fit_cells", lambda est, *x: (seen.append(type(est).__name__), fit_cells(est, *x))[1])
    assert model_predictions(rows, "dt", ["a", "b"], ["a"], "y", ["id"]).count() == 1800
    out = {r["model"]: r for r in regression_baselines(rows, ["a", "b"], "z", ["id"]).collect()}
    assert seen == ["DecisionTreeClassifier", "GBTRegressor"]
    assert out["Gradient Boosted Regression"]["r2"] > 0.8 and out["Gradient Boosted Regression"]["n"] == 1800
    assert not fits_on_cells("rf", MODEL_PARAMS["rf"]) and not fits_on_cells("rf", NOTEBOOK_FOREST)
    assert not fits_on_cells("dt", {"minInstancesPerNode": 2}) and not fits_on_cells("gbt", {"subsamplingRate": 0.5})


def test_refused_values_stay_refused(spark):
    df = spark.createDataFrame([(float("nan"), 0), (1.0, 1), (2.0, 0)], "x double, y int")
    stages = binning(df, ["x"])
    with pytest.raises(Exception, match="(?i)nan|invalid"):
        fit_cells(classifier("dt", label="y"), count_cells(df, ["x"], "y", stages), stages)
    odd = spark.createDataFrame([(None,), (float("nan"),), (-5.0,), (1.5,)], "x double")
    bins = [r.x_bin for r in PipelineModel(stages=stages).transform(odd).select("x_bin").collect()]
    assert bins == [None, 2.0, 0.0, 0.0]


def test_thresholds():
    assert candidate_thresholds([], 4) == [] and candidate_thresholds([(1.0, 3)], 4) == []
    assert candidate_thresholds([(2.0, 1), (1.0, 5), (4.0, 1)], 4) == [1.5, 3.0]
    assert len(candidate_thresholds([(float(i), 1) for i in range(1000)], 32)) == 31


def test_a_bagged_forest_is_fitted_on_cells(spark, rows, monkeypatch):
    """No row is shuffled into a fixed layout; the forest is near one on rows, and the same from any layout."""
    from pyspark.ml.functions import vector_to_array

    from strata.operators.cells import fit_forest_cells
    from strata.plans import gold

    params = {"numTrees": 12, "maxDepth": 6, "seed": 42, "minInstancesPerNode": 2}
    on_rows = gold.build_pipeline("rf", ["a", "b"], "y", impute=["a"], **params).fit(gold.fixed_layout(rows, ["id"]).where("split = 'train'"))
    monkeypatch.setattr(gold, "fixed_layout", None)
    one, two = (gold.fit_model(x, "rf", ["a", "b"], ["a"], "y", ["id"], params) for x in (rows, rows.orderBy("z").repartition(7)))
    assert one.stages[-1].getNumTrees == 12 and one.stages[-1].toDebugString.split("\n", 1)[1] == two.stages[-1].toDebugString.split("\n", 1)[1]
    p = [m.transform(rows).select("id", vector_to_array("probability")[1].alias("p")).alias(n) for m, n in ((one, "x"), (on_rows, "y"))]
    assert p[0].join(p[1], "id").agg(F.avg(F.abs(F.col("x.p") - F.col("y.p")))).first()[0] < 0.05
    rare = spark.createDataFrame([(0.0, 0)] * 500 + [(1.0, 1)], "a double, y int")
    stages = binning(rare, ["a"])
    forest = fit_forest_cells(classifier("rf", label="y", numTrees=6, seed=1), count_cells(rare, ["a"], "y", stages), stages)
    assert forest.stages[-1].numClasses == 2 and {t.numClasses for t in forest.stages[-1].trees} == {2}


def test_draws_have_the_law_of_the_rows(spark, rows):
    """Of a cell of n rows, a tree draws n on average, with variance n; subsampling scales both."""
    from strata.operators.cells import draw_counts

    stages = binning(rows, ["b"])
    cells = count_cells(rows, ["b"], "y", stages).where("cell_rows > 300")
    for rate in (1.0, 0.5):
        drawn = draw_counts(cells, "y", 400, rate, 42).join(cells, ["binned", "y"]).collect()
        assert len(drawn) > 5
        for r in drawn:
            counts, mean = [r[f"t{i}"] for i in range(400)], r["cell_rows"] * rate
            average = sum(counts) / 400
            assert abs(average - mean) < 5 * (mean / 400) ** 0.5
            assert 0.7 * mean < sum((c - average) ** 2 for c in counts) / 399 < 1.35 * mean


def test_a_layered_run_of_cells_makes_no_fixed_layout(rows, monkeypatch):
    from strata.plans import gold

    monkeypatch.setattr(gold, "fixed_layout", None)
    small = {"rf": {"numTrees": 3, "maxDepth": 3, "seed": 1}, "lr": {"maxIter": 5}}
    run = gold.run_models(rows, ["a", "b"], ["a"], "y", ["id"], ("rf", "lr"), small)
    assert {r["model"]: r["n"] for r in run.metrics.collect()} == {"Random Forest": 1800, "Logistic Regression": 1800}
    run.release()


@pytest.mark.parametrize("worth,levels", [(4, []), (10**9, [(True, False)])])
def test_a_layered_run_keeps_no_rows_in_memory(spark, rows, monkeypatch, worth, levels):
    """Rows, predictions and metrics are read from files; only the layout of a forest on rows is kept, on disk."""
    from strata.plans import gold

    seen, frame = [], type(rows)
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda df, *level: (out := persist(df, *level), seen.append((out.storageLevel.useDisk, out.storageLevel.useMemory)))[0])
    monkeypatch.setattr(gold, "WORTH", worth)
    small = {"rf": {"numTrees": 3, "maxDepth": 3, "seed": 1}, "dt": {"maxDepth": 3, "seed": 1}, "lr": {"maxIter": 5}}
    run = gold.run_models(rows, ["a", "b"], ["a"], "y", ["id"], ("rf", "dt", "lr"), small)
    assert seen == levels
    assert run.preds.inputFiles() and run.metrics.inputFiles() and run.test_rows.inputFiles()
    report = {(r["section"], r["key"]): r["value"] for r in gold.gold_report(run, ["a", "b"]).collect()}
    assert (report["table", "train_size"], report["table", "test_size"]) == (7200, 1800)
    assert sum(report["confusion_matrix", c] for c in ("TN", "FP", "FN", "TP")) == 1800
    run.release()
    assert not run.train_rows.storageLevel.useDisk
