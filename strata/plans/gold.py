"""Gold layer: fit the classifiers, score the test rows, compare and rank.

Train and test come from the hash split.  A comparison stores its rows, its
predictions and its metrics once as files, from which every fit and every
metric reads.  Parameters default to the reference's settings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial
from math import ceil, sqrt

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler

from strata.functions.columns import rnd
from strata.operators import evaluate as E
from strata.operators.cells import MAX_BINS, bags_on_cells, binning, count_cells, fit_cells, fit_forest_cells, fits_on_cells
from strata.operators.features import scaler_stage
from strata.operators.models import MODEL_NAMES, MODEL_PARAMS, build_pipeline, classifier, fit_all, importances, predictions_long, root_split
from strata.plans.physical import materialize

#: Rows per counted cell from which cells are fitted instead of rows.
WORTH = 4


def fixed_layout(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The same rows in the same order in the same partitions, on any cluster and from any input layout.

    A forest's bagging draws by partition and row, and takes no weights per
    tree, so its layout is made a function of the data: rows are dealt by the
    hash of their ``keys`` (default: all columns) and sorted.  Their number
    alone sets that of the partitions, by a square root: 600,000 rows make 33
    partitions, 10^12 rows 41,667 of 24 million.
    """
    rest = [c for c in df.columns if c not in set(keys)]
    partitions = max(1, ceil(sqrt(df.count()) / 24))
    return df.repartition(partitions, *(keys or df.columns)).sortWithinPartitions(*keys, *rest)


def _split_base(df: DataFrame, keys: Sequence[str] = (), split_col: str = "split") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(base, train, test): two filters of one cached, spread-out input (read once, used by every fit)."""
    base = fixed_layout(df, keys).persist()
    return base, base.filter(F.col(split_col) == "train"), base.filter(F.col(split_col) == "test")


def preprocessing(features: Sequence[str], impute: Sequence[str]) -> Pipeline:
    """Imputer → VectorAssembler → StandardScaler, fitted once and shared by every model."""
    stages = []
    if impute:
        stages.append(Imputer(inputCols=list(impute), outputCols=list(impute), strategy="mean"))
    stages.append(VectorAssembler(inputCols=list(features), outputCol="features_raw", handleInvalid="keep"))
    stages.append(scaler_stage("features_raw", "features"))
    return Pipeline(stages=stages)


def model_predictions(
    df: DataFrame,
    kind: str,
    features: Sequence[str],
    impute: Sequence[str],
    label: str,
    keys: Sequence[str],
    params: Mapping | None = None,
) -> DataFrame:
    """Fit one pipeline on the train rows, return its long predictions on the test rows: a narrow map over the input."""
    model = fit_model(df, kind, features, impute, label, keys, params)
    return predictions_long({MODEL_NAMES[kind]: model}, df.filter("split = 'test'"), keys, label)


def fit_model(df: DataFrame, kind: str, features: Sequence[str], impute: Sequence[str], label: str, keys: Sequence[str], params: Mapping | None = None) -> PipelineModel:
    """One pipeline fitted on the train rows: of trees on their counted cells, which hang on no layout; else on the fixed layout."""
    params = params or MODEL_PARAMS[kind]
    if fits_on_cells(kind, params) or bags_on_cells(kind, params):
        train = df.filter("split = 'train'").select(*dict.fromkeys([*features, label])).persist()
        prep = preprocessing(features, impute).fit(train)
        counted = _cells(prep, train, features, label, params)
        train.unpersist()
        if counted:
            return PipelineModel(stages=[*prep.stages, *_fit_counted(kind, label, params, counted).stages])
    base, train, _ = _split_base(df, keys)
    model = build_pipeline(kind, features, label, impute=impute, **params).fit(train)
    base.unpersist()
    return model


def _fit_counted(kind: str, label: str, params: Mapping, counted: tuple[DataFrame, list]) -> PipelineModel:
    fit = fit_forest_cells if bags_on_cells(kind, params) else fit_cells
    return fit(classifier(kind, label=label, **params), *counted)


def _cells(prep: PipelineModel, train: DataFrame, features: Sequence[str], label: str, params: Mapping, mean: bool = False) -> tuple[DataFrame, list] | None:
    """The counted cells of the imputed rows and the bin stages; nothing if the cells are not far fewer than the rows."""
    rows = prep.transform(train)
    stages = binning(rows, features, params.get("maxBins", MAX_BINS))
    cells = count_cells(rows, features, label, stages, mean)
    return (cells, stages) if cells.count() * WORTH <= train.count() else None


def feature_importance(df: DataFrame, kind: str, features: Sequence[str], impute: Sequence[str], label: str, keys: Sequence[str] = ()) -> DataFrame:
    return importances(fit_model(df, kind, features, impute, label, keys), features, MODEL_NAMES[kind])


class GoldRun:
    """Everything one comparison run produced: fitted pipelines, the long predictions, metrics and timings.

    Predictions and metrics are stored tables; the rows are read from the stored input."""

    def __init__(self, models, preds, metrics, fit_seconds, train_rows, test_rows):
        self.models = models
        self.preds = preds
        self.metrics = metrics
        self.fit_seconds = fit_seconds
        self.train_rows = train_rows
        self.test_rows = test_rows

    def release(self) -> None:
        """Drop the kept training rows of a forest on rows; what was computed from them must be stored by then."""
        self.train_rows.unpersist()


def run_models(
    df: DataFrame,
    features: Sequence[str],
    impute: Sequence[str],
    label: str,
    keys: Sequence[str],
    kinds: Sequence[str] = ("rf", "dt", "lr", "gbt"),
    params: Mapping[str, Mapping] | None = None,
) -> GoldRun:
    # stored, not cached: no pass but the estimators' own holds rows in the executors' memory
    needed = {*keys, label, *features, "split"}
    base = materialize(df.select(*[c for c in df.columns if c in needed]), "split")
    train, test = base.filter("split = 'train'"), base.filter("split = 'test'")
    # fit imputation and scaling once; every classifier trains on the same vectors, or on their cells
    prep = preprocessing(features, impute).fit(train)
    chosen = {k: (params or {}).get(k) or MODEL_PARAMS[k] for k in kinds}
    by_bins: dict[int, tuple | None] = {}
    counted: dict[str, tuple | None] = {}
    for k in kinds:
        if fits_on_cells(k, chosen[k]) or bags_on_cells(k, chosen[k]):
            bins = chosen[k].get("maxBins", MAX_BINS)
            if bins not in by_bins:
                by_bins[bins] = _cells(prep, train, features, label, chosen[k])
            counted[k] = by_bins[bins]
    # no step on cells draws by the layout; the fixed one is made only for a forest on rows, and kept on disk for its passes
    on_rows = "rf" in kinds and not counted.get("rf")
    train_v = prep.transform(fixed_layout(base, keys).filter("split = 'train'") if on_rows else train).select(label, "features")
    if on_rows:
        train_v = train_v.persist(StorageLevel.DISK_ONLY)
        train_v.count()
    test_rows = materialize(test.select(*dict.fromkeys([*keys, label, *features])), "test")
    test_v = prep.transform(test_rows)

    def fit(kind):
        if counted.get(kind):
            return _fit_counted(kind, label, chosen[kind], counted[kind])
        return Pipeline(stages=[classifier(kind, features="features", label=label, **chosen[kind])]).fit(train_v)

    fitted = fit_all({MODEL_NAMES[k]: partial(fit, k) for k in kinds}, df.sparkSession)
    # full pipelines (preprocessing + classifier) are what a caller saves and reloads
    models = {n: PipelineModel(stages=[*prep.stages, *m.stages]) for n, (m, _) in fitted.items()}
    preds = materialize(predictions_long({n: fitted[n][0] for n in models}, test_v, keys, label), "predictions")
    metrics = materialize(E.evaluate(preds, "label", "prediction", "score", by=["model"]), "metrics")
    return GoldRun(models, preds, metrics, {n: s for n, (_, s) in fitted.items()}, train_v, test_v)


def gold_report(run: GoldRun, features: Sequence[str], layer: str = "gold") -> DataFrame:
    """(layer, section, key, value) for the best model: sizes, metrics, confusion cells, importances, params, and
    every model's metrics.  The best model is the arg-max of accuracy (ties by name)."""
    spark = run.preds.sparkSession
    marked = E.mark_best(run.metrics, "accuracy", "model")
    best = marked.filter("is_best").select("model")
    kpi = "layer string, section string, key string, value double"
    sizes = run.train_rows.agg(F.count(F.lit(1)).cast("double").alias("v")).select(
        F.lit(layer).alias("layer"), F.lit("table").alias("section"), F.lit("train_size").alias("key"), F.col("v").alias("value")
    ).unionByName(
        run.test_rows.agg(F.count(F.lit(1)).cast("double").alias("v")).select(
            F.lit(layer), F.lit("table"), F.lit("test_size"), F.col("v")
        ).toDF("layer", "section", "key", "value")
    )
    comparison = E.metrics_long(marked.drop("is_best", "n"), ["model"]).select(
        F.lit(layer).alias("layer"), F.concat(F.lit("model_comparison."), F.col("model")).alias("section"),
        F.col("metric").alias("key"), F.col("value"),
    )
    best_metrics = comparison.join(best.select(F.concat(F.lit("model_comparison."), F.col("model")).alias("section")), "section").select(
        "layer", F.lit("metrics").alias("section"), "key", "value"
    )
    cm = E.confusion_wide(run.preds, "label", "prediction", ["model"]).join(best, "model")
    cells = cm.select(
        F.inline(
            F.array(*[F.struct(F.lit(layer).alias("layer"), F.lit("confusion_matrix").alias("section"), F.lit(c.upper()).alias("key"), F.col(c).cast("double").alias("value")) for c in ("tn", "fp", "fn", "tp")])
        )
    )
    best_name = best.first()
    rows = []
    if best_name is not None:
        model = run.models[best_name["model"]]
        last = model.stages[-1]
        if hasattr(last, "featureImportances"):
            rows += [(layer, "feature_importance", f, float(v)) for f, v in zip(features, last.featureImportances.toArray())]
        for p, v in last.extractParamMap().items():
            if isinstance(v, (int, float)) and not isinstance(v, bool):
                rows.append((layer, "hyperparameters", p.name, float(v)))
    extra = spark.createDataFrame(rows, kpi)
    return sizes.unionByName(best_metrics).unionByName(cells).unionByName(extra).unionByName(comparison)


def gold_texts(run: GoldRun, layer: str = "gold") -> DataFrame:
    """(layer, section, key, text): the best model's name and its parameters that are words or flags."""
    spark = run.preds.sparkSession
    best = E.best_row(run.metrics, "accuracy", "model").first()
    rows = []
    if best is not None:
        rows.append((layer, "best_model", "name", best["model"]))
        for p, v in run.models[best["model"]].stages[-1].extractParamMap().items():
            if isinstance(v, (str, bool)):
                rows.append((layer, "hyperparameters", p.name, str(v).lower() if isinstance(v, bool) else v))
    return spark.createDataFrame(rows, "layer string, section string, key string, text string")


def model_comparison(
    df: DataFrame,
    features: Sequence[str],
    impute: Sequence[str],
    label: str,
    keys: Sequence[str],
    kinds: Sequence[str] = ("rf", "dt", "lr", "gbt"),
    params: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """Fit every model, score the shared test rows once, and compute all metrics in grouped passes.

    Returns (model, accuracy, f1, weighted_precision, weighted_recall, n, auc, fit_seconds, is_best).
    """
    run = run_models(df, features, impute, label, keys, kinds, params)
    spark = df.sparkSession
    secs = spark.createDataFrame([(n, float(v)) for n, v in run.fit_seconds.items()], "model string, fit_seconds double")
    out = materialize(E.mark_best(run.metrics.join(secs, "model", "left"), "accuracy", "model"), "comparison")
    run.release()
    return out


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    impute: Sequence[str],
    label: str,
    keys: Sequence[str],
    folds: int = 3,
    reg_params: Sequence[float] = (0.0, 0.01, 0.1),
) -> DataFrame:
    """k-fold cross-validation of logistic regression over ``regParam``; folds come from the key hash.

    Returns (reg_param, mean_auc, is_best).  Folds are layout-independent, like the split.
    """
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    from strata.operators.features import fold_column

    # no step draws by the layout; stored, as the validator itself caches both sides of a fold
    train = materialize(df.filter("split = 'train'").select(*dict.fromkeys([*features, label]), fold_column(keys, folds)), "folds")
    prep = preprocessing(features, impute).fit(train)
    data = prep.transform(train).select(label, "features", "fold")
    lr = classifier("lr", features="features", label=label, **MODEL_PARAMS["lr"])
    grid = ParamGridBuilder().addGrid(lr.regParam, list(reg_params)).build()
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    cv = CrossValidator(
        estimator=lr, estimatorParamMaps=grid, evaluator=ev, foldCol="fold", numFolds=folds, parallelism=min(4, len(grid))
    )
    fitted = cv.fit(data)
    spark = df.sparkSession
    rows = [(float(m[lr.regParam]), float(a)) for m, a in zip(grid, fitted.avgMetrics)]
    out = spark.createDataFrame(rows, "reg_param double, mean_auc double")
    return E.mark_best(out, "mean_auc", "reg_param")


def regression_baselines(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str]) -> DataFrame:
    """Linear (ridge) regression and gradient-boosted trees on the hash split; (model, n, rmse, mae, r2) on test."""
    from pyspark.ml.regression import GBTRegressor, LinearRegression

    from strata.operators.quality import regression_metrics

    base, train, test = _split_base(df.withColumns({c: F.col(c).cast("double") for c in features}).select(*dict.fromkeys([*keys, *features, target, "split"])), keys)
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    prep = Pipeline(stages=[Imputer(inputCols=list(features), outputCols=list(features), strategy="mean"), asm]).fit(train)
    line = LinearRegression(featuresCol="features", labelCol=target, regParam=0.1, elasticNetParam=0.0)
    boosted = GBTRegressor(featuresCol="features", labelCol=target, **MODEL_PARAMS["gbt"])
    # squared loss sees of a cell's labels their number and mean
    counted = _cells(prep, train, features, target, MODEL_PARAMS["gbt"], mean=True)
    models = {
        "Ridge Regression": line.fit(prep.transform(train)),
        "Gradient Boosted Regression": fit_cells(boosted, *counted) if counted else boosted.fit(prep.transform(train)),
    }
    frames = []
    for name, fitted in models.items():
        scored = fitted.transform(prep.transform(test))
        frames.append(scored.select(F.lit(name).alias("model"), F.col(target).alias("y"), F.col("prediction").alias("yhat")))
    allp = frames[0]
    for f in frames[1:]:
        allp = allp.unionByName(f)
    out = materialize(regression_metrics(allp, "y", "yhat", ["model"]), "regression")
    base.unpersist()
    return out


def exact_fits(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], flag: Column, x: str, y: str) -> DataFrame:
    """(model, quantity, value) of fits that SQL can state exactly, to hold the estimators' wiring against.

    Trees of one split over features of few values (every midpoint is a
    candidate): a decision tree, a forest without sampling, a boosted ensemble's
    first tree (on labels of -1 and 1, so with twice the gain).  A logistic
    regression of the label on the two-valued ``flag``; a least-squares line of
    ``y`` on ``x``.
    """
    from pyspark.ml.regression import LinearRegression

    base = fixed_layout(df.withColumn("_flag", flag), keys).persist()
    one = {"maxDepth": 1, "maxBins": 128, "seed": 42}
    stumps = {
        "dt": one,
        "rf": one | {"numTrees": 1, "bootstrap": False, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"},
        "gbt": one | {"maxIter": 1, "featureSubsetStrategy": "all"},
    }
    rows = []
    for kind, params in stumps.items():
        model = build_pipeline(kind, features, label, scale=False, **params).fit(base)
        rows += [(MODEL_NAMES[kind], k, float(v)) for k, v in root_split(model).items()]
        if kind == "dt":
            rows.append((MODEL_NAMES[kind], "importance", float(max(model.stages[-1].featureImportances.toArray()))))
    lr = build_pipeline("lr", ["_flag"], label, scale=False, maxIter=100, tol=1e-12).fit(base).stages[-1]
    line = Pipeline(stages=[VectorAssembler(inputCols=[x], outputCol="features"), LinearRegression(labelCol=y, solver="normal")]).fit(base).stages[-1]
    base.unpersist()
    fine = [(MODEL_NAMES["lr"], "intercept", lr.intercept), (MODEL_NAMES["lr"], "coefficient", lr.coefficients[0])]
    fine += [("Linear Regression", "slope", line.coefficients[0]), ("Linear Regression", "intercept", line.intercept), ("Linear Regression", "r2", line.summary.r2)]
    spark, kind = df.sparkSession, "model string, quantity string, value double"
    out = spark.createDataFrame(rows, kind).withColumn("value", rnd(F.col("value"), 6))
    return out.unionByName(spark.createDataFrame([(m, q, float(v)) for m, q, v in fine], kind).withColumn("value", rnd(F.col("value"), 4)))
