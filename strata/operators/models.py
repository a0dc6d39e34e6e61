"""MLlib classifiers, the long predictions table, importances and comparison.

Estimators are plain MLlib; each ``fit`` is a set of distributed jobs.  The
library's own work is around them: one long (model, key, label, prediction,
score) table so that every metric for every model is one grouped pass.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators.features import scaler_stage
from strata.plans.physical import join_groups

# The reference's model settings (trees, depth, iterations, seed).
REFERENCE_PARAMS = {
    "rf": {"numTrees": 100, "maxDepth": 10, "seed": 42},
    "dt": {"maxDepth": 10, "seed": 42},
    "lr": {"maxIter": 100},
    "gbt": {"maxIter": 50, "maxDepth": 5, "seed": 42},
}
# The forest of the modelling notebook.
NOTEBOOK_FOREST = REFERENCE_PARAMS["rf"] | {"minInstancesPerNode": 2, "featureSubsetStrategy": "sqrt"}
# Defaults of every fit: the reference's settings, and those of the one model it does not have.
MODEL_PARAMS = REFERENCE_PARAMS | {"svc": {"maxIter": 50}}
MODEL_NAMES = {
    "rf": "Random Forest",
    "dt": "Decision Tree",
    "lr": "Logistic Regression",
    "gbt": "Gradient Boosting",
    "svc": "Linear SVM",
}
_KINDS = {
    "rf": RandomForestClassifier,
    "dt": DecisionTreeClassifier,
    "lr": LogisticRegression,
    "gbt": GBTClassifier,
    "svc": LinearSVC,
}


def classifier(kind: str, features: str = "features", label: str = "label", **params):
    """An MLlib classifier by short name (rf, dt, lr, gbt, svc)."""
    if kind not in _KINDS:
        raise ValueError(f"unknown model kind {kind!r}; expected one of {sorted(_KINDS)}")
    return _KINDS[kind](featuresCol=features, labelCol=label, **params)


def build_pipeline(
    kind: str,
    cols: Sequence[str],
    label: str,
    impute: Sequence[str] = (),
    scale: bool = True,
    weight_col: str | None = None,
    **params,
) -> Pipeline:
    """[Imputer] → VectorAssembler → [StandardScaler] → classifier, fitted as one Pipeline."""
    stages = []
    if impute:
        stages.append(Imputer(inputCols=list(impute), outputCols=list(impute), strategy="mean"))
    stages.append(VectorAssembler(inputCols=list(cols), outputCol="features_raw", handleInvalid="keep"))
    feat = "features_raw"
    if scale:
        stages.append(scaler_stage("features_raw", "features"))
        feat = "features"
    if weight_col:
        params = {**params, "weightCol": weight_col}
    stages.append(classifier(kind, features=feat, label=label, **params))
    return Pipeline(stages=stages)


def fit_all(
    fits: Mapping[str, Callable[[], PipelineModel]], spark: SparkSession, parallelism: int | None = None
) -> dict[str, tuple[PipelineModel, float]]:
    """Run each fit (on cached or stored training rows); returns model and fit seconds.

    Independent fits are submitted from a small thread pool (as MLlib's
    ``CrossValidator(parallelism=...)`` does), so one model's driver-side
    phases overlap with another's distributed jobs.  ``parallelism=1`` fits
    one after another.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    def fit(item):
        name, run = item
        t0 = time.perf_counter()
        model = run()
        return name, (model, time.perf_counter() - t0)

    workers = max(1, min(parallelism or len(fits), len(fits)))
    if workers == 1:
        return dict(fit(item) for item in fits.items())
    with ThreadPoolExecutor(max_workers=workers) as pool:
        return dict(pool.map(inheritable_thread_target(spark)(fit), list(fits.items())))


def scored(model: PipelineModel, df: DataFrame, name: str, keys: Sequence[str], label: str) -> DataFrame:
    """(model, keys..., label, prediction, score, p1, p0) for one fitted model."""
    out = model.transform(df)
    cols = set(out.columns)
    if "probability" in cols:
        prob = vector_to_array("probability")
        p1, p0 = prob[1], prob[0]
    else:  # LinearSVC: no probability, the margin is the score
        raw = vector_to_array("rawPrediction")
        p1, p0 = F.lit(None).cast("double"), F.lit(None).cast("double")
    score = p1 if "probability" in cols else raw[1]
    return out.select(
        F.lit(name).alias("model"),
        *keys,
        F.col(label).cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        score.alias("score"),
        p1.alias("p1"),
        p0.alias("p0"),
    )


def predictions_long(models: Mapping[str, PipelineModel], df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Union of every model's predictions; each branch is a narrow map over ``df`` (cache it)."""
    frames = [scored(m, df, name, keys, label) for name, m in models.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def importances(model: PipelineModel, cols: Sequence[str], name: str = "model") -> DataFrame:
    """(model, feature, importance, rank) of the last stage; rank 1 = most important."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals = [float(v) for v in last.featureImportances.toArray()]
    elif hasattr(last, "coefficients"):
        vals = [abs(float(v)) for v in last.coefficients.toArray()]
    else:
        raise ValueError("model has neither importances nor coefficients")
    session = SparkSession.getActiveSession()
    frame = session.createDataFrame([(name, c, v) for c, v in zip(cols, vals)], "model string, feature string, importance double")
    return rank_desc(frame, "importance", "feature", by=["model"])


def root_split(model: PipelineModel) -> dict[str, float]:
    """The first split of a fitted tree, or of an ensemble's first tree: feature index, threshold, gain, and what each side predicts."""
    last = model.stages[-1]
    root = (last.trees[0] if hasattr(last, "trees") else last)._call_java("rootNode")
    sides = {"left": root.leftChild().prediction(), "right": root.rightChild().prediction()}
    return {"feature": float(root.split().featureIndex()), "threshold": root.split().threshold(), "gain": root.gain(), **sides}


def prediction_contract(preds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(model, keys..., label, consistent): whether a row's class is 0 or 1 and follows from its score, and its probabilities sum to one."""
    by_score = F.when(F.col("p1").isNotNull(), F.col("score") > 0.5).otherwise(F.col("score") > 0.0).cast("int")
    sums = F.col("p1").isNull() | (F.abs(F.col("p1") + F.col("p0") - 1.0) < 1e-9)
    return preds.select("model", *keys, "label", ((F.col("prediction") == by_score) & sums).alias("consistent"))


def rank_desc(df: DataFrame, value: str, name: str, by: Sequence[str] = (), rank_col: str = "rank") -> DataFrame:
    """1-based rank by ``value`` descending, ties by ``name`` (for small frames: features, models)."""
    w = Window.partitionBy(*by).orderBy(F.col(value).desc_nulls_last(), F.col(name).asc())
    return df.withColumn(rank_col, F.row_number().over(w))


def uncertainty_flag(pred: DataFrame, prob_col: str = "p1", eps: float = 0.1) -> DataFrame:
    """Mark predictions whose probability is within ``eps`` of 0.5 for manual checking."""
    return pred.withColumn("needs_review", F.abs(F.col(prob_col) - F.lit(0.5)) < F.lit(eps))


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weights N / (k · n_class) per row, from one grouped count (k = number of classes)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    w = Window.partitionBy()
    counts = counts.select(label, (F.sum("_nc").over(w) / (F.count(F.lit(1)).over(w) * F.col("_nc"))).alias(out))
    return join_groups(df, counts, label, "left")


__all__ = [
    "MODEL_NAMES",
    "REFERENCE_PARAMS",
    "build_pipeline",
    "class_weights",
    "classifier",
    "fit_all",
    "importances",
    "prediction_contract",
    "predictions_long",
    "rank_desc",
    "root_split",
    "scored",
    "uncertainty_flag",
]
