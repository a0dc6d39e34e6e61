"""Trees and forests, fitted on counted cells instead of rows.

A tree sees of a row only the bin of each feature, at most ``maxBins`` of them,
and its label.  So rows are counted by (bins, label) in one aggregation, and the
estimator makes its many passes over these weighted cells.  The candidate
thresholds follow MLlib's rule on a sample of MLlib's size, drawn by the rows'
hash; ``Bucketizer`` applies them, and is part of the fitted pipeline.

A bagged forest gives each row a Poisson count for each tree.  The counts of a
cell's n rows add up to a Poisson count of mean n, so one draw for each cell
and tree has the same law, and each tree is fitted on cells weighted by its own
draws.  These hang on the cell and the seed, not on the layout.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from math import inf, nextafter

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.plans.physical import materialize

MAX_BINS = 32  # MLlib's default
BINNED, CELL_ROWS = "binned", "cell_rows"
AT_ONCE = 8  # trees of a forest fitted at the same time


def fits_on_cells(kind: str, params: Mapping) -> bool:
    """Whether the model depends on the counts of the cells alone: no sampling of rows or features, no least number of rows."""
    plain = params.get("minInstancesPerNode", 1) == 1 and params.get("subsamplingRate", 1.0) == 1.0 and "weightCol" not in params
    return kind in ("dt", "gbt") and plain and params.get("featureSubsetStrategy", "all") in ("all", "auto")


def bags_on_cells(kind: str, params: Mapping) -> bool:
    """Whether the model is a forest whose trees draw rows with replacement."""
    return kind == "rf" and params.get("numTrees", 20) > 1 and params.get("bootstrap", True) and "weightCol" not in params


def candidate_thresholds(counts: Sequence[tuple[float, int]], bins: int) -> list[float]:
    """Thresholds between (value, count) pairs: every midpoint, or those nearest to ``bins`` equal shares."""
    pairs = sorted(counts)
    middles = [(a + b) / 2 for (a, _), (b, _) in zip(pairs, pairs[1:])]
    if len(middles) < bins:
        return middles
    stride = sum(n for _, n in pairs) / bins
    out, seen, target = [], pairs[0][1], stride
    for middle, (_, n) in zip(middles, pairs[1:]):
        if abs(seen - target) < abs(seen + n - target):
            out.append(middle)
            target += stride
        seen += n
    return out


def binning(df: DataFrame, features: Sequence[str], bins: int = MAX_BINS) -> list:
    """[Bucketizer, VectorAssembler] from ``features`` to the vector of bin numbers.

    Up to max(bins², 10000) rows tell the thresholds, as in MLlib: all, or those of the least hashes."""
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in features])
    size = max(bins * bins, 10_000)
    sample = rows.orderBy(F.xxhash64(*features), *features).limit(size) if df.count() > size else rows
    finite = sample.unpivot([], list(features), "feature", "value").where(F.abs("value") < inf)
    found: dict[str, list] = {c: [] for c in features}
    for r in finite.groupBy("feature", "value").count().collect():  # at most ``size`` rows a feature
        found[r["feature"]].append((r["value"], r["count"]))
    # equal middles are one; a feature of one value gets two bins, of which one stays empty
    splits = [[-inf, *(sorted({_above(t) for t in candidate_thresholds(found[c], bins)}) or [0.0]), inf] for c in features]
    names = [f"{c}_bin" for c in features]
    return [
        Bucketizer(inputCols=list(features), outputCols=names, splitsArray=splits, handleInvalid="keep"),
        VectorAssembler(inputCols=names, outputCol=BINNED, handleInvalid="keep"),
    ]


def _above(threshold: float) -> float:
    """A tree sends values up to the threshold left, Bucketizer those below its split."""
    return nextafter(threshold, inf)


def count_cells(df: DataFrame, features: Sequence[str], label: str, stages: Sequence, mean: bool = False) -> DataFrame:
    """(``binned``, label, ``cell_rows``): rows per (bins, label); with ``mean``, per bins, with their mean label.

    Values and labels that the estimators refuse (null, NaN, infinite) stay such, so that they refuse the cells."""
    bucketizer, assembler = stages
    rows = df.select(*[F.when(F.abs(F.col(c)) < inf, F.col(c).cast("double")).alias(c) for c in features], F.col(label).alias("_label"))
    # a sum, as the bucket's own column says that it is a category
    binned = [(F.col(c) + 0.0).alias(c) for c in bucketizer.getOutputCols()]
    grouped = bucketizer.transform(rows).groupBy(*binned, *([] if mean else ["_label"]))
    y = F.when(F.count("_label") == F.count(F.lit(1)), F.avg("_label")) if mean else F.col("_label")
    counted = grouped.agg(F.count(F.lit(1)).cast("double").alias(CELL_ROWS), *([y.alias("_mean")] if mean else []))
    labelled = counted.withColumnRenamed("_mean" if mean else "_label", label)
    return materialize(assembler.transform(labelled).select(BINNED, label, CELL_ROWS), "cells")


def fit_cells(estimator, cells: DataFrame, stages: Sequence) -> PipelineModel:
    """The bin stages and the estimator's model, to be put behind the preprocessing."""
    model = estimator.setFeaturesCol(BINNED).setWeightCol(CELL_ROWS).fit(cells)
    model.clear(model.getParam("weightCol"))  # the rows to be scored have no weight
    return PipelineModel(stages=[*stages, model])


def draw_counts(cells: DataFrame, label: str, trees: int, rate: float, seed: int) -> DataFrame:
    """(``binned``, label, ``t0``, ``t1``...): of each cell, how many times its rows are drawn for each tree."""
    names = [f"t{i}" for i in range(trees)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            draws = np.zeros((b.num_rows, trees))
            for i, (key, n) in enumerate(zip(b["key"].to_pylist(), b[CELL_ROWS].to_pylist())):
                draws[i] = np.random.default_rng([key % 2**64, seed % 2**64]).poisson(n * rate, trees)
            yield pa.RecordBatch.from_arrays([b["bins"], b["y"], *(pa.array(d) for d in draws.T.copy())], names=["bins", "y", *names])

    keyed = cells.select(vector_to_array(BINNED).alias("bins"), F.col(label).alias("y"), CELL_ROWS).withColumn("key", F.xxhash64("bins", "y"))
    kind = cells.schema[label].dataType.simpleString()
    drawn = keyed.mapInArrow(run, f"bins array<double>, y {kind}, " + ", ".join(f"{n} double" for n in names))
    return materialize(drawn.select(array_to_vector("bins").alias(BINNED), F.col("y").alias(label), *names), "draws")


def fit_forest_cells(estimator, cells: DataFrame, stages: Sequence) -> PipelineModel:
    """The bin stages and the forest of trees each fitted on its own draws."""
    estimator = estimator.setFeaturesCol(BINNED)
    label, trees, seed = estimator.getLabelCol(), estimator.getNumTrees(), estimator.getSeed()
    least, subset = estimator.getMinInstancesPerNode(), estimator.getFeatureSubsetStrategy()
    names = [f"t{i}" for i in range(trees)]
    drawn = draw_counts(cells, label, trees, estimator.getSubsamplingRate(), seed)
    known = cells.agg(F.max(label).alias("top")).first()["top"]
    # a tree that draws no row of the last class has it nevertheless
    classes = {} if known is None else {"metadata": {"ml_attr": {"type": "nominal", "num_vals": int(known) + 1}}}
    totals = drawn.agg(*[F.sum(n).alias(n) for n in names]).first()
    seeds = np.random.SeedSequence(seed % 2**64).generate_state(trees).tolist()

    def grow(i: int):
        one = estimator.copy().setNumTrees(1).setBootstrap(False).setSubsamplingRate(1.0).setSeed(seeds[i]).setWeightCol(CELL_ROWS)
        one = one.setFeatureSubsetStrategy("sqrt" if subset == "auto" else subset).setMinInstancesPerNode(1)
        if least > 1:  # counted in rows, which are weights here
            one = one.setMinWeightFractionPerNode(min(0.499, (least - 0.5) / (totals[names[i]] or 1.0)))
        return one.fit(drawn.select(BINNED, F.col(label).alias(label, **classes), F.col(names[i]).alias(CELL_ROWS)).where(F.col(CELL_ROWS) > 0))

    with ThreadPoolExecutor(max_workers=AT_ONCE) as pool:
        grown = list(pool.map(inheritable_thread_target(cells.sparkSession)(grow), range(trees)))
    return PipelineModel(stages=[*stages, _forest(estimator, grown)])


def _forest(estimator, grown: Sequence[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """One forest of the forests' trees."""
    sc = SparkContext.getOrCreate()
    classes = sc._jvm.org.apache.spark.ml.classification
    array = sc._gateway.new_array(classes.DecisionTreeClassificationModel, len(grown))
    for i, m in enumerate(grown):
        array[i] = m._java_obj.trees()[0]
    java = classes.RandomForestClassificationModel(estimator.uid, array, grown[0].numFeatures, max(m.numClasses for m in grown))
    model = estimator._copyValues(RandomForestClassificationModel(java))
    model._transfer_params_to_java()
    return model
