"""End-to-end layered run: raw table → bronze → silver → gold, published in one step.

bronze/<table>          the whole raw table as read
bronze/<table>_stats    the bronze KPI frame
silver/<table>          imputed, de-duplicated rows (also ``_csv``)
silver/<table>_stats    the silver KPI frame
gold/model_comparison   metrics per model with fit seconds and the best mark (also ``_csv``)
gold/feature_importance importances of the best model if it is of trees, ranked (also ``_csv``)
gold/predictions_sample first rows of the best model's test predictions (also ``_csv``)
gold/metrics            the gold KPI frame (sizes, metrics, confusion cells, parameters)
gold/model_<name>       every fitted pipeline (MLlib format)
<layer>/<...>_stats_json, gold/metrics_json   each layer's statistics document, one JSON object

Every step is a Spark job on the cluster; the root may be any Hadoop URI.  The
tables lie in the run's own folder and become current together, by the
manifest that ends the run (``sources.publication``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import rnd
from strata.operators import evaluate as E
from strata.operators.features import hash_split
from strata.operators.models import importances
from strata.plans import reports as R
from strata.plans.documents import layer_document
from strata.plans.gold import gold_report, gold_texts, run_models
from strata.sources.publication import Publication


def run_medallion(
    raw: DataFrame,
    root: str,
    table: str,
    label: str,
    features: Sequence[str],
    impute_cols: Sequence[str],
    keys: Sequence[str],
    kinds: Sequence[str] = ("rf", "dt", "lr", "gbt"),
    params: Mapping[str, Mapping] | None = None,
    classes: Sequence[int] | None = None,
    sample_rows: int = 50,
) -> dict[str, str]:
    """Write all three layers under ``root`` and switch to them; returns {name: folder}."""
    spark = raw.sparkSession
    to = Publication(spark, root)
    content = [*features, label]

    # bronze: the whole table as read, plus its profile
    bronze = to.put(raw, "bronze", table)
    stats = to.put(R.bronze_report(bronze.drop(*keys), label, classes), "bronze", f"{table}_stats")
    to.put(layer_document(stats), "bronze", f"{table}_stats_json", "json")

    # silver: imputed and de-duplicated (keys kept so the split stays layout-independent)
    clean, _ = R.silver_tables(bronze.select(*keys, *content), impute_cols, content_cols=content, keys=keys)
    silver = to.put(clean, "silver", table)
    to.put(silver, "silver", f"{table}_csv", "csv")
    stats = to.put(R.silver_report(bronze.select(*content), label, impute_cols, features, classes), "silver", f"{table}_stats")
    to.put(layer_document(stats), "silver", f"{table}_stats_json", "json")

    # gold: fit, compare, explain
    run = run_models(hash_split(silver, keys), features, [], label, keys, kinds, params)
    secs = spark.createDataFrame([(n, float(v)) for n, v in run.fit_seconds.items()], "model string, fit_seconds double")
    comparison = to.put(E.mark_best(run.metrics.join(secs, "model", "left"), "accuracy", "model"), "gold", "model_comparison")
    to.put(comparison, "gold", "model_comparison_csv", "csv")
    best = comparison.filter("is_best").first()
    if best is not None:
        name = best["model"]
        model = run.models[name]
        if hasattr(model.stages[-1], "featureImportances"):
            to.put(to.put(importances(model, features, name), "gold", "feature_importance"), "gold", "feature_importance_csv", "csv")
        sample = (
            run.preds.filter(F.col("model") == name)
            .orderBy(*keys)
            .limit(sample_rows)
            .select(*keys, "label", "prediction", rnd(F.col("p1"), 4).alias("p1"), rnd(F.col("p0"), 4).alias("p0"))
        )
        to.put(to.put(sample, "gold", "predictions_sample"), "gold", "predictions_sample_csv", "csv")
    metrics = to.put(gold_report(run, features), "gold", "metrics")
    to.put(layer_document(metrics, gold_texts(run)), "gold", "metrics_json", "json")
    for name, model in run.models.items():
        model.write().overwrite().save(to.path("gold", "model_" + "".join(ch if ch.isalnum() else "_" for ch in name.lower())))
    run.release()
    to.switch()
    names = {"bronze/" + table: "bronze", "silver/" + table: "silver", f"bronze/{table}_stats": "bronze_stats", f"silver/{table}_stats": "silver_stats"}
    return {names.get(k, k.split("/", 1)[1]): entry["path"] for k, entry in to.tables.items()}
