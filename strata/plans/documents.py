"""Statistics documents: a layer's KPI rows nested into one typed row.

``numbers`` and ``texts`` are maps of maps, section → key → value, so a
document of any table has the same schema, is written as one JSON object, and
reads back with its types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.evaluate import mark_best, metrics_long

SCHEMA = "layer string, numbers map<string, map<string, double>>, texts map<string, map<string, string>>, run_at timestamp"
_TEXT = "layer string, section string, key string, text string"


def _nested(rows: DataFrame, value: str, name: str) -> DataFrame:
    """One row per layer with the map of its sections; nulls are kept as values."""
    inner = rows.groupBy("layer", "section").agg(F.map_from_entries(F.collect_list(F.struct("key", value))).alias("m"))
    return inner.groupBy("layer").agg(F.map_from_entries(F.collect_list(F.struct("section", "m"))).alias(name))


def layer_document(kpis: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """One row per layer from (layer, section, key, value) and, for names and other words, (layer, section, key, text) rows.

    The frames hold a few rows per column, class or model, so a document is
    small however large the layer is."""
    spark = kpis.sparkSession
    words = texts if texts is not None else spark.createDataFrame([], _TEXT)
    both = _nested(kpis, "value", "numbers").join(_nested(words, "text", "texts"), "layer", "full")
    nothing = F.from_json(F.lit("{}"), "map<string, map<string, string>>")
    return both.select("layer", "numbers", F.coalesce("texts", nothing).alias("texts"), F.current_timestamp().alias("run_at"))


def document_rows(documents: DataFrame) -> DataFrame:
    """(layer, section, key, value, text) of documents, as they were nested."""

    def flat(column: str, value: str, number: bool):
        rows = documents.select("layer", F.explode(column).alias("section", "m")).select("layer", "section", F.explode("m").alias("key", value))
        return rows.select("layer", "section", "key", (F.col(value) if number else F.lit(None).cast("double")).alias("value"), (F.lit(None).cast("string") if number else F.col(value)).alias("text"))

    return flat("numbers", "value", True).unionByName(flat("texts", "text", False))


def comparison_kpis(metrics: DataFrame, layer: str = "gold", metric: str = "accuracy") -> tuple[DataFrame, DataFrame]:
    """(numbers, texts) of a (model, metric...) frame: every model's metrics, the best one's again, and its name."""
    marked = mark_best(metrics, metric, "model")
    each = metrics_long(marked.drop("is_best", "n"), ["model"]).join(marked.select("model", "is_best"), "model")
    all_ = each.select(F.lit(layer).alias("layer"), F.concat(F.lit("model_comparison."), F.col("model")).alias("section"), F.col("metric").alias("key"), "value")
    best = each.where("is_best").select(F.lit(layer), F.lit("metrics"), "metric", "value")
    name = marked.where("is_best").select(F.lit(layer).alias("layer"), F.lit("best_model").alias("section"), F.lit("name").alias("key"), F.col("model").alias("text"))
    return all_.union(best), name


__all__ = ["SCHEMA", "comparison_kpis", "document_rows", "layer_document"]
