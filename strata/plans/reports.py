"""Layer reports and chart data as long key/value frames.

A report is a union of a few aggregated frames, each one pass over its input;
nothing is assembled on the driver except schema metadata.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import as_double, is_missing, pct, rnd
from strata.operators.clean import dedup, duplicate_count, fit_means, impute
from strata.operators.evaluate import mark_best, metrics_long

_KPI = "layer string, section string, key string, value double"


def _kpi(df: DataFrame, layer: str, section: str, pairs: Sequence[tuple[str, object]]) -> DataFrame:
    """One-row aggregate → (layer, section, key, value) rows."""
    return _kpis(df, layer, [(section, k, c) for k, c in pairs])


def _kpis(df: DataFrame, layer: str, triples: Sequence[tuple[str, str, object]]) -> DataFrame:
    """One-row aggregate → every (section, key, column) as a row, in a single ``inline``."""
    return df.select(F.inline(F.array(*_cells(layer, triples))))


def _cells(layer: str, triples: Sequence[tuple[str, str, object]]) -> list[Column]:
    return [
        F.struct(
            F.lit(layer).alias("layer"),
            F.lit(sec).alias("section"),
            F.lit(k).alias("key"),
            (F.col(c) if isinstance(c, str) else c).cast("double").alias("value"),
        )
        for sec, k, c in triples
    ]


def _class_key(label: str) -> Column:
    return F.coalesce(F.col(label).cast("string"), F.lit("null"))


def bronze_report(df: DataFrame, label: str, classes: Sequence[int] | None = None, layer: str = "bronze") -> DataFrame:
    """Rows, columns, missing count and % per column, label counts, duplicate rows.

    Labels of all classes found are counted (a null one as ``null``), or those
    of ``classes``, with zeros.  Three passes: one aggregation for counts, one
    over the label alone, one row-grouping for duplicates.
    """
    names = df.columns
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(names)]
    aggs += [F.count_if(F.col(label) == F.lit(k)).alias(f"_l{j}") for j, k in enumerate(classes or ())]
    one = df.agg(*aggs).withColumn("_cols", F.lit(len(names)))
    for i, _ in enumerate(names):
        one = one.withColumn(f"_p{i}", pct(F.col(f"_m{i}"), F.col("_n")))
    main = (
        [("table", "total_rows", "_n"), ("table", "total_columns", "_cols")]
        + [("missing_values", c, f"_m{i}") for i, c in enumerate(names)]
        + [("missing_pct", c, f"_p{i}") for i, c in enumerate(names)]
        + [("label_distribution", str(k), f"_l{j}") for j, k in enumerate(classes or ())]
    )
    parts = [
        _kpis(one, layer, main),
        _kpi(duplicate_count(df), layer, "table", [("duplicates", "n_duplicates")]),
        # schema metadata: no job over the data
        df.sparkSession.createDataFrame(
            [(layer, "schema", f"{f.name}:{f.dataType.simpleString()}", float(i)) for i, f in enumerate(df.schema.fields)], _KPI
        ),
    ]
    if classes is None:
        counts = df.groupBy(_class_key(label).alias("key")).agg(F.count(F.lit(1)).cast("double").alias("value"))
        parts.append(counts.select(F.lit(layer).alias("layer"), F.lit("label_distribution").alias("section"), "key", "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def silver_tables(
    raw: DataFrame, impute_cols: Sequence[str], content_cols: Sequence[str] | None = None, keys: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, float | None]]:
    """(clean, means): mean-imputed then de-duplicated; means from one job.

    Duplicates are whole rows, or rows equal on ``content_cols`` (keeping the
    smallest ``keys``) when the table carries row keys.
    """
    means = fit_means(raw, impute_cols)
    filled = impute(raw, impute_cols, means=means)
    return (dedup(filled, content_cols, keep_min=keys) if content_cols else dedup(filled)), means


def silver_report(
    raw: DataFrame,
    label: str,
    impute_cols: Sequence[str],
    feature_cols: Sequence[str],
    classes: Sequence[int] | None = None,
    digits: int = 4,
    layer: str = "silver",
) -> DataFrame:
    """Rows, duplicates removed, imputation means, missing after, label counts, feature stats.

    Labels of all classes found are counted, or those of ``classes``, with zeros."""
    means_row = raw.select(*[as_double(raw, c) for c in impute_cols]).agg(
        F.count(F.lit(1)).alias("_before"), *[F.avg(c).alias(c) for c in impute_cols]
    ).first()
    before = int(means_row["_before"])
    means = {c: means_row[c] for c in impute_cols}
    clean = dedup(impute(raw, impute_cols, means=means))
    names = clean.columns
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(is_missing(clean, c)).alias(f"_m{i}") for i, c in enumerate(names)]
    aggs += [F.count_if(F.col(label) == F.lit(k)).alias(f"_l{j}") for j, k in enumerate(classes or ())]
    for i, _ in enumerate(feature_cols):
        x = F.col(f"_f{i}")
        aggs += [
            rnd(F.avg(x), digits).alias(f"_a{i}"),
            rnd(F.stddev_samp(x), digits).alias(f"_s{i}"),
            rnd(F.min(x), digits).alias(f"_lo{i}"),
            rnd(F.max(x), digits).alias(f"_hi{i}"),
        ]
    with_feats = clean.select("*", *[as_double(clean, c).alias(f"_f{i}") for i, c in enumerate(feature_cols)])
    # one pass over the clean table; the total's row and one row per class hold everything below
    with_class = with_feats.withColumn("_class", _class_key(label))
    one = (with_class.rollup("_class") if classes is None else with_class.groupBy()).agg(*aggs, *([F.grouping_id().alias("_total")] if classes is None else []))
    triples = [
        ("table", "total_rows", "_n"),
        ("table", "rows_before", F.lit(before)),
        ("table", "duplicates_removed", F.lit(before) - F.col("_n")),
    ]
    triples += [("imputation_applied", c, rnd(F.lit(m).cast("double"), digits)) for c, m in means.items()]
    triples += [("missing_after", c, f"_m{i}") for i, c in enumerate(names)]
    triples += [("label_distribution", str(k), f"_l{j}") for j, k in enumerate(classes or ())]
    for i, c in enumerate(feature_cols):
        triples += [(f"feature_stats.{c}", k, f"_{p}{i}") for k, p in (("mean", "a"), ("std", "s"), ("min", "lo"), ("max", "hi"))]
    if classes is not None:
        return _kpis(one, layer, triples)
    own_class = F.array(F.struct(F.lit(layer).alias("layer"), F.lit("label_distribution").alias("section"), F.col("_class").alias("key"), F.col("_n").cast("double").alias("value")))
    return one.select(F.inline(F.when(F.col("_total") == 1, F.array(*_cells(layer, triples))).otherwise(own_class)))


def layer_counts(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """(layer, n_rows) for bronze and silver, computed (never constants)."""
    b = raw.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("layer", F.lit("bronze"))
    s = clean.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("layer", F.lit("silver"))
    return b.unionByName(s).select("layer", "n_rows")


def comparison_long(metrics: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """(model, metric, value): the melt behind radar and grouped-bar charts."""
    return metrics_long(metrics, list(by))


def comparison_marked(metrics: DataFrame, metric: str = "accuracy", name: str = "model") -> DataFrame:
    return mark_best(metrics, metric, name)


def chart_series(long_values: DataFrame, value: str = "value", digits: int = 2) -> DataFrame:
    """Values as percentages rounded for charts (importance × 100, metric × 100)."""
    return long_values.withColumn(f"{value}_pct", rnd(F.col(value) * 100.0, digits))


def stats_document(bronze: DataFrame) -> DataFrame:
    """Nest a bronze KPI frame into one row: scalars + maps per section, ready for ``to_json``."""
    table = bronze.filter(F.col("section") == "table")
    sections = bronze.filter(F.col("section") != "table").groupBy("layer", "section").agg(
        F.map_from_entries(F.collect_list(F.struct("key", F.col("value").cast("bigint")))).alias("m")
    )
    # the grouped frames hold (sections x columns) rows: tiny
    scalars = table.groupBy("layer").agg(
        F.max(F.when(F.col("key") == "total_rows", F.col("value"))).cast("bigint").alias("total_rows"),
        F.max(F.when(F.col("key") == "total_columns", F.col("value"))).cast("bigint").alias("total_columns"),
        F.max(F.when(F.col("key") == "duplicates", F.col("value"))).cast("bigint").alias("duplicates"),
    )
    maps = sections.groupBy("layer").agg(
        F.first(F.when(F.col("section") == "missing_values", F.col("m")), ignorenulls=True).alias("missing_values"),
        F.first(F.when(F.col("section") == "label_distribution", F.col("m")), ignorenulls=True).alias("label_distribution"),
    )
    return scalars.join(maps, "layer", "left").withColumn("run_at", F.current_timestamp())
