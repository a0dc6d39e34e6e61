"""The query catalog: every operator of the inventory as a (spark, sf_dir) → DataFrame callable.

Inputs are the given tables (``lineitem`` through the ``readings`` view, the
rule-model table, ``events``, ``documents`` ⋈ ``labels``, ``embeddings``,
``part``), so the work of each query grows with the data.  ``ORACLE`` holds
the DuckDB text of every query that SQL can express; model-based and
streaming queries have none and are checked by row count and by the tests.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import pct, rnd
from strata.operators import clean as C
from strata.operators import evaluate as E
from strata.operators import features as FE
from strata.operators import profile as P
from strata.operators import stats as S
from strata.plans import reports as R
from strata.plans.readings import FEATURES, KEYS, LABEL, LABEL_NAMES, READINGS_SQL, readings, table
from strata.plans.rules import RULES_SQL, rule_predictions
from strata.session import checkpoint_dir
from strata.sources import io as IO
from strata.sources import layers as LY

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

IMPUTED = ["qty", "price", "tax"]
ALL_R = [*KEYS, *FEATURES, LABEL]
SAMPLE_COLS = ["qty", "price", "tax", "disc", "y"]
DUP_COLS = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _u(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/strata-tables/{name}-{uuid.uuid4().hex}"


W = f"WITH r AS ({READINGS_SQL})"
RULES = f"WITH p AS ({RULES_SQL})"
IMP_CTE = (
    f"{W}, m AS (SELECT AVG(qty) AS mq, AVG(price) AS mp, AVG(tax) AS mt FROM r),\n"
    "i AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, COALESCE(qty, mq) AS qty, "
    "COALESCE(price, mp) AS price, COALESCE(tax, mt) AS tax, disc, y FROM r, m)"
)


def _imputed(spark, sf):
    r = readings(spark, sf)
    return C.impute(r, IMPUTED)


def _published(sql: str) -> str:
    """Oracle form of ``rnd``: every ``round(x, d) + 0.0`` is rounded in two stages like Spark.

    Spark rounds the shortest decimal text of a double half-up; DuckDB rounds
    ``x * 10^d`` in binary.  Stage one takes float noise off at d + 6 places, a DECIMAL cast
    makes stage two an exact decimal half-up rounding in DuckDB as well.
    """
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + 5
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = sql[j + 6 : k]
        head, _, digits = inner.rpartition(",")
        if sql.startswith(" + 0.0", k + 1) and digits.strip().isdigit():
            d = int(digits)
            out.append(sql[i:j] + f"CAST(round(CAST(round({_published(head)}, {d + 6}) AS DECIMAL(38, {d + 6})), {d}) AS DOUBLE)")
        else:
            out.append(sql[i : j + 6] + _published(inner) + ")")
        i = k + 1


# ---------------------------------------------------------------- profile
@query(
    "missing_profile",
    f"{W}, a AS (SELECT COUNT(*) AS n, "
    + ", ".join(f"COUNT(*) - COUNT({c}) AS m{i}" for i, c in enumerate(ALL_R))
    + " FROM r)\n"
    + _u(
        f"SELECT {i} AS position, '{c}' AS \"column\", n AS n_rows, m{i} AS n_missing, "
        f"round(100.0 * (m{i}::DOUBLE / n), 2) + 0.0 AS missing_pct, m{i} > 0 AS needs_imputation FROM a"
        for i, c in enumerate(ALL_R)
    ),
)
def q_missing_profile(spark, sf):
    return P.missing_profile(readings(spark, sf))


@query("row_count", "SELECT COUNT(*) AS n_rows FROM lineitem")
def q_row_count(spark, sf):
    return P.row_count(readings(spark, sf))


@query(
    "missing_total_after_impute",
    f"{IMP_CTE}\nSELECT CAST("
    + " + ".join(f"(COUNT(*) - COUNT({c}))" for c in ALL_R)
    + " AS BIGINT) AS total_missing, "
    + " + ".join(f"(COUNT(*) - COUNT({c}))" for c in ALL_R)
    + " = 0 AS complete FROM i",
)
def q_missing_total_after_impute(spark, sf):
    return P.missing_total(_imputed(spark, sf))


@query(
    "missing_rows_filter",
    f"{W} SELECT * FROM r WHERE qty IS NULL OR price IS NULL OR tax IS NULL OR disc IS NULL",
)
def q_missing_rows_filter(spark, sf):
    return P.missing_rows(readings(spark, sf), FEATURES)


@query(
    "label_distribution",
    f"{W} SELECT y, CASE y WHEN 0 THEN 'low' WHEN 1 THEN 'high' END AS label_name, COUNT(*) AS \"count\", "
    "round(100.0 * (COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER ()), 2) + 0.0 AS pct FROM r GROUP BY y ORDER BY y",
)
def q_label_distribution(spark, sf):
    return P.label_distribution(readings(spark, sf), LABEL, LABEL_NAMES)


@query(
    "label_counts_wide",
    f"{W} SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE y = 0) AS n_0, COUNT(*) FILTER (WHERE y = 1) AS n_1 FROM r",
)
def q_label_counts_wide(spark, sf):
    return P.label_counts_wide(readings(spark, sf), LABEL, (0, 1))


@query(
    "class_filter",
    f"{W} SELECT * FROM r WHERE y = 1",
)
def q_class_filter(spark, sf):
    return P.class_filter(readings(spark, sf), LABEL, 1)


@query(
    "label_decode",
    f"{W} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, y, "
    "CASE y WHEN 0 THEN 'low' WHEN 1 THEN 'high' END AS label_name FROM r",
)
def q_label_decode(spark, sf):
    r = readings(spark, sf)
    return r.select(*KEYS, LABEL, P.decode_label(F.col(LABEL), LABEL_NAMES).alias("label_name"))


def _describe_sql(cte: str, src: str, cols, digits: int) -> str:
    return f"{cte}\n" + _u(
        f"SELECT {i} AS position, '{c}' AS \"column\", COUNT({c}) AS \"count\", "
        f"round(AVG({c}::DOUBLE), {digits}) + 0.0 AS mean, round(STDDEV_SAMP({c}::DOUBLE), {digits}) + 0.0 AS stddev, "
        f"round(MIN({c}::DOUBLE), {digits}) + 0.0 AS min, round(MAX({c}::DOUBLE), {digits}) + 0.0 AS max FROM {src}"
        for i, c in enumerate(cols)
    )


@query("describe_long", _describe_sql(W, "r", SAMPLE_COLS, 6))
def q_describe_long(spark, sf):
    return P.describe_long(readings(spark, sf), SAMPLE_COLS)


@query(
    "feature_stats",
    f"{IMP_CTE}\n"
    + _u(
        f"SELECT {i} AS position, '{c}' AS \"column\", round(AVG({c}), 4) + 0.0 AS mean, round(STDDEV_SAMP({c}), 4) + 0.0 AS std, "
        f"round(MIN({c}), 4) + 0.0 AS min, round(MAX({c}), 4) + 0.0 AS max FROM i"
        for i, c in enumerate(FEATURES)
    ),
)
def q_feature_stats(spark, sf):
    return P.feature_stats(_imputed(spark, sf), label=LABEL, cols=FEATURES)


@query(
    "column_means",
    f"{W}\n"
    + _u(
        f"SELECT {i} AS position, '{c}' AS \"column\", round(AVG({c}), 8) + 0.0 AS mean, round(AVG({c}), 4) + 0.0 AS mean_reported FROM r"
        for i, c in enumerate(IMPUTED)
    ),
)
def q_column_means(spark, sf):
    m = P.column_means(readings(spark, sf), IMPUTED)
    return m.select("position", "column", rnd(F.col("mean"), 8).alias("mean"), "mean_reported")


@query(
    "preview_topn",
    f"{W} SELECT * FROM r ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20",
)
def q_preview_topn(spark, sf):
    return P.preview(readings(spark, sf), 20, KEYS)


@query(
    "project_features",
    f"{W} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, qty, price, tax, disc, y FROM r",
)
def q_project_features(spark, sf):
    return readings(spark, sf).select(*KEYS, *FEATURES, LABEL)


@query(
    "dropna_per_feature",
    f"{W}\n" + _u(f"SELECT y, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM r WHERE {c} IS NOT NULL" for c in FEATURES),
)
def q_dropna_per_feature(spark, sf):
    return P.feature_long(readings(spark, sf), FEATURES, [LABEL])


@query(
    "cast_numeric",
    "WITH t AS (SELECT props, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)\n"
    "SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE props IS NULL) AS n_null_input, "
    "COUNT(*) FILTER (WHERE props IS NOT NULL AND k IS NULL) AS n_failed, round(AVG(k), 6) + 0.0 AS mean_value FROM t",
)
def q_cast_numeric(spark, sf):
    ev = table(spark, sf, "events")
    t = ev.select("props", F.get_json_object("props", "$.k").try_cast("double").alias("k"))
    return t.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("props").isNull()).alias("n_null_input"),
        F.count_if(F.col("props").isNotNull() & F.col("k").isNull()).alias("n_failed"),
        rnd(F.avg("k"), 6).alias("mean_value"),
    )


# ---------------------------------------------------------------- cleaning
@query(
    "impute_mean",
    f"{IMP_CTE} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(qty, 4) + 0.0 AS qty, "
    "round(price, 4) + 0.0 AS price, round(tax, 4) + 0.0 AS tax, disc, y FROM i",
)
def q_impute_mean(spark, sf):
    i = _imputed(spark, sf)
    return i.select(*KEYS, *[rnd(F.col(c), 4).alias(c) for c in IMPUTED], "disc", LABEL)


@query(
    "duplicate_count",
    f"SELECT COUNT(*) AS n_rows, (SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(DUP_COLS)} FROM lineitem)) AS n_distinct, "
    f"COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(DUP_COLS)} FROM lineitem)) AS n_duplicates FROM lineitem",
)
def q_duplicate_count(spark, sf):
    return C.duplicate_count(table(spark, sf, "lineitem").select(*DUP_COLS))


@query("dedup_rows", f"SELECT DISTINCT {', '.join(DUP_COLS)} FROM lineitem")
def q_dedup_rows(spark, sf):
    return C.dedup(table(spark, sf, "lineitem").select(*DUP_COLS))


_SAMPLES_IMP = (
    f"{W}, m AS (SELECT AVG(qty) AS mq, AVG(price) AS mp, AVG(tax) AS mt FROM r),\n"
    "s AS (SELECT COALESCE(qty, mq) AS qty, COALESCE(tax, mt) AS tax, disc, y FROM r, m)"
)


@query(
    "duplicates_removed",
    f"{_SAMPLES_IMP} SELECT COUNT(*) AS n_before, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM s)) AS n_after, "
    "COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM s)) AS duplicates_removed FROM s",
)
def q_duplicates_removed(spark, sf):
    s = C.impute(readings(spark, sf).select("qty", "tax", "disc", LABEL), ["qty", "tax"])
    d = C.duplicate_count(s)
    return d.select(
        F.col("n_rows").alias("n_before"), F.col("n_distinct").alias("n_after"), F.col("n_duplicates").alias("duplicates_removed")
    )


# ---------------------------------------------------------------- statistics
def _corr_sql(cte: str, src: str, cols) -> str:
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            parts.append(
                f"SELECT {i} AS i, {j} AS j, '{a}' AS col_a, '{b}' AS col_b, round(corr({a}::DOUBLE, {b}::DOUBLE), 6) + 0.0 AS corr FROM {src}"
            )
    return f"{cte}\n" + _u(parts)


@query("correlation_matrix", _corr_sql("WITH t AS (SELECT * FROM lineitem)", "t", LI_NUM))
def q_correlation_matrix(spark, sf):
    return S.correlation_long(table(spark, sf, "lineitem"), LI_NUM)


@query("correlation_pairwise_nulls", _corr_sql(W, "r", SAMPLE_COLS))
def q_correlation_pairwise_nulls(spark, sf):
    return S.correlation_long(readings(spark, sf), SAMPLE_COLS)


@query(
    "correlation_lower",
    f"SELECT * FROM ({_corr_sql(W, 'r', SAMPLE_COLS)}) WHERE i > j",
)
def q_correlation_lower(spark, sf):
    return S.correlation_lower(S.correlation_long(readings(spark, sf), SAMPLE_COLS))


@query(
    "correlation_wide",
    "SELECT CAST(a.i AS INTEGER) AS i, CAST(b.j AS INTEGER) AS j, 'embedding[' || a.i || ']' AS col_a, 'embedding[' || b.j || ']' AS col_b, "
    "round(corr(e.embedding[a.i + 1]::DOUBLE, e.embedding[b.j + 1]::DOUBLE), 6) + 0.0 AS corr "
    "FROM embeddings e CROSS JOIN range(0, 64) AS a(i) CROSS JOIN range(0, 64) AS b(j) GROUP BY a.i, b.j",
)
def q_correlation_wide(spark, sf):
    return S.correlation_vector(table(spark, sf, "embeddings"), "embedding")


_HOLED = "CASE WHEN (e.vec_id * 7 + {k}) % 11 = 0 THEN NULL ELSE e.embedding[{k} + 1]::DOUBLE END"


@query(
    "correlation_wide_nulls",
    "SELECT CAST(a.i AS INTEGER) AS i, CAST(b.j AS INTEGER) AS j, 'embedding[' || a.i || ']' AS col_a, 'embedding[' || b.j || ']' AS col_b, "
    f"round(corr({_HOLED.format(k='a.i')}, {_HOLED.format(k='b.j')}), 6) + 0.0 AS corr "
    "FROM embeddings e CROSS JOIN range(0, 64) AS a(i) CROSS JOIN range(0, 64) AS b(j) GROUP BY a.i, b.j",
)
def q_correlation_wide_nulls(spark, sf):
    """The same over vectors with one component in eleven missing."""
    holed = F.transform("embedding", lambda x, k: F.when((F.col("vec_id") * 7 + k) % 11 != 0, x))
    return S.correlation_vector(table(spark, sf, "embeddings").withColumn("embedding", holed), "embedding")


LONG_CTE = f"{W}, lg AS (" + _u(
    f"SELECT '{c}' AS feature, y, CAST({c} AS DOUBLE) AS value FROM r WHERE {c} IS NOT NULL" for c in FEATURES
) + ")"

_HIST_SQL = (
    f"{LONG_CTE},\n"
    "b0 AS (SELECT feature, y, MIN(value) AS mn, MAX(value) AS mx, COUNT(*) AS n FROM lg GROUP BY feature, y),\n"
    "b AS (SELECT feature, y, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, "
    "CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi, n FROM b0),\n"
    "bw AS (SELECT feature, y, lo, n, (hi - lo) / 40.0 AS w FROM b),\n"
    "c AS (SELECT lg.feature, lg.y, LEAST(CAST(FLOOR((lg.value - bw.lo) / bw.w) AS INTEGER), 39) AS bin, COUNT(*) AS cnt "
    "FROM lg JOIN bw ON lg.feature = bw.feature AND lg.y = bw.y GROUP BY 1, 2, 3),\n"
    "g AS (SELECT bw.*, CAST(t.bin AS INTEGER) AS bin FROM bw CROSS JOIN range(0, 40) AS t(bin))\n"
    "SELECT g.feature, g.y, g.bin, round(g.lo + g.bin * g.w, 8) + 0.0 AS lo, round(g.lo + (g.bin + 1) * g.w, 8) + 0.0 AS hi, "
    "CAST(COALESCE(c.cnt, 0) AS BIGINT) AS \"count\", round(COALESCE(c.cnt, 0) / (g.n * g.w), 8) + 0.0 AS density "
    "FROM g LEFT JOIN c ON g.feature = c.feature AND g.y = c.y AND g.bin = c.bin"
)


@query("histogram_density", _HIST_SQL)
def q_histogram_density(spark, sf):
    return S.histogram(readings(spark, sf), FEATURES, [LABEL], bins=40)


_BOX_CTE = (
    f"{LONG_CTE},\n"
    "q AS (SELECT feature, y, COUNT(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
    "quantile_cont(value, 0.75) AS q3 FROM lg GROUP BY feature, y),\n"
    "f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q)"
)


@query(
    "box_stats",
    f"{_BOX_CTE},\n"
    "t AS (SELECT lg.feature, lg.y, MIN(CASE WHEN value >= lo_fence AND value <= hi_fence THEN value END) AS whisker_lo, "
    "MAX(CASE WHEN value >= lo_fence AND value <= hi_fence THEN value END) AS whisker_hi, "
    "COUNT(*) FILTER (WHERE value < lo_fence) AS n_low, COUNT(*) FILTER (WHERE value > hi_fence) AS n_high "
    "FROM lg JOIN f ON lg.feature = f.feature AND lg.y = f.y GROUP BY 1, 2)\n"
    "SELECT f.feature, f.y, f.n, round(q1, 6) + 0.0 AS q1, round(median, 6) + 0.0 AS median, round(q3, 6) + 0.0 AS q3, "
    "round(iqr, 6) + 0.0 AS iqr, round(lo_fence, 6) + 0.0 AS lo_fence, round(hi_fence, 6) + 0.0 AS hi_fence, "
    "round(whisker_lo, 6) + 0.0 AS whisker_lo, round(whisker_hi, 6) + 0.0 AS whisker_hi, n_low, n_high, n_low + n_high AS n_outliers "
    "FROM f JOIN t ON f.feature = t.feature AND f.y = t.y",
)
def q_box_stats(spark, sf):
    return S.box_stats(readings(spark, sf), FEATURES, [LABEL])


@query(
    "box_outliers",
    f"{_BOX_CTE}\nSELECT lg.y, lg.feature, lg.value FROM lg JOIN f ON lg.feature = f.feature AND lg.y = f.y "
    "WHERE lg.value < f.lo_fence OR lg.value > f.hi_fence",
)
def q_box_outliers(spark, sf):
    return S.outlier_rows(readings(spark, sf), FEATURES, [LABEL]).select(LABEL, "feature", "value")


def _narrow(sql: str) -> str:
    """The same with fences a quarter of the box away, which leaves rows on either side of them."""
    return sql.replace("- 1.5 * (q3", "- 0.25 * (q3").replace("+ 1.5 * (q3", "+ 0.25 * (q3")


@query("box_stats_narrow", _narrow(ORACLE["box_stats"]))
def q_box_stats_narrow(spark, sf):
    return S.box_stats(readings(spark, sf), FEATURES, [LABEL], whisker=0.25)


@query("box_outliers_narrow", _narrow(ORACLE["box_outliers"]))
def q_box_outliers_narrow(spark, sf):
    return S.outlier_rows(readings(spark, sf), FEATURES, [LABEL], whisker=0.25).select(LABEL, "feature", "value")


_EV_BOX_CTE = (
    "WITH lg AS (SELECT 'value' AS feature, event_type, CAST(value AS DOUBLE) AS value FROM events WHERE value IS NOT NULL),\n"
    "q AS (SELECT feature, event_type, COUNT(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
    "quantile_cont(value, 0.75) AS q3 FROM lg GROUP BY feature, event_type),\n"
    "f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q)"
)


@query(
    "box_stats_events",
    f"{_EV_BOX_CTE},\n"
    "t AS (SELECT lg.feature, lg.event_type, MIN(CASE WHEN value >= lo_fence AND value <= hi_fence THEN value END) AS whisker_lo, "
    "MAX(CASE WHEN value >= lo_fence AND value <= hi_fence THEN value END) AS whisker_hi, "
    "COUNT(*) FILTER (WHERE value < lo_fence) AS n_low, COUNT(*) FILTER (WHERE value > hi_fence) AS n_high "
    "FROM lg JOIN f ON lg.feature = f.feature AND lg.event_type = f.event_type GROUP BY 1, 2)\n"
    "SELECT f.feature, f.event_type, f.n, round(q1, 6) + 0.0 AS q1, round(median, 6) + 0.0 AS median, round(q3, 6) + 0.0 AS q3, "
    "round(iqr, 6) + 0.0 AS iqr, round(lo_fence, 6) + 0.0 AS lo_fence, round(hi_fence, 6) + 0.0 AS hi_fence, "
    "round(whisker_lo, 6) + 0.0 AS whisker_lo, round(whisker_hi, 6) + 0.0 AS whisker_hi, n_low, n_high, n_low + n_high AS n_outliers "
    "FROM f JOIN t ON f.feature = t.feature AND f.event_type = t.event_type",
)
def q_box_stats_events(spark, sf):
    return S.box_stats(table(spark, sf, "events"), ["value"], ["event_type"])


@query(
    "box_outliers_events",
    f"{_EV_BOX_CTE}\nSELECT lg.event_type, lg.feature, lg.value FROM lg JOIN f ON lg.feature = f.feature AND lg.event_type = f.event_type "
    "WHERE lg.value < f.lo_fence OR lg.value > f.hi_fence",
)
def q_box_outliers_events(spark, sf):
    return S.outlier_rows(table(spark, sf, "events"), ["value"], ["event_type"]).select("event_type", "feature", "value")


# ---------------------------------------------------------------- features and split
_SPLIT_SQL = (
    "CASE WHEN CAST(('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 8)) AS BIGINT) % 100 < 80 "
    "THEN 'train' ELSE 'test' END"
)


@query("hash_split", f"{W} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_SPLIT_SQL} AS split FROM r")
def q_hash_split(spark, sf):
    return FE.hash_split(readings(spark, sf), KEYS).select(*KEYS, "split")


@query(
    "split_report",
    f"{W}, s AS (SELECT {_SPLIT_SQL} AS split FROM r)\n"
    "SELECT split, COUNT(*) AS n, round(100.0 * (COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER ()), 2) + 0.0 AS pct FROM s GROUP BY split",
)
def q_split_report(spark, sf):
    from pyspark.sql import Window

    s = FE.hash_split(readings(spark, sf), KEYS).groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return s.withColumn("pct", pct(F.col("n"), F.sum("n").over(Window.partitionBy())))


@query(
    "split_label_distribution",
    f"{W}, s AS (SELECT {_SPLIT_SQL} AS split, y FROM r) SELECT split, y, COUNT(*) AS n FROM s GROUP BY split, y",
)
def q_split_label_distribution(spark, sf):
    return FE.hash_split(readings(spark, sf), KEYS).groupBy("split", LABEL).agg(F.count(F.lit(1)).alias("n"))


@query(
    "assemble_features",
    f"{IMP_CTE} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(qty, 6) + 0.0 AS f0, round(price, 6) + 0.0 AS f1, "
    "round(tax, 6) + 0.0 AS f2, round(disc, 6) + 0.0 AS f3 FROM i",
)
def q_assemble_features(spark, sf):
    from pyspark.ml.functions import vector_to_array

    a = FE.assemble(_imputed(spark, sf), FEATURES, "features_raw")
    arr = vector_to_array("features_raw")
    return a.select(*KEYS, *[rnd(arr[k], 6).alias(f"f{k}") for k in range(len(FEATURES))])


def _scale_sql(where: str) -> str:
    stats = ", ".join(f"AVG({c}::DOUBLE) AS m_{c}, STDDEV_SAMP({c}::DOUBLE) AS s_{c}" for c in FEATURES)
    cols = ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) + 0.0 AS {c}" for c in FEATURES)
    return (
        f"{W}, st AS (SELECT {stats} FROM r {where})\n"
        f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {cols}, y FROM r, st"
    )


@query("standard_scale", _scale_sql(""))
def q_standard_scale(spark, sf):
    return FE.standard_scale(readings(spark, sf), FEATURES, digits=6)


@query("scale_fit_on_train", _scale_sql(f"WHERE {_SPLIT_SQL} = 'train'"))
def q_scale_fit_on_train(spark, sf):
    r = readings(spark, sf)
    train, _ = FE.split_frames(r, KEYS)
    return FE.standard_scale(r, FEATURES, fit_on=train, digits=6)


# ---------------------------------------------------------------- evaluation (rule models)
_CONF = f"{RULES}, conf AS (SELECT model, y AS label, prediction, COUNT(*) AS c FROM p GROUP BY 1, 2, 3)"
_PC = (
    f"{_CONF},\n"
    "lab AS (SELECT model, label AS class, SUM(c) AS support, SUM(CASE WHEN label = prediction THEN c ELSE 0 END) AS tp FROM conf GROUP BY 1, 2),\n"
    "prd AS (SELECT model, prediction AS class, SUM(c) AS n_predicted FROM conf GROUP BY 1, 2),\n"
    "pc0 AS (SELECT lab.model, lab.class, lab.support, lab.tp, COALESCE(prd.n_predicted, 0) AS n_predicted FROM lab "
    "LEFT JOIN prd ON lab.model = prd.model AND lab.class = prd.class),\n"
    "pc1 AS (SELECT *, CASE WHEN n_predicted = 0 THEN 0.0 ELSE tp::DOUBLE / n_predicted END AS precision, "
    "tp::DOUBLE / support AS recall FROM pc0),\n"
    "pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pc1)"
)
_METRICS = (
    f"{_PC},\nmet AS (SELECT model, round(SUM(tp)::DOUBLE / SUM(support), 6) + 0.0 AS accuracy, "
    "round(SUM(f1 * support) / SUM(support), 6) + 0.0 AS f1, "
    "round(SUM(precision * support) / SUM(support), 6) + 0.0 AS weighted_precision, "
    "round(SUM(recall * support) / SUM(support), 6) + 0.0 AS weighted_recall, CAST(SUM(support) AS BIGINT) AS n FROM pc GROUP BY model)"
)
_AUC = (
    f"{RULES}, g AS (SELECT model, score, COUNT(*) FILTER (WHERE y = 1) AS pos, COUNT(*) FILTER (WHERE y <> 1) AS neg FROM p GROUP BY 1, 2),\n"
    "cu AS (SELECT *, SUM(neg) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM g)\n"
    "SELECT model, round(SUM(pos * ((cum_neg - neg) + neg / 2.0)) / (SUM(pos)::DOUBLE * SUM(neg)::DOUBLE), 6) + 0.0 AS auc, "
    "CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg FROM cu GROUP BY model"
)


def _rules_metrics(spark, sf):
    return E.classification_metrics(rule_predictions(spark, sf), "y", "prediction", ["model"])


@query("confusion_matrix", f"{_CONF} SELECT model, label, prediction, c AS \"count\" FROM conf")
def q_confusion_matrix(spark, sf):
    return E.confusion_long(rule_predictions(spark, sf), "y", "prediction", ["model"])


@query(
    "confusion_wide",
    f"{RULES} SELECT model, COUNT(*) FILTER (WHERE y = 0 AND prediction = 0) AS tn, COUNT(*) FILTER (WHERE y = 0 AND prediction = 1) AS fp, "
    "COUNT(*) FILTER (WHERE y = 1 AND prediction = 0) AS fn, COUNT(*) FILTER (WHERE y = 1 AND prediction = 1) AS tp, COUNT(*) AS n, "
    "round((COUNT(*) FILTER (WHERE y = prediction))::DOUBLE / COUNT(*), 4) + 0.0 AS share_correct, "
    "round((COUNT(*) FILTER (WHERE y <> prediction))::DOUBLE / COUNT(*), 4) + 0.0 AS share_wrong FROM p GROUP BY model",
)
def q_confusion_wide(spark, sf):
    return E.confusion_wide(rule_predictions(spark, sf), "y", "prediction", ["model"])


@query("classification_metrics", f"{_METRICS} SELECT * FROM met")
def q_classification_metrics(spark, sf):
    return _rules_metrics(spark, sf)


@query(
    "per_class_metrics",
    f"{_PC} SELECT model, class, CAST(support AS BIGINT) AS support, CAST(tp AS BIGINT) AS tp, CAST(n_predicted AS BIGINT) AS n_predicted, "
    "round(precision, 6) + 0.0 AS precision, round(recall, 6) + 0.0 AS recall, round(f1, 6) + 0.0 AS f1 FROM pc",
)
def q_per_class_metrics(spark, sf):
    pc = E.per_class_metrics(rule_predictions(spark, sf), "y", "prediction", ["model"])
    return pc.select(
        "model", "class", "support", "tp", "n_predicted", *[rnd(F.col(c), 6).alias(c) for c in ["precision", "recall", "f1"]]
    )


@query("auc_roc", _AUC)
def q_auc_roc(spark, sf):
    return E.auc_roc(rule_predictions(spark, sf), "y", "score", ["model"])


_MLONG = (
    f"{_METRICS},\nml AS ("
    + _u(f"SELECT model, '{m}' AS metric, {m} AS value FROM met" for m in E.METRICS)
    + ")"
)


@query("comparison_long", f"{_MLONG} SELECT * FROM ml")
def q_comparison_long(spark, sf):
    return R.comparison_long(_rules_metrics(spark, sf).drop("n"))


@query("chart_series", f"{_MLONG} SELECT model, metric, value, round(value * 100.0, 2) + 0.0 AS value_pct FROM ml")
def q_chart_series(spark, sf):
    return R.chart_series(R.comparison_long(_rules_metrics(spark, sf).drop("n")))


@query(
    "comparison_formatted",
    f"{_MLONG} SELECT model, metric, printf('%.4f (%.2f%%)', round(value, 4) + 0.0, round(value * 100.0, 2) + 0.0) AS text FROM ml",
)
def q_comparison_formatted(spark, sf):
    long = R.comparison_long(_rules_metrics(spark, sf).drop("n"))
    return long.select("model", "metric", E.format_metric(F.col("value")).alias("text"))


@query(
    "comparison_marked",
    f"{_METRICS} SELECT *, ROW_NUMBER() OVER (ORDER BY accuracy DESC NULLS LAST, model) = 1 AS is_best FROM met",
)
def q_comparison_marked(spark, sf):
    return R.comparison_marked(_rules_metrics(spark, sf))


@query("best_model", f"{_METRICS} SELECT * FROM met ORDER BY accuracy DESC NULLS LAST, model LIMIT 1")
def q_best_model(spark, sf):
    return E.best_row(_rules_metrics(spark, sf), "accuracy", "model")


_TARGETS_SQL = "(VALUES " + ", ".join(f"('{k}', {v})" for k, v in sorted(E.DEFAULT_TARGETS.items())) + ") AS tg(metric, target)"


@query(
    "target_check",
    f"{_MLONG} SELECT ml.metric, ml.model, ml.value, CAST(tg.target AS DOUBLE) AS target, ml.value >= tg.target AS target_met, "
    "CASE WHEN ml.value >= tg.target THEN 'met' ELSE printf('>= %.2f', tg.target) END AS status "
    f"FROM ml JOIN {_TARGETS_SQL} ON ml.metric = tg.metric",
)
def q_target_check(spark, sf):
    long = E.metrics_long(_rules_metrics(spark, sf), ["model"])
    return E.target_check(long, E.targets_frame(spark))


_LIT_SQL = "(VALUES " + ", ".join(f"('{k}', {v})" for k, v in sorted(E.LITERATURE_ACCURACY.items())) + ") AS lt(model, value)"


@query(
    "baseline_comparison",
    f"{_METRICS}, b AS (SELECT model, accuracy AS value, 'measured' AS source FROM met "
    f"UNION ALL SELECT model, CAST(value AS DOUBLE), 'literature' FROM {_LIT_SQL})\n"
    "SELECT model, value, source, round(value - MAX(value) OVER (), 6) + 0.0 AS gap_to_best FROM b",
)
def q_baseline_comparison(spark, sf):
    return E.baseline_comparison(_rules_metrics(spark, sf), "accuracy", "model")


@query(
    "predictions_sample",
    f"{RULES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, y AS label, prediction, round(score, 4) + 0.0 AS p1, "
    "round(1.0 - score, 4) + 0.0 AS p0 FROM p WHERE model = 'by_qty' ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 50",
)
def q_predictions_sample(spark, sf):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    p = rule_predictions(spark, sf).filter(F.col("model") == "by_qty")
    # the probability vector as MLlib models emit it: [P(0), P(1)]
    p = p.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - F.col("score"), F.col("score"))))
    prob = vector_to_array("probability")
    out = p.select(
        *KEYS,
        F.col("y").alias("label"),
        "prediction",
        rnd(prob[1], 4).alias("p1"),
        rnd(prob[0], 4).alias("p0"),
    )
    return P.preview(out, 50, KEYS)


@query(
    "importance_rank",
    f"{W}, c AS ("
    + _u(f"SELECT '{c}' AS feature, abs(corr({c}::DOUBLE, y::DOUBLE)) AS a FROM r" for c in FEATURES)
    + "),\nn AS (SELECT feature, a / SUM(a) OVER () AS importance FROM c)\n"
    "SELECT feature, round(importance, 6) + 0.0 AS importance, CAST(ROW_NUMBER() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank FROM n",
)
def q_importance_rank(spark, sf):
    """Rank features by a filter-style importance: |corr(feature, label)| normalised to sum 1."""
    from pyspark.sql import Window

    from strata.operators.models import rank_desc

    corr = S.correlation_long(readings(spark, sf), [*FEATURES, LABEL], digits=None)
    a = corr.filter((F.col("col_b") == LABEL) & (F.col("col_a") != LABEL)).select(
        F.col("col_a").alias("feature"), F.abs("corr").alias("a")
    )
    imp = a.select("feature", (F.col("a") / F.sum("a").over(Window.partitionBy())).alias("importance"))
    ranked = rank_desc(imp, "importance", "feature")
    return ranked.select("feature", rnd(F.col("importance"), 6).alias("importance"), F.col("rank"))


_RULES_SEG = "WITH p AS (" + RULES_SQL.replace("l_partkey, l_suppkey,", "l_partkey, l_suppkey, l_returnflag,") + ")"


@query(
    "segment_metrics",
    f"{_RULES_SEG}, conf AS (SELECT model, l_returnflag, y AS label, prediction, COUNT(*) AS c FROM p GROUP BY 1, 2, 3, 4),\n"
    "lab AS (SELECT model, l_returnflag, label AS class, SUM(c) AS support, SUM(CASE WHEN label = prediction THEN c ELSE 0 END) AS tp FROM conf GROUP BY 1, 2, 3),\n"
    "prd AS (SELECT model, l_returnflag, prediction AS class, SUM(c) AS n_predicted FROM conf GROUP BY 1, 2, 3),\n"
    "pc0 AS (SELECT lab.*, COALESCE(prd.n_predicted, 0) AS n_predicted FROM lab LEFT JOIN prd "
    "ON lab.model = prd.model AND lab.l_returnflag = prd.l_returnflag AND lab.class = prd.class),\n"
    "pc1 AS (SELECT *, CASE WHEN n_predicted = 0 THEN 0.0 ELSE tp::DOUBLE / n_predicted END AS precision, tp::DOUBLE / support AS recall FROM pc0),\n"
    "pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pc1),\n"
    "met AS (SELECT model, l_returnflag, round(SUM(tp)::DOUBLE / SUM(support), 6) + 0.0 AS accuracy, "
    "round(SUM(f1 * support) / SUM(support), 6) + 0.0 AS f1, round(SUM(precision * support) / SUM(support), 6) + 0.0 AS weighted_precision, "
    "round(SUM(recall * support) / SUM(support), 6) + 0.0 AS weighted_recall, CAST(SUM(support) AS BIGINT) AS n FROM pc GROUP BY 1, 2),\n"
    "g AS (SELECT model, l_returnflag, score, COUNT(*) FILTER (WHERE y = 1) AS pos, COUNT(*) FILTER (WHERE y <> 1) AS neg FROM p GROUP BY 1, 2, 3),\n"
    "cu AS (SELECT *, SUM(neg) OVER (PARTITION BY model, l_returnflag ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM g),\n"
    "au AS (SELECT model, l_returnflag, CASE WHEN SUM(pos) = 0 OR SUM(neg) = 0 THEN NULL ELSE "
    "round(SUM(pos * ((cum_neg - neg) + neg / 2.0)) / (SUM(pos)::DOUBLE * SUM(neg)::DOUBLE), 6) + 0.0 END AS auc FROM cu GROUP BY 1, 2)\n"
    "SELECT met.*, au.auc FROM met LEFT JOIN au ON met.model = au.model AND met.l_returnflag = au.l_returnflag",
)
def q_segment_metrics(spark, sf):
    """Every metric per (model, segment): the same grouped passes with one more key."""
    p = rule_predictions(spark, sf, extra=("l_returnflag",))
    return E.evaluate(p, "y", "prediction", "score", by=["model", "l_returnflag"])


# ---------------------------------------------------------------- layers and reports
def _kpi_sql(layer: str, section: str, pairs, src: str) -> str:
    return _u(f"SELECT '{layer}' AS layer, '{section}' AS section, '{k}' AS key, CAST({e} AS DOUBLE) AS value FROM {src}" for k, e in pairs)


@query(
    "bronze_report",
    f"{W}, s AS (SELECT qty, price, tax, disc, y FROM r), a AS (SELECT COUNT(*) AS n, "
    + ", ".join(f"COUNT(*) - COUNT({c}) AS m_{c}" for c in SAMPLE_COLS)
    + ", COUNT(*) FILTER (WHERE y = 0) AS l0, COUNT(*) FILTER (WHERE y = 1) AS l1 FROM s),\n"
    "d AS (SELECT (SELECT COUNT(*) FROM s) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM s)) AS dup)\n"
    + _u(
        [
            _kpi_sql("bronze", "table", [("total_rows", "n"), ("total_columns", str(len(SAMPLE_COLS)))], "a"),
            _kpi_sql("bronze", "missing_values", [(c, f"m_{c}") for c in SAMPLE_COLS], "a"),
            _kpi_sql("bronze", "missing_pct", [(c, f"round(100.0 * (m_{c}::DOUBLE / n), 2) + 0.0") for c in SAMPLE_COLS], "a"),
            _kpi_sql("bronze", "label_distribution", [("0", "l0"), ("1", "l1")], "a"),
            _kpi_sql("bronze", "table", [("duplicates", "dup")], "d"),
            _kpi_sql("bronze", "schema", [("qty:double", "0"), ("price:double", "1"), ("tax:double", "2"), ("disc:double", "3"), ("y:int", "4")], "d"),
        ]
    ),
)
def q_bronze_report(spark, sf):
    return R.bronze_report(readings(spark, sf).select(*SAMPLE_COLS), LABEL)


_SILVER_CTE = (
    f"{W}, s AS (SELECT qty, price, tax, disc, y FROM r),\n"
    "m AS (SELECT AVG(qty) AS mq, AVG(price) AS mp, AVG(tax) AS mt FROM s),\n"
    "c AS (SELECT DISTINCT COALESCE(qty, mq) AS qty, COALESCE(price, mp) AS price, COALESCE(tax, mt) AS tax, disc, y FROM s, m)"
)


@query(
    "silver_report",
    f"{_SILVER_CTE},\na AS (SELECT COUNT(*) AS n, "
    + ", ".join(f"COUNT(*) - COUNT({c}) AS m_{c}" for c in SAMPLE_COLS)
    + ", COUNT(*) FILTER (WHERE y = 0) AS l0, COUNT(*) FILTER (WHERE y = 1) AS l1, "
    + ", ".join(
        f"round(AVG({c}::DOUBLE), 4) + 0.0 AS a_{c}, round(STDDEV_SAMP({c}::DOUBLE), 4) + 0.0 AS s_{c}, "
        f"round(MIN({c}::DOUBLE), 4) + 0.0 AS lo_{c}, round(MAX({c}::DOUBLE), 4) + 0.0 AS hi_{c}"
        for c in FEATURES
    )
    + " FROM c),\nb AS (SELECT COUNT(*) AS nb FROM s)\n"
    + _u(
        [
            _kpi_sql("silver", "table", [("total_rows", "n")], "a"),
            _kpi_sql("silver", "table", [("rows_before", "nb")], "b"),
            _kpi_sql("silver", "imputation_applied", [("qty", "round(mq, 4) + 0.0"), ("price", "round(mp, 4) + 0.0"), ("tax", "round(mt, 4) + 0.0")], "m"),
            _kpi_sql("silver", "missing_after", [(c, f"m_{c}") for c in SAMPLE_COLS], "a"),
            _kpi_sql("silver", "label_distribution", [("0", "l0"), ("1", "l1")], "a"),
            *[
                _kpi_sql("silver", f"feature_stats.{c}", [("mean", f"a_{c}"), ("std", f"s_{c}"), ("min", f"lo_{c}"), ("max", f"hi_{c}")], "a")
                for c in FEATURES
            ],
            _kpi_sql("silver", "table", [("duplicates_removed", "nb - n")], "a, b"),
        ]
    ),
)
def q_silver_report(spark, sf):
    return R.silver_report(readings(spark, sf).select(*SAMPLE_COLS), LABEL, IMPUTED, FEATURES)


@query(
    "layer_counts",
    f"{_SILVER_CTE} SELECT 'bronze' AS layer, COUNT(*) AS n_rows FROM s UNION ALL SELECT 'silver', COUNT(*) FROM c",
)
def q_layer_counts(spark, sf):
    raw = readings(spark, sf).select(*SAMPLE_COLS)
    clean, _ = R.silver_tables(raw, IMPUTED)
    return R.layer_counts(raw, clean)


# ---------------------------------------------------------------- sources and sinks
@query("scan_csv_roundtrip", f"{W} SELECT * FROM r")
def q_scan_csv_roundtrip(spark, sf):
    r = readings(spark, sf)
    path = IO.write_table(r, _scratch(spark, "csv"), fmt="csv")
    return IO.read_table(spark, path, fmt="csv", schema=r.schema)


@query("layer_roundtrip_parquet", f"{W} SELECT * FROM r")
def q_layer_roundtrip_parquet(spark, sf):
    root = _scratch(spark, "layers")
    LY.publish_layer(readings(spark, sf), root, "bronze", "readings")
    return LY.read_layer(spark, root, "bronze", "readings")


@query(
    "layer_stats_json",
    f"{W}, s AS (SELECT qty, price, tax, disc, y FROM r)\n"
    "SELECT 'bronze' AS layer, (SELECT COUNT(*) FROM s) AS total_rows, CAST(5 AS BIGINT) AS total_columns, "
    "(SELECT COUNT(*) FROM s) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM s)) AS duplicates, col AS \"column\", n_missing FROM ("
    + _u(f"SELECT '{c}' AS col, COUNT(*) - COUNT({c}) AS n_missing FROM s" for c in SAMPLE_COLS)
    + ")",
)
def q_layer_stats_json(spark, sf):
    doc = R.stats_document(R.bronze_report(readings(spark, sf).select(*SAMPLE_COLS), LABEL))
    path = IO.write_table(doc, _scratch(spark, "json"), fmt="json")
    back = IO.read_table(spark, path, fmt="json", schema=doc.schema)
    return back.select(
        "layer", "total_rows", "total_columns", "duplicates", F.explode("missing_values").alias("column", "n_missing")
    )


_LINES = {"qty": ("(l_orderkey * 7 + l_linenumber) % 50 = 0", "(l_orderkey * 7 + l_linenumber) % 41 = 0"), "disc": ("(l_orderkey + l_partkey) % 60 = 0", "FALSE"), "shipped": ("(l_partkey * 5 + l_linenumber) % 70 = 0", "(l_partkey * 5 + l_linenumber) % 33 = 0")}
_TORN = "(l_orderkey * 3 + l_suppkey) % 90 = 0"
_LEDGER = [("*", "TRUE", "FALSE"), ("*good", f"NOT {_TORN} AND NOT (" + " OR ".join(bad for bad, _ in _LINES.values()) + ")", "FALSE"), ("*malformed", _TORN, "FALSE")]
_LEDGER += [(c, "FALSE", "FALSE") for c in ("l_orderkey", "l_linenumber")] + [(c, f"NOT {_TORN} AND {bad}", f"NOT {_TORN} AND NOT {bad} AND {empty}") for c, (bad, empty) in _LINES.items()]


@query(
    "ingest_ledger",
    _u(f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {bad}) AS n_failed, COUNT(*) FILTER (WHERE {empty}) AS n_null FROM lineitem" for c, bad, empty in _LEDGER),
)
def q_ingest_ledger(spark, sf):
    """lineitem as text lines with words in number and date cells, empty cells and torn lines; what a typed read makes of them."""
    words = {"qty": ("n/a", "l_quantity"), "disc": ("5%", "l_discount"), "shipped": ("soon", "l_shipdate")}
    cell = {c: F.when(F.expr(bad), word).when(F.expr(empty), "").otherwise(F.col(src).cast("string")) for (c, (bad, empty)), (word, src) in zip(_LINES.items(), words.values())}
    line = F.concat_ws(",", "l_orderkey", "l_linenumber", *cell.values(), F.when(F.expr(_TORN), "torn"))
    path = _scratch(spark, "lines")
    table(spark, sf, "lineitem").select(line.alias("value")).write.text(path)
    return IO.read_checked(spark, path, "l_orderkey long, l_linenumber long, qty double, disc double, shipped date", header=False).ledger


_SQL_OF = {n: ORACLE[n] for n in ("bronze_report", "silver_report")}


@query(
    "layer_documents",
    _u(f"SELECT layer, section, key, value, CAST(NULL AS VARCHAR) AS text FROM ({sql})" for sql in _SQL_OF.values())
    + f"\nUNION ALL SELECT * FROM ({_MLONG}, b AS (SELECT model FROM met ORDER BY accuracy DESC, model LIMIT 1)\n"
    "SELECT 'gold' AS layer, 'model_comparison.' || model AS section, metric AS key, value, CAST(NULL AS VARCHAR) AS text FROM ml\n"
    "UNION ALL SELECT 'gold', 'metrics', metric, value, NULL FROM ml JOIN b USING (model)\n"
    "UNION ALL SELECT 'gold', 'best_model', 'name', NULL, model FROM b)",
)
def q_layer_documents(spark, sf):
    """One statistics document per layer, written as JSON and read back with its types; gold compares the rule models."""
    from strata.plans import documents as D

    raw = readings(spark, sf).select(*SAMPLE_COLS)
    gold, words = D.comparison_kpis(_rules_metrics(spark, sf))
    docs = D.layer_document(R.bronze_report(raw, LABEL)).unionByName(D.layer_document(R.silver_report(raw, LABEL, IMPUTED, FEATURES))).unionByName(D.layer_document(gold, words))
    path = IO.write_table(docs, _scratch(spark, "documents"), fmt="json")
    return D.document_rows(IO.read_table(spark, path, fmt="json", schema=D.SCHEMA))


# ---------------------------------------------------------------- secondary inputs and extensions
# Admissible ranges of the readings columns (column, low, high).
RANGE_RULES = [("qty", 1.0, 50.0), ("price", 900.0, 105000.0), ("tax", 0.0, 0.08), ("disc", 0.0, 0.1)]


@query(
    "range_violations",
    f"{W}\n"
    + _u(
        f"SELECT '{c}' AS \"column\", CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi, COUNT({c}) AS n_checked, "
        f"COUNT(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS n_violations FROM r"
        for c, lo, hi in RANGE_RULES
    ),
)
def q_range_violations(spark, sf):
    from strata.operators.quality import range_violations

    return range_violations(readings(spark, sf), RANGE_RULES)


@query(
    "uncertainty_flag",
    f"{RULES} SELECT model, COUNT(*) FILTER (WHERE abs(score - 0.5) < 0.1) AS n_review, COUNT(*) AS n FROM p GROUP BY model",
)
def q_uncertainty_flag(spark, sf):
    from strata.operators.models import uncertainty_flag

    f = uncertainty_flag(rule_predictions(spark, sf), "score", 0.1)
    return f.groupBy("model").agg(F.count_if("needs_review").alias("n_review"), F.count(F.lit(1)).alias("n"))


@query(
    "class_weights",
    f"{W}, c AS (SELECT y, COUNT(*) AS nc FROM r GROUP BY y)\n"
    "SELECT y, nc AS n, round(SUM(nc) OVER () / (COUNT(*) OVER () * nc), 6) + 0.0 AS weight FROM c",
)
def q_class_weights(spark, sf):
    from strata.operators.models import class_weights

    w = class_weights(readings(spark, sf), LABEL)
    return w.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"), rnd(F.first("weight"), 6).alias("weight"))


@query(
    "regression_metrics",
    "WITH j AS (SELECT l_extendedprice AS y, l_quantity * p_retailprice AS yhat FROM lineitem JOIN part ON l_partkey = p_partkey)\n"
    "SELECT COUNT(*) AS n, round(sqrt(AVG((y - yhat) * (y - yhat))), 6) + 0.0 AS rmse, round(AVG(abs(y - yhat)), 6) + 0.0 AS mae, "
    "round(1 - SUM((y - yhat) * (y - yhat)) / (COUNT(*) * VAR_POP(y)), 6) + 0.0 AS r2 FROM j",
)
def q_regression_metrics(spark, sf):
    from strata.operators.quality import regression_metrics
    li = table(spark, sf, "lineitem").select("l_partkey", "l_extendedprice", "l_quantity")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    j = li.join(part, "l_partkey")
    j = j.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * F.col("p_retailprice")).alias("yhat"))
    return regression_metrics(j, "y", "yhat")


@query(
    "class_value_stats",
    "SELECT event_type, COUNT(value) AS \"count\", round(AVG(value), 6) + 0.0 AS mean, round(STDDEV_SAMP(value), 6) + 0.0 AS stddev, "
    "round(MIN(value), 6) + 0.0 AS min, round(MAX(value), 6) + 0.0 AS max FROM events GROUP BY event_type",
)
def q_class_value_stats(spark, sf):
    from strata.operators.quality import grouped_describe

    return grouped_describe(table(spark, sf, "events"), "value", ["event_type"])


@query(
    "labeled_documents",
    "SELECT quality, COUNT(*) AS n, round(AVG(n_chars), 6) + 0.0 AS mean_chars, "
    "round(AVG(length(text) - length(replace(text, ' ', '')) + 1), 6) + 0.0 AS mean_words "
    "FROM labels JOIN documents USING (doc_id) GROUP BY quality",
)
def q_labeled_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "text")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    j = docs.join(labels, "doc_id")
    words = (F.length("text") - F.length(F.regexp_replace("text", " ", "")) + 1).cast("double")
    return j.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.avg("n_chars"), 6).alias("mean_chars"), rnd(F.avg(words), 6).alias("mean_words")
    )


_EMB_PRED = (
    "WITH e AS (SELECT label, CAST((list_position(embedding, list_max(embedding)) - 1) % 10 AS INTEGER) AS prediction FROM embeddings),\n"
    "conf AS (SELECT label, prediction, COUNT(*) AS c FROM e GROUP BY 1, 2),\n"
    "lab AS (SELECT label AS class, SUM(c) AS support, SUM(CASE WHEN label = prediction THEN c ELSE 0 END) AS tp FROM conf GROUP BY 1),\n"
    "prd AS (SELECT prediction AS class, SUM(c) AS n_predicted FROM conf GROUP BY 1),\n"
    "pc0 AS (SELECT lab.*, COALESCE(prd.n_predicted, 0) AS n_predicted FROM lab LEFT JOIN prd ON lab.class = prd.class),\n"
    "pc1 AS (SELECT *, CASE WHEN n_predicted = 0 THEN 0.0 ELSE tp::DOUBLE / n_predicted END AS precision, tp::DOUBLE / support AS recall FROM pc0),\n"
    "pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pc1)\n"
    "SELECT round(SUM(tp)::DOUBLE / SUM(support), 6) + 0.0 AS accuracy, round(SUM(f1 * support) / SUM(support), 6) + 0.0 AS f1, "
    "round(SUM(precision * support) / SUM(support), 6) + 0.0 AS weighted_precision, "
    "round(SUM(recall * support) / SUM(support), 6) + 0.0 AS weighted_recall, CAST(SUM(support) AS BIGINT) AS n FROM pc"
)


@query("multiclass_metrics", _EMB_PRED)
def q_multiclass_metrics(spark, sf):
    """Ten-class metrics: the predicted class is the place of the largest embedding component, modulo ten."""
    emb = table(spark, sf, "embeddings")
    pred = ((F.array_position("embedding", F.array_max("embedding")) - 1) % 10).cast("int")
    return E.classification_metrics(emb.select("label", pred.alias("prediction")), "label", "prediction")


# ---------------------------------------------------------------- models (rows-only checks)
def _model_inputs(spark, sf):
    r = readings(spark, sf)
    return FE.hash_split(r, KEYS)


def _model_query(kind: str):
    def run(spark, sf):
        from strata.plans.gold import model_predictions

        return model_predictions(_model_inputs(spark, sf), kind, FEATURES, IMPUTED, LABEL, KEYS)

    return run


for _kind in ("rf", "dt", "lr", "gbt", "svc"):
    QUERIES[f"{_kind}_predictions"] = _model_query(_kind)


_SMALL = {"rf": {"numTrees": 8, "maxDepth": 4, "seed": 42}, "dt": {"maxDepth": 4, "seed": 42}, "lr": {"maxIter": 10}, "gbt": {"maxIter": 3, "maxDepth": 3, "seed": 42}, "svc": {"maxIter": 10}}
_CONTRACT_MODELS = ["Random Forest", "Decision Tree", "Logistic Regression", "Gradient Boosting", "Linear SVM", "Notebook Forest"]


@query(
    "model_contract",
    f"{W}, s AS (SELECT *, {_SPLIT_SQL} AS split FROM r), m(model) AS (VALUES "
    + ", ".join(f"('{m}')" for m in _CONTRACT_MODELS)
    + ")\nSELECT model, l_orderkey, l_linenumber, l_partkey, l_suppkey, y AS label, TRUE AS consistent FROM s, m WHERE split = 'test'",
)
def q_model_contract(spark, sf):
    """Every test row scored by each of six fitted models, with its label, a class that follows from the score, and probabilities that sum to one.

    The contract doesn't hang on a model's size: the notebook's forest has its own settings, the others are small."""
    from strata.operators.models import NOTEBOOK_FOREST, prediction_contract
    from strata.plans.gold import model_predictions, run_models

    inputs = _model_inputs(spark, sf)
    run = run_models(inputs, FEATURES, IMPUTED, LABEL, KEYS, kinds=("rf", "dt", "lr", "gbt", "svc"), params=_SMALL)
    notebook = model_predictions(inputs, "rf", FEATURES, IMPUTED, LABEL, KEYS, params=NOTEBOOK_FOREST).withColumn("model", F.lit("Notebook Forest"))
    return prediction_contract(run.preds.unionByName(notebook), KEYS)


_WHOLE = "qty IS NOT NULL AND price IS NOT NULL AND tax IS NOT NULL"
_STUMP_FEATURES = ["qty", "tax", "disc"]
_GINI = "(1 - power({a} / ({a} + {b}), 2) - power({b} / ({a} + {b}), 2))"
_STUMP_SQL = (
    f"{W}, t AS (SELECT * FROM r WHERE {_WHOLE}),\nv AS ("
    + _u(f"SELECT {i} AS f, {c}::DOUBLE AS x, COUNT(*) FILTER (WHERE y = 0)::DOUBLE AS n0, COUNT(*) FILTER (WHERE y = 1)::DOUBLE AS n1 FROM t GROUP BY {c}" for i, c in enumerate(_STUMP_FEATURES))
    + "),\nc AS (SELECT f, (x + LEAD(x) OVER w) / 2 AS threshold, SUM(n0) OVER w AS l0, SUM(n1) OVER w AS l1, "
    "SUM(n0) OVER (PARTITION BY f) AS a0, SUM(n1) OVER (PARTITION BY f) AS a1 FROM v WINDOW w AS (PARTITION BY f ORDER BY x)),\n"
    "d AS (SELECT *, a0 - l0 AS r0, a1 - l1 AS r1 FROM c WHERE threshold IS NOT NULL),\n"
    f"g AS (SELECT *, {_GINI.format(a='a0', b='a1')} - (l0 + l1) / (a0 + a1) * {_GINI.format(a='l0', b='l1')} - (r0 + r1) / (a0 + a1) * {_GINI.format(a='r0', b='r1')} AS gain FROM d),\n"
    "best AS (SELECT * FROM g ORDER BY round(gain, 12) DESC, f, threshold LIMIT 1),\n"
    f"o AS (SELECT CASE WHEN qty > 25 THEN 1 ELSE 0 END AS x, COUNT(*) FILTER (WHERE y = 0)::DOUBLE AS n0, COUNT(*) FILTER (WHERE y = 1)::DOUBLE AS n1 FROM t GROUP BY 1)\n"
)


def _stump_rows(model: str, scale: int, left: str, right: str) -> list[str]:
    values = [("feature", "f"), ("threshold", "threshold"), ("gain", f"{scale} * gain"), ("left", left), ("right", right)]
    return [f"SELECT '{model}' AS model, '{k}' AS quantity, round({e}, 6) + 0.0 AS value FROM best" for k, e in values]


_VOTE = "CASE WHEN {s}1 > {s}0 THEN 1.0 ELSE 0.0 END"
_MEAN = "({s}1 - {s}0) / ({s}0 + {s}1)"


@query(
    "exact_fits",
    _STUMP_SQL
    + _u(
        [
            *_stump_rows("Decision Tree", 1, _VOTE.format(s="l"), _VOTE.format(s="r")),
            "SELECT 'Decision Tree' AS model, 'importance' AS quantity, 1.0::DOUBLE AS value",
            *_stump_rows("Random Forest", 1, _VOTE.format(s="l"), _VOTE.format(s="r")),
            *_stump_rows("Gradient Boosting", 2, _MEAN.format(s="l"), _MEAN.format(s="r")),
            "SELECT 'Logistic Regression' AS model, 'intercept' AS quantity, round(ln(n1 / n0), 4) + 0.0 AS value FROM o WHERE x = 0",
            "SELECT 'Logistic Regression' AS model, 'coefficient' AS quantity, round(ln(b.n1 / b.n0) - ln(a.n1 / a.n0), 4) + 0.0 AS value FROM o a, o b WHERE a.x = 0 AND b.x = 1",
            "SELECT 'Linear Regression' AS model, 'slope' AS quantity, round(regr_slope(price, qty), 4) + 0.0 AS value FROM t",
            "SELECT 'Linear Regression' AS model, 'intercept' AS quantity, round(regr_intercept(price, qty), 4) + 0.0 AS value FROM t",
            "SELECT 'Linear Regression' AS model, 'r2' AS quantity, round(regr_r2(price, qty), 4) + 0.0 AS value FROM t",
        ]
    ),
)
def q_exact_fits(spark, sf):
    """Fits with a closed form: one split of a tree, a forest and a boosted ensemble, a logistic fit on a two-valued feature, least squares."""
    from strata.plans.gold import exact_fits

    whole = readings(spark, sf).where(_WHOLE)
    return exact_fits(whole, _STUMP_FEATURES, LABEL, KEYS, (F.col("qty") > 25).cast("double"), "qty", "price")


@query("feature_importance")
def q_feature_importance(spark, sf):
    from strata.plans.gold import feature_importance

    return feature_importance(_model_inputs(spark, sf), "dt", FEATURES, IMPUTED, LABEL, KEYS)


@query("model_comparison")
def q_model_comparison(spark, sf):
    from strata.plans.gold import model_comparison

    return model_comparison(_model_inputs(spark, sf), FEATURES, IMPUTED, LABEL, KEYS).drop("fit_seconds")


@query("gold_report")
def q_gold_report(spark, sf):
    from strata.plans.gold import gold_report, run_models
    from strata.plans.physical import materialize

    run = run_models(_model_inputs(spark, sf), FEATURES, IMPUTED, LABEL, KEYS)
    out = materialize(gold_report(run, FEATURES), "gold")
    run.release()
    return out


@query("cross_validation")
def q_cross_validation(spark, sf):
    from strata.plans.gold import cross_validate

    return cross_validate(_model_inputs(spark, sf), FEATURES, IMPUTED, LABEL, KEYS)


@query("regression_models")
def q_regression_models(spark, sf):
    from strata.plans.gold import regression_baselines
    li = table(spark, sf, "lineitem").select(*KEYS, "l_extendedprice", "l_quantity", "l_discount")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", "p_size")
    j = li.join(part, "l_partkey")
    return regression_baselines(FE.hash_split(j, KEYS), ["l_quantity", "l_discount", "p_retailprice", "p_size"], "l_extendedprice", KEYS)


@query("medallion_run")
def q_medallion_run(spark, sf):
    """Write bronze, silver and gold for the readings view; return the gold KPI table as stored."""
    from strata.plans.medallion import run_medallion

    root = _scratch(spark, "medallion")
    run_medallion(readings(spark, sf), root, "readings", LABEL, FEATURES, IMPUTED, KEYS)
    return LY.read_layer(spark, root, "gold", "metrics")


@query("stream_model_scoring")
def q_stream_model_scoring(spark, sf):
    """A decision-tree pipeline fitted on the training rows scores lineitem as a file stream."""
    from strata.plans.gold import fit_model
    from strata.plans.readings import readings_of
    from strata.streaming.scoring import score_model_files

    model = fit_model(_model_inputs(spark, sf), "dt", FEATURES, IMPUTED, LABEL, KEYS)
    return score_model_files(
        spark, model, f"{sf.rstrip('/')}/lineitem.parquet", _scratch(spark, "stream-model"), prepare=readings_of, keep=[*KEYS, LABEL]
    )


@query(
    "stream_scoring",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CASE WHEN l_quantity * l_discount > 1.2 THEN 1 ELSE 0 END AS INTEGER) AS y, "
    "CAST(l_quantity / 50.0 AS DOUBLE) AS score, CAST(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS INTEGER) AS prediction, "
    "abs(l_quantity / 50.0 - 0.5) < 0.1 AS needs_review FROM lineitem",
)
def q_stream_scoring(spark, sf):
    from strata.streaming.scoring import score_files

    return score_files(spark, f"{sf.rstrip('/')}/lineitem.parquet", _scratch(spark, "stream"))


@query("stream_counters", "SELECT event_type, COUNT(*) AS n, COUNT(*) FILTER (WHERE value > 10) AS n_high FROM events GROUP BY event_type")
def q_stream_counters(spark, sf):
    """Events delivered as files in time order, all of them twice; each event counts once."""
    from strata.streaming.counters import count_files

    inbox = _scratch(spark, "inbox")
    for _ in range(2):
        table(spark, sf, "events").repartitionByRange(4, "ts").write.mode("append").parquet(inbox)
    counts = {"n": F.count(F.lit(1)), "n_high": F.count_if(F.col("value") > 10)}
    return count_files(spark, inbox, _scratch(spark, "counters"), ["event_id"], "ts", ["event_type"], counts, lateness="45 days", max_files_per_trigger=3)


ORACLE.update({k: _published(v) for k, v in ORACLE.items()})
