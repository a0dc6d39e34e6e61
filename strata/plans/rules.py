"""Rule-based scores over all of ``lineitem`` that stand in for models.

They give every evaluation operator an exact oracle: (model, keys, y, score,
prediction) is built from one scan, three rows per input row (``inline`` of an
array, no union of three scans).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.readings import KEYS, table

# Fixed definition of the rule models (shared with the DuckDB oracle).
RULES_SQL = """
SELECT 'by_qty' AS model, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CASE WHEN l_quantity * l_discount > 1.2 THEN 1 ELSE 0 END AS INT) AS y,
       l_quantity / 50.0 AS score, CAST(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS INT) AS prediction
FROM lineitem
UNION ALL
SELECT 'by_disc', l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CASE WHEN l_quantity * l_discount > 1.2 THEN 1 ELSE 0 END AS INT),
       l_discount * 10.0, CAST(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS INT)
FROM lineitem
UNION ALL
SELECT 'never', l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CASE WHEN l_quantity * l_discount > 1.2 THEN 1 ELSE 0 END AS INT),
       CAST(0.0 AS DOUBLE), CAST(0 AS INT)
FROM lineitem
"""


def rule_predictions(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """(model, keys..., [extra lineitem columns...], y, score, prediction), three rows per lineitem row."""
    li = table(spark, sf_dir, "lineitem")
    q, d = F.col("l_quantity"), F.col("l_discount")
    y = F.when(q * d > F.lit(1.2).cast("double"), 1).otherwise(0).cast("int")

    def rule(name, score, pred):
        return F.struct(F.lit(name).alias("model"), score.cast("double").alias("score"), pred.cast("int").alias("prediction"))

    rules = F.array(
        rule("by_qty", q / F.lit(50.0).cast("double"), F.when(q > 25, 1).otherwise(0)),
        rule("by_disc", d * F.lit(10.0).cast("double"), F.when(d > F.lit(0.05).cast("double"), 1).otherwise(0)),
        rule("never", F.lit(0.0), F.lit(0)),
    )
    return li.select(*KEYS, *extra, y.alias("y"), F.inline(rules)).select("model", *KEYS, *extra, "y", "score", "prediction")
