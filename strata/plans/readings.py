"""The adapted input of the query catalog, derived from ``lineitem``.

``lineitem`` has no missing values, so nulls are injected by integer
arithmetic on the keys; the label is a fixed rule.  The same text runs on
Spark SQL and DuckDB, so every query built on it has an exact oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
FEATURES = ["qty", "price", "tax", "disc"]
LABEL = "y"
LABEL_NAMES = {0: "low", 1: "high"}

# Fixed definition of the adapted view (shared with the DuckDB oracle).
READINGS_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN (l_orderkey*7 + l_partkey*13) % 20 < 3 THEN NULL ELSE l_quantity END AS qty,
  CASE WHEN (l_orderkey*3 + l_partkey*11) % 25 < 6 THEN NULL ELSE l_extendedprice END AS price,
  CASE WHEN (l_orderkey + l_partkey) % 20 = 0 THEN NULL ELSE l_tax END AS tax,
  l_discount AS disc,
  CAST(CASE WHEN l_quantity * l_discount > 1.2 THEN 1 ELSE 0 END AS INT) AS y
FROM lineitem
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``readings`` view as DataFrame expressions (column pruning reaches the scan)."""
    return readings_of(table(spark, sf_dir, "lineitem"))


def readings_of(li: DataFrame) -> DataFrame:
    """The same projection over any lineitem-shaped frame, batch or streaming."""
    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    null = F.lit(None).cast("double")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.when((ok * 7 + pk * 13) % 20 < 3, null).otherwise(F.col("l_quantity")).alias("qty"),
        F.when((ok * 3 + pk * 11) % 25 < 6, null).otherwise(F.col("l_extendedprice")).alias("price"),
        F.when((ok + pk) % 20 == 0, null).otherwise(F.col("l_tax")).alias("tax"),
        F.col("l_discount").alias("disc"),
        F.when(F.col("l_quantity") * F.col("l_discount") > F.lit(1.2).cast("double"), 1)
        .otherwise(0)
        .cast("int")
        .alias("y"),
    )
