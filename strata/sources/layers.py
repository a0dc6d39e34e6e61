"""Bronze / silver / gold table folders.

A layer is a folder ``root/<layer>/<table>`` of parquet part files, or, where
runs publish by manifest (``sources.publication``), what the newest manifest
names.  The root may be any Hadoop URI (hdfs://, s3a://, file:); nothing goes
through a machine-local path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.sources.io import read_table, write_table
from strata.sources.publication import LAYERS, manifest


def layer_path(root: str, layer: str, table: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    if not table or "/" in table:
        raise ValueError(f"bad table name {table!r}")
    return f"{root.rstrip('/')}/{layer}/{table}"


def publish_layer(df: DataFrame, root: str, layer: str, table: str, fmt: str = "parquet") -> str:
    """Overwrite ``root/layer/table`` with ``df``; returns the folder."""
    return write_table(df, layer_path(root, layer, table), fmt=fmt, mode="overwrite")


def read_layer(spark: SparkSession, root: str, layer: str, table: str, fmt: str = "parquet") -> DataFrame:
    """The table of the current run; a root without manifests is read by folder.  LookupError if the current run has no such table."""
    path, current = layer_path(root, layer, table), manifest(spark, root)
    if current is None:
        return read_table(spark, path, fmt=fmt)
    entry = current["tables"].get(f"{layer}/{table}")
    if entry is None:
        raise LookupError(f"run {current['run']} has no table {layer}/{table}")
    return read_table(spark, entry["path"], fmt=entry["format"], infer=entry["format"] == "csv")
