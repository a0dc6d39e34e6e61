"""Publishing a run's tables in one step.

A run writes all its tables and models into a folder of its own,
``root/runs/<id>/<layer>/<name>``.  Nothing of it is seen until ``switch``
puts a manifest, a small JSON file that names every table, under
``root/manifests`` by a rename.  Readers follow the newest manifest, so a run
that fails half-way changes nothing for them, layers of two runs are never
mixed, and a table that a run no longer writes is no longer there.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from strata.sources.io import read_table, write_table

LAYERS = ("bronze", "silver", "gold")


def _folder(spark: SparkSession, path: str):
    """(file system, path) on any Hadoop URI."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, at = _folder(spark, f"{root.rstrip('/')}/manifests")
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _read(spark: SparkSession, root: str, number: int) -> dict:
    path = f"{root.rstrip('/')}/manifests/{number:08d}.json"
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def manifest(spark: SparkSession, root: str) -> dict | None:
    """``{"run": id, "tables": {"layer/name": {"path", "format"}}}`` of the newest complete run, or None."""
    numbers = _numbers(spark, root)
    return _read(spark, root, numbers[-1]) if numbers else None


class Publication:
    """One run's output: ``put`` tables, then ``switch`` to them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.run = spark, root.rstrip("/"), uuid.uuid4().hex
        self.tables: dict[str, dict[str, str]] = {}

    def path(self, layer: str, name: str, fmt: str = "model") -> str:
        """The folder of a table or model of this run; it will be in the manifest."""
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
        if not name or "/" in name:
            raise ValueError(f"bad table name {name!r}")
        path = f"{self.root}/runs/{self.run}/{layer}/{name}"
        self.tables[f"{layer}/{name}"] = {"path": path, "format": fmt}
        return path

    def put(self, df: DataFrame, layer: str, name: str, fmt: str = "parquet") -> DataFrame:
        """Write a table and read it back."""
        path = write_table(df, self.path(layer, name, fmt), fmt=fmt)
        return read_table(self.spark, path, fmt=fmt, schema=df.schema)

    def switch(self) -> int:
        """Make this run the current one; the manifest's number.  Two runs that end at once get two numbers."""
        fs, folder = _folder(self.spark, f"{self.root}/manifests")
        fs.mkdirs(folder)
        staged = self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"_{self.run}")
        out = fs.create(staged, True)
        out.write(bytearray(json.dumps({"run": self.run, "tables": self.tables}, sort_keys=True).encode()))
        out.close()
        number = (_numbers(self.spark, self.root) or [0])[-1] + 1
        while not self._claim(fs, staged, self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:08d}.json")):
            number += 1
        return number

    @staticmethod
    def _claim(fs, staged, final) -> bool:
        if fs.exists(final):
            return False
        try:
            return fs.rename(staged, final)
        except Py4JJavaError:
            if fs.exists(final):
                return False
            raise


def retire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the runs of all but the newest ``keep`` manifests, and those manifests; runs under way have none and stay.  Returns the run ids."""
    gone = []
    for number in _numbers(spark, root)[: -max(1, keep)]:
        run = _read(spark, root, number)["run"]
        for path in (f"{root.rstrip('/')}/manifests/{number:08d}.json", f"{root.rstrip('/')}/runs/{run}"):
            fs, at = _folder(spark, path)
            fs.delete(at, True)
        gone.append(run)
    return gone


__all__ = ["LAYERS", "Publication", "manifest", "retire"]
