"""Run the layered pipeline as a batch job (``spark-submit --py-files strata.zip strata/__main__.py`` or ``python -m strata``).

    python -m strata --input data.csv --format csv --infer --label y \
        --features a,b,c --impute a,b --keys id --root hdfs:///warehouse/run1 --table readings
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from strata.plans.medallion import run_medallion
from strata.sources.io import read_table


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("--input", required=True)
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv", "json", "orc"])
    ap.add_argument("--schema", default=None, help="DDL schema, e.g. 'a double, y int' (CSV / JSON)")
    ap.add_argument("--infer", action="store_true", help="infer CSV types (extra pass)")
    ap.add_argument("--label", required=True)
    ap.add_argument("--features", required=True, help="comma-separated feature columns")
    ap.add_argument("--impute", default="", help="comma-separated columns to mean-impute")
    ap.add_argument("--keys", required=True, help="comma-separated integer key columns (hash split)")
    ap.add_argument("--models", default="rf,dt,lr,gbt")
    ap.add_argument("--params", default=None, help='JSON of model settings that replace the defaults, e.g. {"rf": {"numTrees": 50}}')
    ap.add_argument("--root", required=True, help="output root (any Hadoop URI)")
    ap.add_argument("--table", default="readings")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("strata").getOrCreate()
    split = lambda s: [x for x in s.split(",") if x]
    raw = read_table(spark, args.input, fmt=args.format, schema=args.schema, infer=args.infer)
    out = run_medallion(
        raw, args.root, args.table, args.label, split(args.features), split(args.impute), split(args.keys), split(args.models),
        json.loads(args.params) if args.params else None,
    )
    print(json.dumps(out, indent=2))


if __name__ == "__main__":
    main()
