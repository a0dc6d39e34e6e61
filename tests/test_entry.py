import glob
import os

import __spark_entry__ as entry_mod
from strata_paths import SF0001


def test_entry_runs_on_smoke_data(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["layer", "section", "key", "value"]


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def test_stream_scoring_equals_batch(spark):
    from strata.plans.rules import rule_predictions

    q = entry_mod.queries()["stream_scoring"](spark, SF0001)
    batch = rule_predictions(spark, SF0001).filter("model = 'by_qty'").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "y", "score", "prediction"
    )
    assert q.drop("needs_review").exceptAll(batch).count() == 0 and q.count() == batch.count()


def test_stream_model_scoring_equals_batch_transform(spark):
    from strata.operators.models import build_pipeline
    from strata.plans.readings import FEATURES, KEYS, LABEL, readings, readings_of
    from strata.streaming.scoring import score_model_files
    import tempfile

    r = readings(spark, SF0001)
    model = build_pipeline("dt", FEATURES, LABEL, impute=["qty", "price", "tax"], maxDepth=3, seed=42).fit(r)
    out = score_model_files(spark, model, f"{SF0001}/lineitem.parquet", tempfile.mkdtemp(prefix="strata-sm-"), prepare=readings_of, keep=KEYS)
    from pyspark.sql import functions as F

    batch = model.transform(r).select(*KEYS, F.col("prediction").cast("int").alias("prediction"))
    assert out.count() == r.count()
    assert out.select(*KEYS, "prediction").exceptAll(batch).count() == 0
