import tempfile

from strata_paths import SF0001
from strata.plans.medallion import run_medallion
from strata.plans.readings import FEATURES, KEYS, LABEL, readings
from strata.sources.layers import read_layer


def test_medallion_writes_all_layers(spark):
    root = tempfile.mkdtemp(prefix="strata-medallion-")
    raw = readings(spark, SF0001)
    out = run_medallion(raw, root, "readings", LABEL, FEATURES, ["qty", "price", "tax"], KEYS, kinds=("dt", "lr"))
    assert {"bronze", "silver", "model_comparison", "metrics", "predictions_sample"} <= set(out)
    assert read_layer(spark, root, "bronze", "readings").count() == raw.count()
    silver = read_layer(spark, root, "silver", "readings")
    assert silver.filter("qty IS NULL OR price IS NULL OR tax IS NULL").count() == 0
    comp = read_layer(spark, root, "gold", "model_comparison").collect()
    assert len(comp) == 2 and sum(r["is_best"] for r in comp) == 1
    assert read_layer(spark, root, "gold", "predictions_sample").count() == 50
    stats = {(r["section"], r["key"]): r["value"] for r in read_layer(spark, root, "silver", "readings_stats").collect()}
    assert stats[("table", "total_rows")] == silver.count()


def test_command_line_run(spark, capsys):
    import json

    from strata.__main__ import main

    d = tempfile.mkdtemp(prefix="strata-cli-")
    readings(spark, SF0001).coalesce(1).write.option("header", True).csv(f"{d}/in")
    main([
        "--input", f"{d}/in", "--format", "csv", "--infer", "--label", LABEL,
        "--features", ",".join(FEATURES), "--impute", "qty,price,tax", "--keys", ",".join(KEYS),
        "--models", "dt", "--root", f"{d}/out",
    ])
    out = json.loads(capsys.readouterr().out)
    assert out["silver"].endswith("/silver/readings")
    assert read_layer(spark, f"{d}/out", "gold", "model_comparison").count() == 1
