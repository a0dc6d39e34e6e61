import tempfile

from pyspark.sql import types as T

from strata.sources import io as IO
from strata.sources import layers as LY


def test_csv_infer_null_and_nan(spark):
    d = tempfile.mkdtemp(prefix="strata-csv-")
    with open(f"{d}/t.csv", "w") as fh:
        fh.write("a,b,y\n,1.5,0\n7.1,,1\nNaN,3,1\n")
    df = IO.read_table(spark, f"{d}/t.csv", fmt="csv", infer=True)
    assert [(f.name, f.dataType) for f in df.schema.fields] == [("a", T.DoubleType()), ("b", T.DoubleType()), ("y", T.IntegerType())]
    rows = df.collect()
    assert rows[0]["a"] is None and rows[1]["b"] is None and rows[2]["a"] != rows[2]["a"]
    folded = IO.read_table(spark, f"{d}/t.csv", fmt="csv", schema="a double, b double, y int", nan_as_null=True)
    assert folded.filter("a IS NULL").count() == 2


def test_csv_requires_schema_or_infer(spark):
    import pytest

    with pytest.raises(ValueError):
        IO.read_table(spark, "/nowhere", fmt="csv")


def test_layer_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="strata-layers-")
    df = spark.createDataFrame([(1, 2.0)], "k int, v double")
    path = LY.publish_layer(df, root, "silver", "t")
    assert path.endswith("/silver/t")
    assert LY.read_layer(spark, root, "silver", "t").collect() == df.collect()
    import pytest

    with pytest.raises(ValueError):
        LY.layer_path(root, "platinum", "t")


def test_orc_and_json_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="strata-fmt-")
    df = spark.createDataFrame([(1, 2.5, "a"), (2, None, "b")], "k int, v double, s string")
    for fmt in ("orc", "json"):
        path = IO.write_table(df, f"{root}/{fmt}", fmt=fmt)
        back = IO.read_table(spark, path, fmt=fmt, schema=df.schema)
        assert sorted(back.collect()) == sorted(df.collect())


def test_empty_text_is_not_null_in_csv(spark):
    root = tempfile.mkdtemp(prefix="strata-empty-")
    df = spark.createDataFrame([(1, "", 1.0), (2, None, None), (3, "x", 0.5)], "k int, s string, v double")
    path = IO.write_table(df, f"{root}/t", fmt="csv")
    assert sorted(IO.read_table(spark, path, fmt="csv", schema=df.schema).collect()) == sorted(df.collect())
    marked = IO.read_table(spark, path, fmt="csv", schema=df.schema, null_value="x")
    assert marked.where("k = 3").first()["s"] is None


def test_checked_read_keeps_account_of_bad_cells_and_lines(spark):
    d = tempfile.mkdtemp(prefix="strata-bad-")
    with open(f"{d}/t.csv", "w") as fh:
        fh.write('k,v,day\n1,1.5,2024-01-02\n2,n/a,2024-01-03\nx,oops,never\n3,,2024-02-30\n4,NaN,\n5,1\n6,2,2024-01-01,more\n"7","8",2024-01-04\n')
    got = IO.read_checked(spark, f"{d}/t.csv", "k int, v double, day date")
    assert {r["column"]: (r.n_failed, r.n_null) for r in got.ledger.collect()} == {"*": (8, 0), "*good": (3, 0), "*malformed": (2, 0), "k": (1, 0), "v": (2, 1), "day": (2, 1)}
    assert sorted(r.k for r in got.good.collect()) == [1, 4, 7] and got.good.dtypes == [("k", "int"), ("v", "double"), ("day", "date")]
    bad = {r.k: (r.failed, r.line) for r in got.bad.collect()}
    assert bad == {"2": (["v"], None), "x": (["k", "v", "day"], None), "3": (["day"], None), "5": ([], "5,1"), "6": ([], "6,2,2024-01-01,more")}
    with open(f"{d}/none.csv", "w") as fh:
        fh.write("k,v,day\n")
    assert {r.n_failed for r in IO.read_checked(spark, f"{d}/none.csv", "k int, v double, day date").ledger.collect()} == {0}
