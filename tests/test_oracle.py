"""Every oracle-backed query equals its DuckDB SQL at sf0.01 (the driver's correctness gate)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from strata_paths import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return "None" if v is None else str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_equals_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF001)
    rel = con.sql(entry_mod.oracle_sql()[name])
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == duck_types
    cur = con.execute(entry_mod.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(dcols, cur.fetchall())
