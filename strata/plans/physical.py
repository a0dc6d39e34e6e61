"""Physical-plan helpers: null-safe group joins and lineage cuts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import checkpoint_dir


def join_groups(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on group columns where null equals null, so that the null group keeps its rows.

    No side is forced: AQE broadcasts a side it has measured as small and
    splits a hot group of a shuffled one."""
    keys = [on] if isinstance(on, str) else list(on)
    if not keys:
        return left.crossJoin(right)
    other = right.select(*[F.col(c).alias(f"_on_{c}") if c in keys else F.col(c) for c in right.columns])
    same = [left[k].eqNullSafe(other[f"_on_{k}"]) for k in keys]
    return left.join(other, same, how).drop(*[f"_on_{k}" for k in keys])


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads the files instead of
    recomputing the plan) and turns anything nondeterministic in ``df`` — a
    partition id, a sampled range bound — into stored data.
    """
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/strata-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
