"""Layout-independent train / test split.

``randomSplit`` samples inside each partition, so the same seed gives
different rows for different partition counts.  Here each row's side is a
function of its integer key columns only: the first 32 bits of
md5('k1|k2|...') modulo 100.  The same expression exists in DuckDB, which is
how the split is checked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_bucket(keys: Sequence[str]) -> Column:
    """Integer bucket 0..99 of the row, from its integer keys."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    head = F.substring(F.md5(text), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % F.lit(100)).cast("int")


def split_label(keys: Sequence[str], train_pct: int = 80) -> Column:
    """'train' for buckets below ``train_pct``, else 'test'."""
    if not 0 <= train_pct <= 100:
        raise ValueError("train_pct must be within 0..100")
    return F.when(split_bucket(keys) < F.lit(train_pct), F.lit("train")).otherwise(F.lit("test"))
