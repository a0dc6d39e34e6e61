"""Typed reads and writes.

CSV is read with a declared schema by default; schema inference is an opt-in
because it costs an extra pass over the file.  Empty fields read as null (a
quoted empty field is an empty text) and the text ``NaN`` as NaN, like pandas'
default NA rules; ``nan_as_null`` then folds NaN into null for float columns.
``read_checked`` keeps account of what a declared schema cannot hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import is_float_type, nan_to_null

_FORMATS = ("parquet", "csv", "json", "orc")
#: Unquoted empty fields read as this; quoted ones as empty text.
_UNQUOTED_EMPTY = "\x00"
_CORRUPT = "_corrupt"


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    infer: bool = False,
    header: bool = True,
    null_value: str = "",
    nan_value: str = "NaN",
    nan_as_null: bool = False,
) -> DataFrame:
    """Read a table in ``fmt``; for CSV either ``schema`` or ``infer=True`` is needed."""
    if fmt not in _FORMATS:
        raise ValueError(f"unknown format {fmt!r}; expected one of {_FORMATS}")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        if schema is None and not infer:
            raise ValueError("CSV needs a schema or infer=True")
        reader = (
            reader.option("header", header)
            .option("inferSchema", bool(infer and schema is None))
            .option("nullValue", null_value or _UNQUOTED_EMPTY)
            .option("nanValue", nan_value)
            .option("mode", "PERMISSIVE")
        )
    paths = [path] if isinstance(path, str) else list(path)
    df = reader.load(paths if len(paths) > 1 else paths[0])
    if nan_as_null:
        df = df.select(
            [nan_to_null(df, f.name) if is_float_type(f.dataType) else df[f.name] for f in df.schema.fields]
        )
    return df


class Checked(NamedTuple):
    """Rows that the schema holds, typed; the others, as text with the columns that failed; and the ledger."""

    good: DataFrame
    bad: DataFrame
    ledger: DataFrame


def read_checked(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, header: bool = True, null_value: str = "") -> Checked:
    """Read CSV by a declared schema without losing what does not fit it.

    Fields are read as text and cast by ``try_cast``.  ``good`` has the rows
    whose every non-null field casts; ``bad`` the rest: the fields as text,
    ``failed`` (names of the columns whose cast failed) and ``line``, the whole
    line where it has too few or too many fields (then the fields are what was
    read of it).  ``ledger`` is (column, n_failed, n_null): a row per column
    over well-formed lines, and the rows ``*`` (lines in all), ``*good`` and
    ``*malformed``, from one aggregation.  An empty folder of lines gives zeros.
    """
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in fields] + [T.StructField(_CORRUPT, T.StringType())])
    reader = spark.read.format("csv").schema(text).option("header", header).option("nullValue", null_value or _UNQUOTED_EMPTY)
    # a pruned read would not see that a line is malformed
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).option("columnPruning", False)
    raw = reader.load(path if isinstance(path, str) else list(path))
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType) for f in fields]
    lost = [F.col(f"`{f.name}`").isNotNull() & c.isNull() for f, c in zip(fields, typed)]
    failed = F.filter(F.array(*[F.when(x, F.lit(f.name)) for f, x in zip(fields, lost)]), lambda x: x.isNotNull())
    whole = F.col(_CORRUPT).isNull()
    judged = raw.withColumn("failed", F.when(whole, failed).otherwise(F.array().cast("array<string>")))
    fits = whole & (F.size("failed") == 0)
    good = judged.where(fits).select(*[c.alias(f.name) for f, c in zip(fields, typed)])
    bad = judged.where(~fits).select(*[f"`{f.name}`" for f in fields], "failed", F.col(_CORRUPT).alias("line"))
    sums = [("*", F.count(F.lit(1)), F.lit(0)), ("*good", F.count_if(fits), F.lit(0)), ("*malformed", F.count_if(~whole), F.lit(0))]
    sums += [(f.name, F.count_if(whole & x), F.count_if(whole & F.col(f"`{f.name}`").isNull())) for f, x in zip(fields, lost)]
    one = judged.agg(*[F.struct(n.cast("long").alias("n_failed"), m.cast("long").alias("n_null")).alias(f"_{i}") for i, (_, n, m) in enumerate(sums)])
    rows = F.array(*[F.struct(F.lit(name).alias("column"), F.col(f"_{i}.n_failed"), F.col(f"_{i}.n_null")) for i, (name, _, _) in enumerate(sums)])
    return Checked(good, bad, one.select(F.inline(rows)))


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    header: bool = True,
) -> str:
    """Write ``df`` as a folder of part files (any Hadoop URI); returns the path."""
    if fmt not in _FORMATS:
        raise ValueError(f"unknown format {fmt!r}; expected one of {_FORMATS}")
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", header).option("nullValue", "")
    writer.save(path)
    return path
