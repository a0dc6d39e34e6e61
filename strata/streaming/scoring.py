"""Score a folder of arriving parquet files with Structured Streaming.

The stream reads with the table's declared schema (no inference on a
stream), adds the label, score and prediction columns with the same
expressions as the batch rule model, flags uncertain rows, and appends to a
parquet sink.  ``availableNow`` drains what is there and stops, so the same
job serves as a scheduled incremental batch; the checkpoint folder makes it
restartable after a failure without duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def score_readings(stream: DataFrame, eps: float = 0.1) -> DataFrame:
    """The by-quantity rule as a stateless streaming projection."""
    q, d = F.col("l_quantity"), F.col("l_discount")
    score = (q / F.lit(50.0)).cast("double")
    return stream.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.when(q * d > F.lit(1.2).cast("double"), 1).otherwise(0).cast("int").alias("y"),
        score.alias("score"),
        F.when(q > 25, 1).otherwise(0).cast("int").alias("prediction"),
        (F.abs(score - F.lit(0.5)) < F.lit(eps)).alias("needs_review"),
    )


def _file_stream(spark: SparkSession, source: str, max_files_per_trigger: int) -> DataFrame:
    schema = spark.read.parquet(source).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if source.endswith(".parquet") and not any(ch in source for ch in "*?[{"):
        # a single file: watch it through a glob so partition discovery starts at its folder
        folder, name = source.rsplit("/", 1)
        source = f"{folder}/{name[:-1]}[{name[-1]}]"
        reader = reader.option("basePath", folder)
    return reader.parquet(source)


def _drain(frame: DataFrame, out_dir: str) -> None:
    query = (
        frame.writeStream.format("parquet")
        .option("path", f"{out_dir}/data")
        .option("checkpointLocation", f"{out_dir}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def score_model_files(spark: SparkSession, model, source: str, out_dir: str, prepare=None, keep=(), max_files_per_trigger: int = 16) -> DataFrame:
    """Score arriving files with a fitted ``PipelineModel``; ``prepare`` maps raw rows to model inputs.

    Writes (keep..., prediction, p1) and returns the sink as a batch frame.
    """
    from pyspark.ml.functions import vector_to_array

    stream = _file_stream(spark, source, max_files_per_trigger)
    if prepare is not None:
        stream = prepare(stream)
    scored = model.transform(stream).select(
        *keep, F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability")[1].alias("p1")
    )
    _drain(scored, out_dir)
    return spark.read.parquet(f"{out_dir}/data")


def score_files(spark: SparkSession, source: str, out_dir: str, max_files_per_trigger: int = 16) -> DataFrame:
    """Run the scoring stream over ``source`` until drained; return the sink as a batch frame."""
    _drain(score_readings(_file_stream(spark, source, max_files_per_trigger)), out_dir)
    return spark.read.parquet(f"{out_dir}/data")
