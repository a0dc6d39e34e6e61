"""Exactly-once counters over a folder of arriving files.

Rows may be delivered more than once: the stream drops rows whose keys it has
seen within the watermark, in state that is bounded by the lateness allowed.
What a micro-batch adds is aggregated and written to a folder named by the
batch, overwriting it, so that a batch that is run again after a failure does
not count twice.  Totals are sums over the batches' few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.streaming.scoring import _file_stream


def count_files(
    spark: SparkSession,
    source: str,
    out_dir: str,
    keys: Sequence[str],
    event_time: str,
    by: Sequence[str],
    counts: Mapping[str, Column],
    lateness: str = "1 day",
    max_files_per_trigger: int = 16,
) -> DataFrame:
    """Drain ``source`` and return (by..., counts...) over all batches so far.

    ``counts`` maps names to counting aggregates, whose sums over batches are
    totals.  A row later than ``lateness`` behind the latest event time seen in
    earlier batches is dropped: it could be a repetition that is no longer
    remembered.  Null keys are keys like others; rows with a null event time
    have no place under the watermark and are dropped.
    """
    stream = _file_stream(spark, source, max_files_per_trigger)
    fresh = stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(list(keys))

    def add(batch: DataFrame, number: int) -> None:
        rows = batch.groupBy(*by).agg(*[c.cast("long").alias(n) for n, c in counts.items()])
        rows.write.mode("overwrite").parquet(f"{out_dir}/counts/batch={number}")

    query = fresh.writeStream.foreachBatch(add).option("checkpointLocation", f"{out_dir}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return totals(spark, out_dir, by, list(counts))


def totals(spark: SparkSession, out_dir: str, by: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """The counters as they stand."""
    return spark.read.parquet(f"{out_dir}/counts").groupBy(*by).agg(*[F.sum(n).alias(n) for n in counts])


__all__ = ["count_files", "totals"]
