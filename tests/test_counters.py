"""Streamed counters equal the batch's, however often files are delivered and batches run."""

import tempfile

from pyspark.sql import functions as F

from strata.plans.readings import table
from strata.streaming.counters import count_files, totals
from strata_paths import SF0001


def counts():
    return {"n": F.count(F.lit(1)), "n_high": F.count_if(F.col("value") > 10)}


def want(df):
    return {r.event_type: (r.n, r.n_high) for r in df.groupBy("event_type").agg(*[c.alias(n) for n, c in counts().items()]).collect()}


def test_repeated_deliveries_count_once(spark):
    inbox, out = (tempfile.mkdtemp(prefix="strata-count-") for _ in range(2))
    events = table(spark, SF0001, "events")
    early, late = events.where("ts < '2024-01-15'"), events.where("ts >= '2024-01-15'")
    args = (["event_id"], "ts", ["event_type"], counts(), "60 days", 2)
    early.repartition(3).write.mode("append").parquet(inbox)
    got = {r.event_type: (r.n, r.n_high) for r in count_files(spark, inbox, out, *args).collect()}
    assert got == want(early)
    # the same files again, then the rest with part of what came before
    early.repartition(2).write.mode("append").parquet(inbox)
    late.unionByName(early.limit(100)).repartition(3).write.mode("append").parquet(inbox)
    got = {r.event_type: (r.n, r.n_high) for r in count_files(spark, inbox, out, *args).collect()}
    assert got == want(events)
    # nothing new: nothing changes
    count_files(spark, inbox, out, *args)
    assert {r.event_type: (r.n, r.n_high) for r in totals(spark, out, ["event_type"], [*counts()]).collect()} == want(events)
