"""Bindings of the streams (T1, T2): the driver tables are dropped as files
into a source folder and drained with ``availableNow``; the oracle is the
batch query over the same table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import sinks
from ..streaming import append_unseen_stream, json_tail, run_to_parquet
from .registry import binding, table

EVENT_SCHEMA = "event_id LONG, user_id LONG, event_type STRING, value DOUBLE, props STRING"


@binding("t1_json_tail_stream", "SELECT event_id, user_id, event_type, value, props FROM events")
def q_t1(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value", "props")
    src = scratch_path(spark, "json-src")
    sinks.json_lines(e.repartition(4), src)
    out, ckpt = scratch_path(spark, "json-out"), scratch_path(spark, "json-ckpt")
    run_to_parquet(json_tail(spark, src, EVENT_SCHEMA, max_files=2), out, ckpt)
    return spark.read.parquet(out)


@binding(
    "t2_incremental_ledger_stream",
    "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS file_date FROM events",
)
def q_t2(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", F.to_date("ts").alias("file_date"))
    src = scratch_path(spark, "ledger-src")
    # several files, so the stream runs several micro-batches
    e.repartition(6).write.parquet(src)
    target = scratch_path(spark, "ledger")
    schema = "user_id LONG, event_type STRING, file_date DATE"
    append_unseen_stream(spark, src, schema, target, scratch_path(spark, "ledger-ckpt"),
                         partition_by=["file_date"], max_files=2)
    return spark.read.parquet(target).select("user_id", "event_type", "file_date")
