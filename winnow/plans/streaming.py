"""Streaming query: incremental selection over events (H8)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..operators.validate import regression_verdict
from ..session import read_table, shared_dir
from ..streaming.incremental import current_selection, run_incremental
from .registry import query
from .selection import REGRESSION


@query("incremental_selection", """
SELECT event_id, status, failure_code, score, duplicate_of FROM (@select_regression_events@)
""")
def incremental_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H8: events arrive as daily files in a shared folder; the stream judges each file
    once, dedup included, and reads only the buckets of its state that a batch
    touches.  The result equals the one-shot selection, whatever the order of the files."""
    run = shared_dir(spark, f"incremental-{uuid.uuid4().hex[:8]}")
    inbox, store, ckpt = f"{run}/inbox", f"{run}/store", f"{run}/_stream"
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    ev.withColumn("day", F.to_date("ts")).repartition("day").write.partitionBy("day").parquet(inbox)
    schema = spark.read.parquet(inbox).schema

    def stage(batch: DataFrame) -> DataFrame:
        b = batch.select("event_id", "user_id", "event_type", "value",
                         F.lit(codes.REGRESSION).alias("mode"), F.col("event_type").alias("pipeline_id"),
                         F.col("value").alias("prediction"))
        return regression_verdict(b, REGRESSION).select("event_id", "user_id", "event_type", "value", "failure_code", "score")

    keys = ["user_id", "event_type"]
    run_incremental(spark, inbox, schema, stage, store, "event_id", keys, [-F.col("value")], ckpt, max_files_per_trigger=8, buckets=8)
    return current_selection(spark, store, "event_id", keys).select("event_id", "status", "failure_code", "score", "duplicate_of")
