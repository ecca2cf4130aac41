"""Registered streaming query: the hour-ending rollup of ``events`` run as
a Structured Streaming job over the table's folder (``availableNow``),
then read back as a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.session import scratch_table_dir
from gridloom.streaming.hourly import current_result, run_available


def q_stream_hourly(spark: SparkSession, sf: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").schema
    base = scratch_table_dir(spark, "stream_hourly")
    run_available(spark, sf, schema, out_path=f"{base}/out", checkpoint=f"{base}/checkpoint",
                  ts_col="ts", keys=["event_type"], value_col="value", glob="events.parquet",
                  sum_scale=2)
    return current_result(spark, f"{base}/out", "ts", ["event_type"], "value")
