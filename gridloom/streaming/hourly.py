"""Structured Streaming form of the hour-ending rollup.

New files arriving in a folder are rolled up to hour-ending sums and
counts per key.  Spark windows are start-inclusive ``[h, h+1)``, and the
hour-ending label needs ``(h-1, h]``, so rows are windowed on
``ts - 1 microsecond`` and labelled by the window end.  The state store
keeps one running (sum, count) per (hour, key); each micro-batch
writes its updated rows to a Parquet change log, and the current result
is the latest version of each row.  Restarting from the checkpoint is
exactly-once: a replayed batch rewrites its own ``batch_id`` folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridloom.functions.columns import q
from gridloom.functions.scalars import exact_sum


def hourly_stream(source: DataFrame, ts_col: str, keys: Sequence[str], value_col: str,
                  sum_scale: int | None = None) -> DataFrame:
    """Streaming aggregate: (hour-ending ts, keys) -> sum, count.

    No row is ever dropped: a file arriving late still updates its hours (as
    merging chunk results in any order does), and the state holds one (sum,
    count) per (hour, key), as many as the output has rows.  ``sum_scale``
    declares the decimals of the value (``exact_sum``)."""
    shifted = F.col(q(ts_col)) - F.expr("INTERVAL 1 MICROSECOND")
    summed = exact_sum(value_col, sum_scale)
    timed = source.withColumn("_t", shifted.cast("timestamp"))
    return (timed
            .groupBy(F.window("_t", "1 hour"), *[F.col(q(k)) for k in keys])
            .agg(summed.alias("_sum"), F.count(F.lit(1)).alias("n_rows"))
            .select(F.col("window.end").alias(ts_col), *keys, "_sum", "n_rows"))


def run_available(spark: SparkSession, source_path: str, schema: StructType, out_path: str,
                  checkpoint: str, ts_col: str, keys: Sequence[str], value_col: str,
                  glob: str | None = None, max_files_per_trigger: int | None = None,
                  sum_scale: int | None = None) -> None:
    """Process every file now in ``source_path`` (``availableNow``) and
    append the updated aggregates of each micro-batch to ``out_path``."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(source_path)
    agg = hourly_stream(src, ts_col, keys, value_col, sum_scale=sum_scale)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}"))

    q_ = (agg.writeStream.outputMode("update").foreachBatch(write_batch)
          .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q_.awaitTermination()


def _log(spark: SparkSession, out_path: str) -> DataFrame:
    """The change log: the last compacted state and the batches after it."""
    batches = spark.read.parquet(out_path)
    try:
        compacted = spark.read.option("basePath", f"{out_path}_compacted").parquet(f"{out_path}_compacted")
    except AnalysisException:
        return batches
    last = compacted.agg(F.max("upto")).first()[0]
    kept = compacted.where(F.col("upto") == F.lit(last)).drop("upto")
    return kept.unionByName(batches.where(F.col("batch_id") > F.lit(last)))


def _latest(log: DataFrame, ts_col: str, keys: Sequence[str]) -> DataFrame:
    pick = F.max_by(F.struct("_sum", "n_rows", "batch_id"), "batch_id")
    return (log.groupBy(ts_col, *keys).agg(pick.alias("_r"))
            .select(ts_col, *keys, "_r._sum", "_r.n_rows", "_r.batch_id"))


def compact(spark: SparkSession, out_path: str, ts_col: str, keys: Sequence[str]) -> int | None:
    """Write the latest version of every row as one compacted state beside
    the change log; later reads start from it and only scan newer batches.
    Returns the last batch it holds (None: nothing to compact)."""
    log = _log(spark, out_path)
    last = log.agg(F.max("batch_id")).first()[0]
    if last is not None:
        _latest(log, ts_col, keys).write.mode("overwrite").parquet(f"{out_path}_compacted/upto={last}")
    return last


def current_result(spark: SparkSession, out_path: str, ts_col: str, keys: Sequence[str],
                   value_col: str) -> DataFrame:
    """Latest version of every (hour, key) row from the change log."""
    return _latest(_log(spark, out_path), ts_col, keys).select(
        F.col(q(ts_col)).cast("timestamp_ntz").alias(ts_col), *keys,
        F.col("_sum").cast("double").alias(f"sum_{value_col}"), "n_rows")
