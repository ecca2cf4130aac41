"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridloom.session import scratch_table_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(col, UPPER, LOWER)


#: A stored table needs the shuffles behind it no more; with this setting Spark
#: drops their files when the write has ended, not at some later collection.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage, computes a frame that is read several times once,
    and survives the loss of any executor."""
    conf, path = df.sparkSession.conf, scratch_table_dir(df.sparkSession, name)
    before = conf.get(_DROP_SHUFFLES, "false")
    conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_DROP_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_rows(df: DataFrame, name: str) -> tuple[DataFrame, int, int]:
    """``store`` with the number of rows and an order-free hash of them,
    observed while they are written."""
    seen = Observation()
    out = store(df.observe(seen, F.count(F.lit(1)).alias("n"),
                           F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")).alias("hash")), name)
    return out, seen.get["n"], seen.get["hash"]


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def null_safe(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def text_slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most ``max_bytes`` of text (a
    longer text is a run of its own), so a task's memory does not grow with
    the batch."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        before, at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(before, before[at] + max_bytes, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def release_memory() -> None:
    """Hand freed memory back to the system at the end of a task: Python
    workers outlive their tasks and keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def collect_driver_garbage(spark: SparkSession) -> None:
    """Collect garbage in the driver's JVM, as Spark itself does every half
    hour: only then does its cleaner drop the broadcasts, shuffles and plans of
    what went before, and the heap shrinks."""
    spark.sparkContext._jvm.java.lang.System.gc()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def isolated(docs: DataFrame, used: tuple[str, ...], change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply ``change``, which keeps or drops rows and may rewrite the ``used``
    columns, with all other columns renamed out of its way; the result has the
    columns of ``docs``."""
    names = {c: c if c in used else f"_other{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return change(inner).select(*[F.col(n).alias(c) for c, n in names.items()])
