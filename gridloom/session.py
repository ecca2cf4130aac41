"""Session helpers.

Library code never hard-codes cluster settings: it reads what the session
has.  ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "gridloom") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("GRIDLOOM_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a folder that the driver and
    the executors share; without it a cluster session is refused, as every
    executor would write to its own disk.  Only a single-process session
    (``local[n]``: tests, a laptop) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and the executors")
        configured = tempfile.mkdtemp(prefix="gridloom-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def scratch_table_dir(spark: SparkSession, name: str) -> str:
    """A folder under the checkpoint directory for tables a job writes to
    cut lineage or to hand state between stages (shared on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/gridloom-tables/{name}-{os.getpid()}-{next(_counter)}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df``: a reliable checkpoint into the folder the
    session names in ``spark.checkpoint.dir`` (never a local checkpoint),
    so a lost executor recomputes from the checkpoint, not from the source,
    and a frame read several times is computed once.  Adaptive execution
    sizes the checkpointed partitions as long as the plan does not force a
    partition count.  ``name`` labels the step for readers of the code."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _count():
    n = 0
    while True:
        n += 1
        yield n


_counter = _count()
