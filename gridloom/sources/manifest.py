"""Manifest sources: (key, size) rows from a listing table or from the
files themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def manifest_from_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(key, size) of every file under ``root`` (content is not read)."""
    base = root.rstrip("/") + "/"
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(root).select("path", "length"))
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _re(base), "")
    return files.select(rel.alias("key"), F.col("length").alias("size"))


def _re(s: str) -> str:
    import re

    return re.escape(s)
