"""Chunk ledger: a stored table of partial aggregates, kept by chunk.

An input that arrives in chunks (folders of a tree, batches, days) is
aggregated chunk by chunk, and the partial results are kept.  A chunk that is
run again replaces its own partials, so nothing is counted twice; a chunk
that did not change need not be read again; and the merged result equals one
pass over all chunks as they are now.

The table is Parquet, partitioned by chunk.  Every write replaces just the
chunks that it records (dynamic partition overwrite) and puts one header row
into each, with the chunk's version, so a chunk whose rerun yields no partials
replaces the old ones too.  Chunks are written by Spark's committer, each
folder as a whole: after a failed write a chunk is the old one, the new one or
absent, and an absent one is pending.  Writers of different chunks do not
disturb each other.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridloom.functions.columns import q
from gridloom.operators.timeseries import merge_partials

VERSION, HEADER = "_chunk_version", "_chunk_header"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


class ChunkLedger:
    """Partials under ``path``; ``chunk`` names the chunk column (text)."""

    def __init__(self, spark: SparkSession, path: str, chunk: str = "chunk"):
        self.spark, self.path, self.chunk = spark, path, chunk

    # ------------------------------------------------------------------ state

    def _stored(self) -> DataFrame | None:
        """The whole table, chunk names as text (``007`` stays ``007``)."""
        try:
            found = self.spark.read.option("mergeSchema", True).parquet(self.path)
        except AnalysisException as exc:
            if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        schema = StructType([StructField(f.name, StringType()) if f.name == self.chunk else f for f in found.schema.fields])
        return self.spark.read.schema(schema).parquet(self.path)

    def recorded(self) -> DataFrame:
        """(chunk, version) of the chunks that count now."""
        held = self._stored()
        if held is None:
            return self.spark.createDataFrame([], f"{q(self.chunk)} string, version string")
        return held.where(F.col(HEADER) & F.col(VERSION).isNotNull()).select(
            F.col(q(self.chunk)), F.col(VERSION).alias("version"))

    def pending(self, versions: DataFrame) -> DataFrame:
        """The (chunk, version) rows that are not recorded in that version."""
        wanted = versions.select(F.col(q(self.chunk)).cast("string").alias(self.chunk), F.col("version").cast("string").alias("version"))
        return wanted.join(self.recorded(), [self.chunk, "version"], "left_anti")

    def vanished(self, versions: DataFrame) -> DataFrame:
        """Recorded chunks that ``versions`` (the whole input) has no more."""
        names = versions.select(F.col(q(self.chunk)).cast("string").alias(self.chunk))
        return self.recorded().join(names, self.chunk, "left_anti").select(self.chunk)

    # ------------------------------------------------------------------ write

    def record(self, partials: DataFrame, versions: DataFrame) -> None:
        """Replace the chunks named in ``versions`` (chunk, version) by the
        rows of ``partials``; a chunk without rows becomes an empty one.
        Fails, and writes nothing, when ``partials`` has a chunk that is not
        named or a chunk is named twice."""
        chunk = F.col(q(self.chunk))
        named = versions.groupBy(chunk.cast("string").alias(self.chunk)).agg(
            F.count(F.lit(1)).alias("_n"), F.min(F.col("version").cast("string")).alias(VERSION))
        twice = F.concat(F.lit("chunk named twice: "), F.coalesce(chunk, F.lit("null")))
        named = named.select(self.chunk, F.when(F.col("_n") > 1, F.raise_error(twice)).otherwise(F.col(VERSION)).alias(VERSION))
        named = named.withColumn("_known", F.lit(True))
        unknown = F.concat(F.lit("partials of a chunk that is not recorded: "), F.coalesce(chunk, F.lit("null")))
        rows = (partials.withColumn(self.chunk, chunk.cast("string")).join(named, self.chunk, "left")
                .withColumn(VERSION, F.when(F.col("_known"), F.col(VERSION)).otherwise(F.raise_error(unknown)))
                .drop("_known").withColumn(HEADER, F.lit(False)))
        headers = named.drop("_known").withColumn(HEADER, F.lit(True))
        self._replace(rows.unionByName(headers, allowMissingColumns=True))

    def withdraw(self, chunks: DataFrame) -> None:
        """Take chunks out of the result; each keeps a header without version."""
        held = self._stored()
        if held is None:
            return
        names = chunks.select(F.col(q(self.chunk)).cast("string").alias(self.chunk)).distinct()
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in held.schema.fields if f.name not in (self.chunk, HEADER)]
        self._replace(names.select(self.chunk, *none, F.lit(True).alias(HEADER)))

    def _replace(self, rows: DataFrame) -> None:
        # few files a chunk, and adaptive execution splits a chunk that is large
        (rows.hint("rebalance", F.col(q(self.chunk))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(self.chunk).parquet(self.path))

    # ------------------------------------------------------------------- read

    def partials(self) -> DataFrame:
        """The partial rows of all chunks that count."""
        held = self._stored()
        if held is None:
            raise FileNotFoundError(f"no chunk was recorded under {self.path}")
        return held.where(~F.col(HEADER)).drop(HEADER, VERSION)

    def merged(self, keys: Sequence[str], sums: Sequence[str], means: dict[str, tuple[str, str]] | None = None,
               sum_scale: int | None = None) -> DataFrame:
        """The partials merged over all chunks (``merge_partials``)."""
        return merge_partials(self.partials(), keys, sums, means, sum_scale)


def folder_versions(listing: DataFrame, root: str, chunk: str = "chunk") -> DataFrame:
    """(chunk, version) of a file listing (path, length, modificationTime):
    a chunk is a folder below ``root`` (``.`` is ``root`` itself), its version
    a hash of its files, so a file that is added, changed or removed changes
    its folder's version."""
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    return listing.groupBy(folder_below(F.col("path"), root).alias(chunk)).agg(
        F.concat_ws("-", F.count(F.lit(1)).cast("string"), F.sum(mark).cast("string")).alias("version"))


def folder_below(path: Column, root: str) -> Column:
    """The folder of a file relative to ``root``; ``.`` for ``root`` itself.
    Scheme and authority are left out, as Spark spells them in several ways."""
    bare = re.sub(SCHEME, "", root).strip("/")
    folder = F.regexp_replace(F.regexp_replace(path, SCHEME, ""), "/?[^/]*$", "")
    below = F.substring(folder, len(f"/{bare}/") + 1 if bare else 2, 1 << 30)
    return F.when(below == "", F.lit(".")).otherwise(below)
