"""Headers and column types of CSV trees, without reading files whole twice.

``HeaderIndex`` keeps, per file (path, length, modification time), its header
line and, once asked for, what its values say about the type of each column.
Both are stored as Parquet where the caller says and filled for new or changed
files only; without a place they serve one read.

The head of a new file is read by a small job that stops after its first row,
over any file system and compression that Spark reads; ``HEADS_AT_ONCE`` run at
a time, about 45 files a second on eight cores.  (Ending a Python task early
does not help: its worker still takes in the whole file.)  A first look at more
than ``MOST_HEADS`` files is one distributed pass over their lines instead; the
headers are the same.

Types are a lattice: per column four flags (a value was seen; one was not an
integer, not a number, not a boolean), merged by "or".  Flags of 15 columns
are packed into one integer, so a row of any width is folded by a few
aggregates inside the map tasks, and flags of files merge the same way.
"""

from __future__ import annotations

import csv
import hashlib
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.columns import q
from gridloom.functions.scalars import null_tokens_to_null, plain_path
from gridloom.session import materialize, scratch_table_dir

# The spellings of booleans.
TRUE_FALSE = ("True", "False", "true", "false", "TRUE", "FALSE")

SEEN, NOT_INTEGER, NOT_NUMBER, NOT_BOOLEAN = 8, 1, 2, 4
PACK = 15  # columns in one integer, four flags each
HEADS_AT_ONCE = 16
MOST_HEADS = 20_000

_FILE = ["path", "length", "modified"]


# ----------------------------------------------------------------- type lattice

def value_flags(v: Column) -> Column:
    """The flags of one text value; a missing one has none."""
    # the pattern first: a failed cast of text is costly, and few values need it
    integer = v.rlike(r"^\s*[+-]?[0-9]+\s*$") & v.try_cast("bigint").isNotNull()
    flags = (F.when(v.isNull(), 0).when(integer, SEEN | NOT_BOOLEAN)
             .when(v.try_cast("double").isNotNull(), SEEN | NOT_INTEGER | NOT_BOOLEAN)
             .when(v.isin(*TRUE_FALSE), SEEN | NOT_INTEGER | NOT_NUMBER)
             .otherwise(SEEN | NOT_INTEGER | NOT_NUMBER | NOT_BOOLEAN))
    return flags.cast("long")


def packed_flags(columns: Sequence[str]) -> list[Column]:
    """The merged flags of ``columns``, ``PACK`` of them to an aggregate.  The
    rule stands once per pack, not per column, so wide plans stay small."""
    packs = []
    for at in range(0, len(columns), PACK):
        values = F.transform(F.array(*[F.col(q(c)) for c in columns[at:at + PACK]]), lambda v: null_tokens_to_null(v))
        pack = F.aggregate(F.transform(values, value_flags), F.lit(0).cast("long"),
                           lambda acc, flags: F.shiftleft(acc, 4).bitwiseOR(flags))
        packs.append(F.coalesce(F.bit_or(pack), F.lit(0).cast("long")))
    return packs


def unpack(packs: Sequence[int], n: int) -> list[int]:
    """The flags of ``n`` columns; the first of a pack is in the highest bits."""
    return [packs[i // PACK] >> 4 * (min(n, i - i % PACK + PACK) - 1 - i) & 15 for i in range(n)]


def flag_type(flags: int) -> str:
    """All values integers: ``bigint``; numbers: ``double``; True or False:
    ``boolean``; else ``string``.  A column without a value is a ``double``."""
    if not flags & SEEN:
        return "double"
    for bit, kind in ((NOT_INTEGER, "bigint"), (NOT_NUMBER, "double"), (NOT_BOOLEAN, "boolean")):
        if not flags & bit:
            return kind
    return "string"


def infer_text_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """Type of each text column from its values, the way tabular readers infer
    CSV columns (``flag_type``); missing-value spellings (``NA``, ``None``,
    ``NaN``, empty, ...) count as missing.  One aggregate of a few integers over
    the rows as they are; the driver receives those integers."""
    cols = [n for n, t in df.dtypes if t == "string"] if columns is None else list(columns)
    if not cols:
        return {}
    packs = list(df.agg(*[p.alias(f"p{i}") for i, p in enumerate(packed_flags(cols))]).first())
    return {c: flag_type(f) for c, f in zip(cols, unpack(packs, len(cols)))}


# ----------------------------------------------------------------- header index

def list_files(spark: SparkSession, root: str | Sequence[str], glob: str) -> DataFrame:
    """(path, length, modificationTime) of every file under ``root`` matching
    ``glob``, recursively (the ``binaryFile`` source, contents pruned)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(root if isinstance(root, str) else list(root))
            .select("path", "length", "modificationTime"))


def literal_path(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


_HEADER = r"^\uFEFF|\r$"


def read_heads(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """The first line of each file that has one.  A job a file, some at a time,
    that stops after its first row and so reads no more than a buffer."""
    def head(path: str) -> tuple[str, str | None]:
        rows = spark.read.text(literal_path(path)).select(F.regexp_replace("value", _HEADER, "")).limit(1).collect()
        return path, rows[0][0] if rows else None

    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:
        return {path: line for path, line in pool.map(head, paths) if line is not None}


def scan_heads(spark: SparkSession, root: str | Sequence[str], glob: str) -> DataFrame:
    """(path, header) of all files by one distributed pass over their lines:
    reads everything, but needs no job a file."""
    lines = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .text(root if isinstance(root, str) else list(root))
             .select("value", F.col("_metadata.file_path").alias("path"),
                     F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at")))
    return (lines.groupBy("path").agg(F.min_by("value", "at").alias("header"))
            .select(plain_path(F.col("path")).alias("path"), F.regexp_replace("header", _HEADER, "").alias("header")))


class HeaderIndex:
    """Header and column flags of the files under ``root`` matching ``glob``;
    kept under ``path`` between runs, or in the run's own folder."""

    def __init__(self, spark: SparkSession, root: str | Sequence[str], glob: str, path: str | None = None):
        self.spark, self.root, self.glob = spark, root, glob
        self.kept, self.path = path is not None, path or scratch_table_dir(spark, "headers")
        self._now: DataFrame | None = None

    def _read(self, part: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def headers(self) -> DataFrame:
        """(path, length, modified, header) of the files that are there now;
        the head of a file is read when it is new or changed."""
        if self._now is not None:
            return self._now
        schema = "path string, length long, modified timestamp, header string"
        listed = list_files(self.spark, self.root, self.glob).withColumnRenamed("modificationTime", "modified")
        listed = materialize(listed.where("length > 0"), "listing")
        missing = listed.join(self._read("headers", schema), _FILE, "left_anti") if self.kept else listed
        new = [r["path"] for r in missing.select("path").collect()]
        if new:
            heads = (scan_heads(self.spark, self.root, self.glob) if len(new) > MOST_HEADS else
                     self.spark.createDataFrame(list(read_heads(self.spark, new).items()), "path string, header string"))
            missing.join(heads, "path").select(*_FILE, "header").write.mode("append").parquet(f"{self.path}/headers")
        held = self._read("headers", schema).join(listed, _FILE, "left_semi").dropDuplicates(_FILE)
        self._now = materialize(held, "headers")
        return self._now

    def types(self, frames: dict[str, DataFrame], columns: Sequence[str], path_col: str) -> dict[str, str]:
        """Types of ``columns`` from all values of all files.  ``frames`` has,
        by header, the rows of its files as text with their path; only files
        without stored flags for these columns are read."""
        if not columns:
            return {}
        mark = hashlib.sha256("\x00".join(sorted(columns)).encode()).hexdigest()
        schema = "path string, length long, modified timestamp, columns string, packs array<long>"
        files = self.headers()
        known = self._read("types", schema).where(F.col("columns") == mark).select(*_FILE)
        missing = files.join(known, _FILE, "left_anti")
        for header, frame in frames.items():
            here = missing.where(F.col("header") == header).select(*_FILE)
            paths = [r["path"] for r in here.select("path").collect()]
            cols = [c for c in columns if c in frame.columns]
            if not paths or not cols:
                continue
            rows = frame.withColumn(path_col, plain_path(F.col(q(path_col))))
            if len(paths) < files.where(F.col("header") == header).count():
                rows = rows.where(F.col(q(path_col)).isin(paths))
            packs = rows.groupBy(F.col(q(path_col)).alias("path")).agg(F.array(*packed_flags(cols)).alias("packs"))
            found = here.join(packs, "path", "left").select(
                *_FILE, F.lit(mark).alias("columns"), F.coalesce("packs", F.array().cast("array<long>")).alias("packs"))
            found.write.mode("append").parquet(f"{self.path}/types")
        stored = self._read("types", schema).where(F.col("columns") == mark).join(files.select(*_FILE, "header"), _FILE)
        merged = {c: 0 for c in columns}
        for header, frame in frames.items():
            cols = [c for c in columns if c in frame.columns]
            n = -(-len(cols) // PACK)
            if not n:
                continue
            row = stored.where(F.col("header") == header).agg(
                *[F.coalesce(F.bit_or(F.get("packs", F.lit(i))), F.lit(0).cast("long")).alias(f"p{i}") for i in range(n)]).first()
            for c, flags in zip(cols, unpack(list(row), len(cols))):
                merged[c] |= flags
        return {c: flag_type(f) for c, f in merged.items()}


def header_names(header: str) -> list[str]:
    return next(csv.reader([header]))
