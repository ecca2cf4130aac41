"""File sources: partitioned Parquet trees, header-aware CSV trees,
all-string lookup files, county series files.

Partition values from ``k=v`` directories stay text (type inference off)
so codes such as ``01001`` keep their zeros.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridloom.functions.codes import zfill
from gridloom.functions.columns import q, resolve_column
from gridloom.functions.scalars import null_tokens_to_null, plain_path
from gridloom.operators.sets import union_by_name
from gridloom.sources.headers import TRUE_FALSE, HeaderIndex, header_names, infer_text_types, list_files, literal_path  # noqa: F401


def read_parquet_tree(spark: SparkSession, root: str, state: str | None = None,
                      state_col: str = "state", merge_schema: bool = False) -> DataFrame:
    """A Hive-partitioned Parquet tree; ``k=v`` folders become string
    columns; non-Parquet files are skipped; an optional state filter is a
    partition filter (pruned at listing) or a pushed row filter.  Columns are
    those of one file; ``merge_schema`` reads every footer, for a tree whose
    files differ in their columns.

    The partition columns are declared as text in the schema of the read, so
    no session setting is touched and codes keep their zeros.
    """
    reader = (spark.read.option("mergeSchema", str(merge_schema).lower())
              .option("pathGlobFilter", "*.parquet").option("basePath", root))
    df = reader.parquet(root)
    first = df.select(F.col("_metadata.file_path").alias("path")).limit(1).collect()
    below = first[0]["path"].split(root.split(":", 1)[-1].strip("/"), 1)[-1] if first else ""
    folders = {part.split("=", 1)[0] for part in below.split("/")[:-1] if "=" in part}
    schema = StructType([StructField(f.name, StringType()) if f.name in folders else f for f in df.schema.fields])
    if schema != df.schema:
        df = reader.schema(schema).parquet(root)
    if state is not None:
        df = df.where(F.col(q(state_col)) == F.lit(state))
    return df


def read_all_string(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A delimited file with a header, every column text (leading zeros
    survive)."""
    return (spark.read.option("header", True).option("sep", sep)
            .option("inferSchema", False).csv(path))


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """County -> zone table: needs ``FIPS`` and ``R`` (or ``r``); FIPS is
    zero-filled to five; returns (county_fips5, R)."""
    df = read_all_string(spark, path)
    if "FIPS" not in df.columns:
        raise KeyError("zone file is missing required column: FIPS")
    zcol = resolve_column(df.columns, ["R", "r"], "zone column R or r")
    return df.select(zfill(F.col("FIPS"), 5).alias("county_fips5"), F.col(q(zcol)).alias("R"))


def _csv_frames(spark: SparkSession, root: str | Sequence[str], glob: str, index: HeaderIndex, multi_line: bool,
                path_col: str) -> dict[str, DataFrame]:
    """By header line: the rows of its files as text, with their path.

    Spark maps the columns of a file by position, so files are grouped by
    header and each group is read with its own, which Spark compares with
    every file's (``enforceSchema=false``).  With one header for all files the
    tree is read as it is; path lists are used only where headers differ.  A
    row with too few or too many fields fails the job; ``multi_line`` reads
    quoted line breaks.
    """
    headers = index.headers()
    distinct = sorted(r["header"] for r in headers.select("header").distinct().collect())
    if not distinct:
        raise FileNotFoundError(f"no files matching {glob!r} under {root}")
    frames = {}
    for header in distinct:
        schema = StructType([StructField(c, StringType()) for c in header_names(header)])
        reader = (spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
                  .option("columnPruning", False).option("multiLine", multi_line)
                  .option("escape", '"').schema(schema))
        if len(distinct) == 1:
            df = (reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
                  .csv(root if isinstance(root, str) else list(root)))
        else:
            paths = headers.where(F.col("header") == F.lit(header)).select("path").orderBy("path")
            df = reader.csv([literal_path(r["path"]) for r in paths.collect()])
        frames[header] = df.withColumn(path_col, F.col("_metadata.file_path"))
    return frames


_PATH = "_path"


def apply_text_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Missing-value spellings -> null on text columns, then the given casts.
    A value that is not of its column's type fails the job: nothing turns
    into null silently."""
    cols = []
    for f in df.schema.fields:
        c = F.col(q(f.name))
        if isinstance(f.dataType, StringType):
            c = null_tokens_to_null(c)
            t = types.get(f.name, "string")
            if t != "string":
                parsed = F.when(c.isin(*TRUE_FALSE), F.lower(c) == "true") if t == "boolean" else c.try_cast(t)
                text = F.concat(F.lit(f"column {f.name}: not a {t}: "), c)
                c = F.when(c.isNotNull() & parsed.isNull(), F.raise_error(text)).otherwise(parsed)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def read_csv_tree(spark: SparkSession, root: str | Sequence[str], glob: str = "*.csv",
                  types: dict[str, str] | Callable[[list[str]], dict[str, str]] | None = None,
                  infer: bool = True, multi_line: bool = False, index: str | None = None,
                  with_path: str | None = None) -> DataFrame:
    """All CSV files under ``root`` (a folder, or paths) as one frame, columns
    matched by name (``_csv_frames``; missing columns null).

    Missing-value spellings become null.  ``types`` names the types of
    columns, as a dictionary or a rule from the column names; those of the
    others are inferred from all their values unless ``infer`` is off, which
    leaves them text.  Headers come from the heads of the files.  ``index``
    names a folder in which headers and inferred types are kept, so that a
    later read looks only at files that are new or changed; without it
    inferring costs one pass over the files.  ``with_path`` adds the file's path.
    """
    headers = HeaderIndex(spark, root, glob, index)
    frames = _csv_frames(spark, root, glob, headers, multi_line, _PATH)
    merged = union_by_name(list(frames.values()))
    names = [c for c in merged.columns if c != _PATH]
    known = dict(types(names) if callable(types) else types or {})
    if infer:
        left = [c for c in names if c not in known]
        known.update(headers.types(frames, left, _PATH) if index else infer_text_types(merged, left))
    typed = apply_text_types(merged.select(*[F.col(q(c)) for c in names], *([_PATH] if with_path else [])), known)
    return typed.withColumn(_PATH, plain_path(F.col(_PATH))).withColumnRenamed(_PATH, with_path) if with_path else typed


def read_county_series(spark: SparkSession, root: str, value_col: str,
                       glob: str = "*-gap.csv", partition: str = "county", index: str | None = None) -> DataFrame:
    """County time-series files ``.../county=<code>/<name>-gap.csv``.

    Only ``timestamp`` (kept as text) and ``value_col`` are kept, matched by
    the name in each file's own header (``index``: where headers are kept, see
    ``read_csv_tree``); the value is cast to double under ANSI rules, so a blank or
    non-numeric value fails the job as it should.  The code comes from the
    parent folder ``<partition>=<code>``; files in a folder without ``=``
    get a null code (and are routed aside by the rollup)."""
    frames = _csv_frames(spark, root, glob, HeaderIndex(spark, root, glob, index), False, _PATH)
    raw = union_by_name([f.select("timestamp", F.col(q(value_col)), _PATH) for f in frames.values()])
    parent = F.element_at(F.split(F.col(_PATH), "/"), -2)
    code = F.when(parent.contains("="), F.split(parent, "=", 2).getItem(1))
    return raw.select(F.col("timestamp"),
                      F.col(q(value_col)).cast("double").alias(value_col),
                      code.alias(partition),
                      F.col(_PATH).alias("source_path"))


def distinct_partition_values(paths: DataFrame, name: str, path_col: str = "path") -> DataFrame:
    """Distinct ``name=`` values found anywhere in the paths, numbered in
    numeric-then-text order (``0, 1, 2, 10, ..., then names``)."""
    from gridloom.functions.scalars import numeric_then_lexical
    from gridloom.operators.ranking import dense_ordinal

    c = F.col(q(path_col))
    vals = paths.select(F.explode(F.regexp_extract_all(c, F.lit(rf"(?:^|/){name}=([^/]+)"), F.lit(1))).alias(name))
    return dense_ordinal(vals, name, by=numeric_then_lexical(name)[:2], out="rank")
