"""Writers: sorted CSV parts with an order index, fully quoted CSV, long CSV,
partitioned Parquet extracts and their replacement by partition, append with a
count, failed-key lists.

Every writer lets all tasks write; one file is an explicit choice for
reports of bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, LongType, StringType, StructField, StructType

from gridloom.functions.columns import q, sink_type
from gridloom.sources.headers import list_files, literal_path


def write_sorted_csv(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """One CSV file with a header, rows in ``order``, through one task: only
    for reports of bounded size.  ``write_sorted_parts`` has no such bound."""
    (df.orderBy(*[F.col(q(c)) for c in order]).coalesce(1)
     .write.mode("overwrite").option("header", True).csv(path))


ORDER_INDEX = "_order"


def write_sorted_parts(df: DataFrame, path: str, order: Sequence[str], num_parts: int | None = None) -> DataFrame:
    """CSV parts with a header each, globally ordered: the rows of a part come
    after those of the parts whose names sort before it.

    Rows are ranged and sorted by ``order`` (null first), then by their other
    columns, so a key that many rows share is spread over parts too.  Adaptive
    execution sizes the parts unless ``num_parts`` is given.  Beside the parts,
    in ``_order``, stands an index, which is returned: part, name, n_rows,
    start (rows before it), first and last key.  It is read back from the
    files; parts that overlap fail the job.
    """
    keys = [F.col(q(c)) for c in (*order, *(c for c in df.columns if c not in order))]
    ranged = df.repartitionByRange(num_parts, *keys) if num_parts else df.repartitionByRange(*keys)
    (ranged.sortWithinPartitions(*keys).write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path))
    index = _order_index(df, path, order)
    index.write.mode("overwrite").parquet(f"{path}/{ORDER_INDEX}")
    index = df.sparkSession.read.parquet(f"{path}/{ORDER_INDEX}")
    after = F.lead("first").over(Window.orderBy("part"))  # one row a file
    overlap = index.select("name", (F.col("last") > after).alias("late")).where("late").limit(1).collect()
    if overlap:
        raise RuntimeError(f"part {overlap[0]['name']} overlaps the next one")
    return index


def read_sorted_parts(df_schema: StructType, spark: SparkSession, path: str, **columns: Column) -> DataFrame:
    """The parts with the types of the frame that was written, plus ``columns``
    (over the rows and the ``_metadata`` of their files)."""
    rows = (spark.read.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            .schema(df_schema).csv(path))
    return rows.select("*", *[c.alias(n) for n, c in columns.items()])


def _order_index(df: DataFrame, path: str, order: Sequence[str]) -> DataFrame:
    rows = read_sorted_parts(df.schema, df.sparkSession, path, _name=F.col("_metadata.file_name"))
    key = F.struct(*[F.col(q(c)) for c in order])
    parts = rows.groupBy(F.col("_name").alias("name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("first"), F.max(key).alias("last"))
    by_name = Window.orderBy("name")  # one row a file
    return parts.select(
        (F.row_number().over(by_name) - 1).alias("part"), "name", "n_rows",
        F.coalesce(F.sum("n_rows").over(by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
        "first", "last")


def write_long_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Long-format CSV, header, no index column; one file per task."""
    w = df.write.mode("overwrite").option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_quoted_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Every field quoted so codes stay text in spreadsheet tools; null is
    written as ``""``.  Each task writes its part, with a header;
    ``single_file`` funnels the output through one task, for reports of
    bounded size."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)


def normalise_for_sink(df: DataFrame) -> DataFrame:
    """Types an extract accepts: small ints -> int, float -> double, NaN ->
    null on floating columns, nested/decimal/binary -> text (JSON for
    nested values)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(q(f.name))
        target = sink_type(f.dataType)
        if isinstance(f.dataType, (FloatType, DoubleType)):
            c = c.cast("double")
            c = F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)
        elif target is not None:
            c = c.cast(target)
        elif isinstance(f.dataType, DecimalType):
            c = c.cast(StringType())
        elif f.dataType.typeName() in ("array", "map", "struct"):
            c = F.to_json(c)
        else:
            c = c.cast(StringType())
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_extract(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  max_records_per_file: int = 500_000, mode: str = "overwrite") -> None:
    """Normalised Parquet extract, laid out by ``partition_by`` (e.g.
    aggregation / version / state), files capped at
    ``max_records_per_file`` rows."""
    w = (normalise_for_sink(df).write.mode(mode)
         .option("maxRecordsPerFile", max_records_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


ROW_LEDGER = "_rows"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partition_writes(spark: SparkSession, path: str, partition_by: Sequence[str]) -> dict[tuple, str]:
    """Per partition of a Parquet table (its values as text) the folder and the
    ids of the writes that its files come from, which Spark puts into their
    names.  From a listing; one entry a partition, none for a new table."""
    try:
        listed = list_files(spark, path, "part-*.parquet")
        listed.schema  # the path is looked at here
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    folder = F.regexp_replace("path", "/[^/]*$", "")
    found = (listed.where(~F.col("path").contains(f"/{ROW_LEDGER}/"))
             .groupBy(folder.alias("folder"))
             .agg(F.array_join(F.array_sort(F.collect_set(F.regexp_extract("path", r"/part-\d+-([0-9a-f-]{36})[^/]*$", 1))), " ").alias("ids"))
             .collect())
    out = {}
    for r in found:
        held = dict(part.split("=", 1) for part in r["folder"].split("/") if "=" in part)
        values = (held.get(c) for c in partition_by)
        out[tuple(None if v == NO_VALUE else unquote(v) for v in values)] = (r["folder"], r["ids"])
    return out


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], covers: Sequence[tuple] = (),
                       max_records_per_file: int = 500_000) -> DataFrame:
    """Write ``df`` into an extract, replacing just the partitions that it has
    rows of; the files of all others stay as they are.

    ``covers`` names partitions (tuples of values) that ``df`` holds whole: one
    of them without a row in ``df`` is emptied.  A ledger in ``_rows`` keeps,
    per partition, the rows and the id of its last write; the entries of this
    write are returned.  Fails when the files do not hold the rows written.
    """
    spark = df.sparkSession
    before = partition_writes(spark, path, partition_by)
    rows = normalise_for_sink(df)
    seen, written = Observation(), 0
    if not rows.isEmpty():  # an empty plan observes nothing
        (rows.observe(seen, F.count(F.lit(1)).alias("n")).hint("rebalance", *[F.col(q(c)) for c in partition_by])
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("maxRecordsPerFile", max_records_per_file).partitionBy(*partition_by).parquet(path))
        written = seen.get["n"]
    now = partition_writes(spark, path, partition_by)
    changed = {k: ids for k, (folder, ids) in now.items() if before.get(k) != (folder, ids)}
    counts = _partition_counts(spark, path, partition_by, list(changed), rows.schema) if changed else {}
    if sum(counts.values()) != written:
        raise RuntimeError(f"wrote {written} rows, but the files of the replaced partitions hold {sum(counts.values())}")
    schema = StructType([f for f in rows.schema.fields if f.name not in partition_by])
    for key in {tuple(None if v is None else str(v) for v in t) for t in covers}:
        if key in now and key not in changed:  # one small write a partition to empty
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(literal_path(now[key][0]))
            changed[key] = None
    entries = [(counts.get(k, 0), ids, *k) for k, ids in changed.items()]
    ledger = spark.createDataFrame(entries, StructType(_LEDGER + [StructField(c, StringType()) for c in partition_by]))
    if entries:
        (ledger.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(f"{path}/{ROW_LEDGER}"))
    return ledger.select(*partition_by, *[f.name for f in _LEDGER])


_LEDGER = [StructField("n_rows", LongType()), StructField("write_id", StringType())]


def row_ledger(spark: SparkSession, path: str, partition_by: Sequence[str]) -> DataFrame:
    """(partition, n_rows, write_id) of the last write of each partition."""
    schema = StructType(_LEDGER + [StructField(c, StringType()) for c in partition_by])
    return spark.read.schema(schema).parquet(f"{path}/{ROW_LEDGER}").select(*partition_by, *[f.name for f in _LEDGER])


def _partition_counts(spark: SparkSession, path: str, partition_by: Sequence[str], keys: list[tuple],
                      schema: StructType) -> dict[tuple, int]:
    """Rows of the named partitions, from the footers of their files."""
    text = StructType([StructField(f.name, StringType()) if f.name in partition_by else f for f in schema.fields])
    rows = spark.read.schema(text).parquet(path)
    names = [F.col(q(c)) for c in partition_by]
    # values of each column prune folders at listing; what they let through besides is left out below
    for i, c in enumerate(names):
        values = {k[i] for k in keys}
        named = c.isin([v for v in values if v is not None])
        rows = rows.where(named | c.isNull() if None in values else named)
    wanted = set(keys)
    found = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()
    return {tuple(r)[:-1]: r["n"] for r in found if tuple(r)[:-1] in wanted}


def append_parts(parts: Sequence[DataFrame], path: str) -> int:
    """Append each part to one Parquet table by position (the first part's
    column names), then return the table's row count."""
    names = parts[0].columns
    for i, p in enumerate(parts):
        p.toDF(*names).write.mode("overwrite" if i == 0 else "append").parquet(path)
    return parts[0].sparkSession.read.parquet(path).count()


def write_key_list(statuses: DataFrame, path: str, status: str = "error", single_file: bool = False) -> None:
    """One failed key per line, a part per task; ``single_file`` funnels them
    through one task, for lists of bounded size."""
    keys = statuses.where(F.col("status") == status).select("key")
    (keys.coalesce(1) if single_file else keys).write.mode("overwrite").text(path)
