"""Registered queries over sources and sinks: each writes a driver table to
the run's folder (under ``spark.checkpoint.dir``) in a file layout, reads it
back through the reader in question, and returns what was read.  ``ORACLE``
holds the DuckDB SQL of the same rows straight from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions.codes import FIPS_TO_STATE, zfill
from gridloom.functions.scalars import exact_sum
from gridloom.functions.timefns import ceil_to
from gridloom.operators import manifest as mf
from gridloom.operators.ledger import ChunkLedger
from gridloom.operators.timeseries import state_rollup
from gridloom.plans import jobs
from gridloom.plans.bases import documents_manifest
from gridloom.plans.oracle import ceil_ts, values, xsum, zf
from gridloom.session import materialize, scratch_table_dir
from gridloom.sinks import writers
from gridloom.sources import files
from gridloom.sources.census import read_county_reference, read_tract_crosswalk
from gridloom.sources.tables import table


def q_csv_tree_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two CSV parts whose columns stand in different orders, one of them
    compressed, read as one tree by column name."""
    root = scratch_table_dir(spark, "csv_tree")
    ev = table(spark, sf, "events").select("event_id", "event_type", "value")
    even = F.col("event_id") % 2 == 0
    ev.where(even).write.option("header", True).csv(f"{root}/even")
    (ev.where(~even).select("value", "event_type", "event_id").write.option("header", True)
     .option("compression", "gzip").csv(f"{root}/odd"))
    return files.read_csv_tree(spark, root, "*.csv*", {"event_id": "bigint", "value": "double"}, infer=False)


def q_county_series_read(spark: SparkSession, sf: str) -> DataFrame:
    """County series files (``county=<code>/``) read by header name and summed
    to states; unknown codes are set aside."""
    root = scratch_table_dir(spark, "county_series")
    user = F.col("user_id") % 4
    code = F.element_at(F.array(*[F.lit(c) for c in SERIES_CODES]), (user + 1).cast("int"))
    ev = table(spark, sf, "events").withColumn("value", F.coalesce("value", F.lit(0.0)))
    code = F.coalesce(code, F.lit(SERIES_CODES[3]))  # no user: no known county
    rows = ev.select(F.date_format("ts", "yyyy-MM-dd HH:00:00").alias("timestamp"),
                     F.col("value").alias("kwh"), code.alias("county"), "event_id")
    (rows.where("event_id % 2 = 0").select("timestamp", "kwh", "county")
     .write.partitionBy("county").option("header", True).csv(f"{root}/a"))
    (rows.where("event_id % 2 = 1").select("kwh", "timestamp", "county")
     .write.partitionBy("county").option("header", True).csv(f"{root}/b"))
    series = files.read_county_series(spark, root, "kwh", glob="*.csv")
    return state_rollup(series, "county", "kwh", sum_scale=2).result


SERIES_CODES = ("G0100010", "G0600370", "G4800010", "G9900010")


def q_annual_extract(spark: SparkSession, sf: str) -> DataFrame:
    """A Parquet tree partitioned by a code with a leading zero -> the extract
    of one state, written and read back."""
    root = scratch_table_dir(spark, "annual")
    (table(spark, sf, "customer").withColumn("state", zfill(F.col("c_nationkey").cast("string"), 2))
     .write.partitionBy("state").parquet(f"{root}/tree"))
    _, out = jobs.annual_extract(spark, f"{root}/tree", f"{root}/extract", state="07")
    return spark.read.parquet(out).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "state")


def q_extract_inferred_folder(spark: SparkSession, sf: str) -> DataFrame:
    """The extract of a state whose output folder is inferred from the tree."""
    root = scratch_table_dir(spark, "inferred") + "/release"
    (table(spark, sf, "customer").withColumn("state", zfill(F.col("c_nationkey").cast("string"), 2))
     .write.partitionBy("state").parquet(f"{root}/by_state/basic"))
    _, out = jobs.annual_extract(spark, root, state="11")
    folder = F.lit(out.removeprefix(root))
    return spark.read.parquet(out).select("c_custkey", "c_name", "state", folder.alias("folder"))


def q_parquet_tree_read(spark: SparkSession, sf: str) -> DataFrame:
    """A partitioned tree whose codes stay text, all states."""
    root = scratch_table_dir(spark, "tree")
    (table(spark, sf, "documents").select("doc_id", "lang", "n_chars", zfill((F.col("doc_id") % 7).cast("string"), 3).alias("puma"))
     .write.partitionBy("puma").parquet(root))
    return files.read_parquet_tree(spark, root).select("doc_id", "lang", "n_chars", "puma")


def q_county_reference_read(spark: SparkSession, sf: str) -> DataFrame:
    """A pipe-separated county list: states only, composed codes."""
    root = scratch_table_dir(spark, "reference")
    n = table(spark, sf, "nation")
    (n.select(F.lit("x").alias("STATE"), zfill(F.col("n_nationkey").cast("string"), 2).alias("STATEFP"),
              zfill(F.col("n_regionkey").cast("string"), 3).alias("COUNTYFP"), F.col("n_name").alias("COUNTYNAME"))
     .write.option("header", True).option("sep", "|").csv(root))
    return read_county_reference(spark, root)


def q_tract_crosswalk_read(spark: SparkSession, sf: str) -> DataFrame:
    """A tract table: one row per tract, the area code in sample form."""
    root = scratch_table_dir(spark, "tracts")
    c = table(spark, sf, "customer")
    (c.select(zfill(F.col("c_nationkey").cast("string"), 2).alias("STATEFP"),
              zfill((F.col("c_custkey") % 1000).cast("string"), 3).alias("COUNTYFP"),
              F.col("c_custkey").cast("string").alias("TRACTCE"),
              zfill((F.col("c_custkey") % 977).cast("string"), 5).alias("PUMA5CE"))
     .write.option("header", True).csv(root))
    return read_tract_crosswalk(spark, root)


def q_zone_lookup_read(spark: SparkSession, sf: str) -> DataFrame:
    """A zone table with unpadded codes and a lower-case zone column."""
    root = scratch_table_dir(spark, "zones")
    s = table(spark, sf, "supplier")
    (s.select(F.col("s_suppkey").alias("FIPS"), F.concat(F.lit("p"), F.col("s_nationkey").cast("string")).alias("r"))
     .write.option("header", True).csv(root))
    return files.read_zone_lookup(spark, root)


def q_sorted_csv_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Sorted CSV parts: each row with its place in the whole, from the order
    index and its place in its file."""
    out = scratch_table_dir(spark, "sorted")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    index = writers.write_sorted_parts(orders, out, ["o_orderpriority", "o_custkey"], num_parts=8)
    back = writers.read_sorted_parts(orders.schema, spark, out, name=F.col("_metadata.file_name"),
                                     block=F.col("_metadata.file_block_start"), row=F.monotonically_increasing_id())
    in_file = F.row_number().over(Window.partitionBy("name").orderBy("block", "row"))
    placed = back.withColumn("in_file", in_file).join(index.select("name", "start"), "name")
    return placed.select((F.col("start") + F.col("in_file")).alias("place"), *orders.columns)


def q_long_csv_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The long CSV form, partitioned by a column, read back by name."""
    out = scratch_table_dir(spark, "long")
    li = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    jobs.write_long_end_use(li, out, fmt="csv", partition_by=["o_orderstatus"])
    return (spark.read.option("header", True).schema("o_orderkey long, o_totalprice double, o_orderstatus string").csv(out)
            .select("o_orderkey", "o_orderstatus", "o_totalprice"))


def q_quoted_csv_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of the fully quoted CSV parts; the header, which each part
    has, once."""
    out = scratch_table_dir(spark, "quoted")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    writers.write_quoted_csv(rows, out)
    lines = spark.read.text(out).select(F.col("value").alias("line"))
    header = F.col("line") == ",".join(f'"{c}"' for c in rows.columns)
    return lines.where(~header).unionByName(lines.where(header).distinct())


def q_failed_keys_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The failed keys of a transfer, one per line."""
    out = scratch_table_dir(spark, "failed")
    m = documents_manifest(spark, sf)
    failures = table(spark, sf, "labels").where("toxic = 1").join(m, "doc_id").select("key")
    writers.write_key_list(mf.transfer_status(m, m.limit(0).select("key", "size"), failures), out)
    return spark.read.text(out).select(F.col("value").alias("key"))


def q_partial_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Partials of four chunks of events in a ledger; one chunk is run again
    with corrected values and one as it was, one is withdrawn and recorded
    anew: the merged result equals one pass over the corrected events."""
    ev = table(spark, sf, "events").select("ts", "event_type", "value", "user_id")
    chunk = F.coalesce(F.pmod("user_id", F.lit(4)).cast("string"), F.lit("none"))
    hour = ceil_to("hour", F.col("ts"), ev.schema["ts"].dataType)

    def partials(rows: DataFrame) -> DataFrame:
        return rows.groupBy("chunk", hour.alias("ts"), "event_type").agg(
            exact_sum("value", 2).alias("value"), F.count(F.lit(1)).alias("n_rows"))

    book = ChunkLedger(spark, scratch_table_dir(spark, "ledger"))
    first = ev.withColumn("chunk", chunk)
    versions = first.select("chunk", F.lit("1").alias("version")).distinct()
    book.record(partials(first), versions)
    corrected = first.withColumn("value", F.when(F.col("chunk") == "2", 2 * F.col("value")).otherwise(F.col("value")))
    now = versions.withColumn("version", F.when(F.col("chunk") == "2", F.lit("2")).otherwise(F.col("version")))
    book.withdraw(now.where("chunk = '1'").select("chunk"))
    todo = materialize(book.pending(now).unionByName(now.where("chunk = '3'")), "pending")  # 1, 2 and once more 3
    book.record(partials(corrected.join(todo, "chunk", "left_semi")), todo)
    merged = book.merged(["ts", "event_type"], ["value", "n_rows"], {"mean_value": ("value", "n_rows")}, sum_scale=2)
    return merged.withColumn("n_rows", F.col("n_rows").cast("long"))


def q_extract_replace(spark: SparkSession, sf: str) -> DataFrame:
    """An extract by nation, of which one nation is written anew with changed
    rows and one is emptied; with the row ledger's count of each folder."""
    out = scratch_table_dir(spark, "replace")
    c = table(spark, sf, "customer").withColumn("nation", zfill(F.col("c_nationkey").cast("string"), 2))
    writers.replace_partitions(c, out, ["nation"])
    changed = c.where("nation = '03'").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    writers.replace_partitions(changed, out, ["nation"], covers=[("03",), ("11",)])
    held = writers.row_ledger(spark, out, ["nation"]).select("nation", "n_rows")
    rows = files.read_parquet_tree(spark, out).select("c_custkey", "c_acctbal", "nation")
    return rows.join(held, "nation", "full_outer").select("nation", "n_rows", "c_custkey", "c_acctbal")


def q_csv_tree_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """Column types of a CSV tree with two headers, kept in an index: read
    once, then again with a file more, of which only that file is looked at."""
    root, index = scratch_table_dir(spark, "inferred"), scratch_table_dir(spark, "index")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey",
                                          (F.col("o_custkey") % 2 == 0).alias("even"))
    part = F.col("o_orderkey") % 3
    o.where(part == 0).write.option("header", True).csv(f"{root}/a")
    o.where(part == 1).select(*reversed(o.columns)).write.option("header", True).csv(f"{root}/b")
    files.read_csv_tree(spark, root, "*.csv", index=index)
    # the keys of the third part are no numbers: their column turns to text
    late = o.where(part == 2).withColumn("o_custkey", F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    late.write.option("header", True).csv(f"{root}/c")
    df = files.read_csv_tree(spark, root, "*.csv", index=index)
    return df.withColumn("types", F.lit(",".join(f"{c}:{t}" for c, t in sorted(df.dtypes))))


def q_manifest_county_version(spark: SparkSession, sf: str) -> DataFrame:
    """Selection of county objects of one version by state and county."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    county = F.element_at(F.array(*[F.lit(c) for c in (*SERIES_CODES, "x1", "")]), (F.col("doc_id") % 6 + 1).cast("int"))
    folder = F.when(county == "", F.lit("")).otherwise(F.concat(F.lit("county="), F.lower(county), F.lit("/")))
    m = d.select(F.concat(F.when(F.col("lang") == "en", "r/basic/").otherwise("r/full/"), folder, F.lit("f"),
                          F.col("doc_id").cast("string"), F.lit(".csv")).alias("key"), F.col("n_chars").alias("size"))
    by_state = mf.select_objects(m, "r/", mf.Selection(version="full", states=["ca", "TX"], county_data=True))
    by_county = mf.select_objects(m, "r/", mf.Selection(version="basic", counties=["g0100010"], county_data=True))
    return by_state.withColumn("selection", F.lit("state")).unionByName(by_county.withColumn("selection", F.lit("county")))


QUERIES = {
    "csv_tree_roundtrip": q_csv_tree_roundtrip,
    "county_series_read": q_county_series_read,
    "parquet_tree_read": q_parquet_tree_read,
    "annual_extract": q_annual_extract,
    "extract_inferred_folder": q_extract_inferred_folder,
    "county_reference_read": q_county_reference_read,
    "tract_crosswalk_read": q_tract_crosswalk_read,
    "zone_lookup_read": q_zone_lookup_read,
    "sorted_csv_sink": q_sorted_csv_sink,
    "long_csv_sink": q_long_csv_sink,
    "quoted_csv_sink": q_quoted_csv_sink,
    "failed_keys_sink": q_failed_keys_sink,
    "partial_ledger": q_partial_ledger,
    "extract_replace": q_extract_replace,
    "csv_tree_inferred": q_csv_tree_inferred,
    "manifest_county_version": q_manifest_county_version,
}

_KEY = """CASE WHEN lang = 'en' THEN 'r/basic/' ELSE 'r/full/' END
  || CASE doc_id % 6 WHEN 0 THEN 'county=g0100010/' WHEN 1 THEN 'county=g0600370/' WHEN 2 THEN 'county=g4800010/'
     WHEN 3 THEN 'county=g9900010/' WHEN 4 THEN 'county=x1/' ELSE '' END || 'f' || doc_id || '.csv'"""

ORACLE = {
    "csv_tree_roundtrip": "SELECT event_id, event_type, value FROM events",
    "county_series_read": """
SELECT strftime(ts, '%Y-%m-%d %H:00:00') AS timestamp, CAST(sum(CAST(coalesce(value, 0) AS DECIMAL(38,2))) AS DOUBLE) AS kwh,
       CASE user_id % 4 WHEN 0 THEN 'AL' WHEN 1 THEN 'CA' ELSE 'TX' END AS "State"
FROM events WHERE user_id % 4 < 3 GROUP BY 1, 3""",
    "parquet_tree_read": f"SELECT doc_id, lang, n_chars, {zf('doc_id % 7', 3)} AS puma FROM documents",
    "annual_extract": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, '07' AS state FROM customer WHERE c_nationkey = 7",
    "extract_inferred_folder": """
SELECT c_custkey, c_name, '11' AS state, '/by_state/basic/release_11' AS folder FROM customer WHERE c_nationkey = 11""",
    "county_reference_read": f"""
SELECT fips || county AS county_fips5, 'G' || fips || county || '0' AS county, t.state, n_name AS county_name
FROM (SELECT {zf('n_nationkey', 2)} AS fips, {zf('n_regionkey', 3)} AS county, n_name FROM nation) n
JOIN {values(FIPS_TO_STATE, 't(code, state)')} ON n.fips = t.code""",
    "tract_crosswalk_read": f"""
SELECT {zf('c_nationkey', 2)} || {zf('c_custkey % 1000', 3)} AS county_fips5,
       'G' || {zf('c_nationkey', 2)} || {zf('c_custkey % 977', 6)} AS puma FROM customer""",
    "zone_lookup_read": f"SELECT {zf('s_suppkey', 5)} AS county_fips5, 'p' || s_nationkey AS \"R\" FROM supplier",
    "sorted_csv_sink": """
SELECT row_number() OVER (ORDER BY o_orderpriority, o_custkey, o_orderkey, o_totalprice) AS place,
       o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders""",
    "long_csv_sink": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "quoted_csv_sink": """
SELECT '"' || c_custkey || '","' || c_name || '","' || c_nationkey || '"' AS line FROM customer
UNION ALL SELECT '"c_custkey","c_name","c_nationkey"'""",
    "partial_ledger": f"""
WITH e AS (SELECT ts, event_type, CASE WHEN user_id % 4 = 2 THEN 2 * value ELSE value END AS value FROM events)
SELECT {ceil_ts('hour', 'ts')} AS ts, event_type, {xsum('value')} AS value, count(*) AS n_rows,
       {xsum('value')} / count(*) AS mean_value
FROM e GROUP BY 1, 2""",
    "extract_replace": f"""
WITH c AS (SELECT {zf('c_nationkey', 2)} AS nation, c_custkey,
                  CASE WHEN c_nationkey = 3 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer)
SELECT nation, count(*) OVER (PARTITION BY nation) AS n_rows, c_custkey, c_acctbal FROM c WHERE nation <> '11'
UNION ALL SELECT DISTINCT nation, 0, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE) FROM c WHERE nation = '11'""",
    "csv_tree_inferred": """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_custkey % 2 = 0 AS even,
       CASE WHEN o_orderkey % 3 = 2 THEN 'c' ELSE '' END || o_custkey AS o_custkey,
       'even:boolean,o_custkey:string,o_orderkey:bigint,o_orderstatus:string,o_totalprice:double' AS types FROM orders""",
    "failed_keys_sink": """
WITH m AS (SELECT doc_id, CASE lang
      WHEN 'en' THEN 'timeseries/upgrade=' || doc_id % 3 || '/state=' || ['AL', 'CA', 'TX', 'NY'][1 + doc_id % 4] || '/' || source || '_' || doc_id || '.csv'
      WHEN 'fr' THEN 'annual/full/' || ['AL', 'CA', 'TX', 'NY'][1 + doc_id % 4] || '_upgrade' || doc_id % 3 || '_agg_' || doc_id || '.csv'
      WHEN 'de' THEN 'annual/basic/upgrade' || doc_id % 3 || '_' || doc_id || '.csv'
      ELSE 'timeseries/upgrade=' || doc_id % 3 || '/state=' || ['AL', 'CA', 'TX', 'NY'][1 + doc_id % 4] || '/' || source || '_' || doc_id || '.parquet' END AS key
  FROM documents)
SELECT m.key FROM m JOIN labels l ON l.doc_id = m.doc_id WHERE l.toxic = 1""",
    "manifest_county_version": f"""
SELECT {_KEY} AS key, n_chars AS size, 'state' AS selection FROM documents WHERE lang <> 'en' AND doc_id % 6 IN (1, 2, 5)
UNION ALL
SELECT {_KEY}, n_chars, 'county' FROM documents WHERE lang = 'en' AND doc_id % 6 = 0""",
}
