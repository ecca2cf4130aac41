"""Nothing is rounded, dropped or turned into null without a word."""

import csv
import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from gridloom.functions.codes import county_code_to_state, county_fips5
from gridloom.functions.columns import find_building_type_column
from gridloom.functions.scalars import exact_sum
from gridloom.functions.timefns import ceil_to, trunc_to
from gridloom.operators import grouping as grp
from gridloom.operators.joins import lookup_join
from gridloom.operators.ranking import pick_per_group
from gridloom.operators.timeseries import share_of_total
from gridloom.plans import jobs
from gridloom.session import ensure_checkpoint_dir
from gridloom.sinks.layout import extract_name, infer_output_folder
from gridloom.sources import files
from gridloom.streaming.hourly import compact, current_result, run_available


def put(path, rows, opener=open):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with opener(path, "wt", newline="") as fh:
        csv.writer(fh).writerows(rows)


# ------------------------------------------------------------------------ sums

def total(spark, values, scale):
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    return rows.agg(exact_sum("v", scale)).first()[0]


def test_sums_keep_every_decimal(spark):
    assert total(spark, [0.004] * 1000, 3) == 4.0
    assert total(spark, [0.004] * 1000, None) == pytest.approx(4.0)
    assert total(spark, [0.1, 0.2, float("nan"), None], 2) == 0.3
    assert total(spark, [float("nan"), None], 2) == 0.0 == total(spark, [None], None)
    assert total(spark, [123456789012.34, 0.07, -0.01], 2) == 123456789012.40
    with pytest.raises(Exception, match="more than 2 decimals"):
        total(spark, [1.0, 0.004], 2)


# ------------------------------------------------------------------------- CSV

def test_a_value_of_the_wrong_type_fails(spark, tmp_dir):
    put(f"{tmp_dir}/a.csv", [["code", "v"]] + [[i, 1.5] for i in range(2000)] + [["A7", 2.5]])
    inferred = files.read_csv_tree(spark, tmp_dir)
    assert dict(inferred.dtypes) == {"code": "string", "v": "double"}
    assert inferred.where("code = 'A7'").count() == 1
    with pytest.raises(Exception, match="column code: not a bigint: A7"):
        files.read_csv_tree(spark, tmp_dir, types={"code": "bigint"}).collect()


def test_quoted_newlines_compression_and_malformed_rows(spark, tmp_dir):
    put(f"{tmp_dir}/x/a.csv", [["id", "note"], ["1", "two\nlines"], ["2", 'say ""hi""']])
    put(f"{tmp_dir}/x/b.csv.gz", [["note", "id"], ["plain", "3"]], gzip.open)
    got = {r["id"]: r["note"] for r in files.read_csv_tree(spark, f"{tmp_dir}/x", "*.csv*", multi_line=True).collect()}
    assert got[1] == "two\nlines" and got[3] == "plain" and len(got) == 3
    put(f"{tmp_dir}/y/a.csv", [["id", "note"], ["1", "x"], ["2"]])
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_csv_tree(spark, f"{tmp_dir}/y").collect()


def test_county_series_by_header_name(spark, tmp_dir):
    put(f"{tmp_dir}/county=G0100010/a-gap.csv", [["timestamp", "kwh", "z"], ["2018-01-01 01:00:00", "2.5", "9"]])
    put(f"{tmp_dir}/county=G0100030/b-gap.csv", [["z", "kwh", "timestamp"], ["9", "4.5", "2018-01-01 01:00:00"]])
    got = {(r["county"], r["timestamp"], r["kwh"]) for r in files.read_county_series(spark, tmp_dir, "kwh").collect()}
    assert got == {("G0100010", "2018-01-01 01:00:00", 2.5), ("G0100030", "2018-01-01 01:00:00", 4.5)}


def test_parquet_tree_touches_no_session_setting(spark, tmp_dir):
    spark.createDataFrame([(1, "01"), (2, "02")], "v int, state string").write.partitionBy("state").parquet(f"{tmp_dir}/t")
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    df = files.read_parquet_tree(spark, f"{tmp_dir}/t", state="02")
    assert spark.conf.get(key) == before and [tuple(r) for r in df.collect()] == [(2, "02")]
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(state" in scan


# ------------------------------------------------------------------------ time

@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata", "UTC"])
def test_labels_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    texts = ["2018-01-01 01:15:00", "2018-01-01 01:00:00", "2018-03-11 02:30:00", "2018-11-04 01:45:00", "2018-12-31 23:15:00"]
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
        kind = df.schema["ts"].dataType
        got = [[str(x) for x in r] for r in df.select(
            ceil_to("hour", "ts", kind), trunc_to("hour", "ts", kind), ceil_to("day", "ts", kind)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [["2018-01-01 02:00:00", "2018-01-01 01:00:00", "2018-01-02 00:00:00"],
                   ["2018-01-01 01:00:00", "2018-01-01 01:00:00", "2018-01-02 00:00:00"],
                   ["2018-03-11 03:00:00", "2018-03-11 02:00:00", "2018-03-12 00:00:00"],
                   ["2018-11-04 02:00:00", "2018-11-04 01:00:00", "2018-11-05 00:00:00"],
                   ["2019-01-01 00:00:00", "2018-12-31 23:00:00", "2019-01-01 00:00:00"]]


# ------------------------------------------------------------ nulls in rankings

def test_a_null_measure_ranks_last(spark):
    df = spark.createDataFrame([("g", "a", None), ("g", "b", 9.0), ("g", "c", 9.0), ("h", "d", None)], "g string, v string, w double")
    got = {r["g"]: r["v"] for r in pick_per_group(df, ["g"], ["v"], desc=["w"], asc=["v"]).collect()}
    assert got == {"g": "b", "h": "d"}
    samples = spark.createDataFrame([(1, "c1", "p1", None), (2, "c1", "p2", 9.0), (3, "c2", "p1", 1.0), (4, "c2", "p2", 1.0)],
                                    "bldgid int, county string, puma string, weight double")
    chosen = {r["county"]: r["puma"] for r in grp.dominant_area(grp.pair_weights(samples)).collect()}
    assert chosen == {"c1": "p2", "c2": "p1"}


def test_share_of_a_null_partition(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "k string, v double")
    assert sorted((str(r["k"]), r["share"]) for r in share_of_total(df, "v", ["k"]).collect()) == [
        ("None", 0.25), ("None", 0.75), ("a", 1.0)]


def test_duplicate_lookup_keys_fail_the_job(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="duplicate keys"):
        lookup_join(left, twice, "k", check_unique=True).collect()
    once = lookup_join(left, twice.limit(1), "k", check_unique=True)
    assert {(r["k"], r["v"]) for r in once.collect()} == {(1, "a"), (2, None)}


# -------------------------------------------------------------- folders, layout

def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session)


def test_layout_of_object_store_paths():
    assert infer_output_folder("s3a://bucket/x/", None) == "s3a://bucket/x/full"
    assert infer_output_folder("s3a://bucket/x", "s3a://bucket/x/by_state/basic/state=AL/a.parquet") == "s3a://bucket/x/by_state/basic"
    assert infer_output_folder("/d/x", "file:///d/x/national/a.parquet") == "/d/x/national/full"
    assert infer_output_folder("hdfs://h:9/by_state/full", "hdfs://h:9/by_state/full/a.parquet") == "hdfs://h:9/by_state/full"
    assert extract_name("s3a://bucket/by_state/", "AL") == "by_state_AL"


def test_building_type_resolution_order():
    assert find_building_type_column(["a_building_type", "in.comstock_building_type"]) == "in.comstock_building_type"
    assert find_building_type_column(["x", "y"]) is None


# Codes and what they stand for, written out by hand.
COUNTY_CODES = [
    ("G0100010", "AL", "01001"), ("G0200130", "AK", "02013"), ("G0400130", "AZ", "04013"), ("G0600370", "CA", "06037"),
    ("G1100010", "DC", "11001"), ("G1500030", "HI", "15003"), ("G3600610", "NY", "36061"), ("G4804530", "TX", "48453"),
    ("G5600450", "WY", "56045"), ("G9900010", None, "99001"), ("AK, Bethel Census Area", None, "02050"),
    ("HI, Maui County", None, "15009"), ("AK, Nowhere", None, None), ("nonsense", None, None),
]


def test_county_codes_by_hand(spark):
    df = spark.createDataFrame([(c,) for c, *_ in COUNTY_CODES], "c string")
    got = [tuple(r) for r in df.select("c", county_code_to_state("c"), county_fips5("c")).collect()]
    assert got == COUNTY_CODES


# ---------------------------------------------------------------- whole grouping

def test_grouping_chain_to_the_views(spark):
    rows = [("dummy_9", "c1", "s1", "p1", 1.0), ("2", "c2", "s1", "p1", 1.0), ("3", "c3", "s2", "p2", 1.0)]
    samples = spark.createDataFrame([(*r, f"0000{r[1][1]}", f"County {r[1]}") for r in rows],
                                    "bldgid string, county string, state string, puma string, weight double, "
                                    "county_fips5 string, county_name string")
    reference = spark.createDataFrame([(f"0000{i}", f"c{i}", "s1", f"County c{i}") for i in range(1, 5)],
                                      "county_fips5 string, county string, state string, county_name string")
    crosswalk = spark.createDataFrame([("00004", "p1")], "county_fips5 string, puma string")
    zones = spark.createDataFrame([("00001", "z1"), ("00002", "z1"), ("00003", "z2"), ("00004", "z9")], "county_fips5 string, R string")
    res = grp.build_county_groups(samples, zones=zones, reference=reference, crosswalk=crosswalk)
    assert res.rows.columns == list(grp.ROW_COLUMNS) and res.mapping.columns == list(grp.MAPPING_COLUMNS)
    # a real sample may be called dummy_9: it is no placeholder
    assert res.rows.count() == 4 and res.mapping.count() == 4
    ids = sorted(r["bldgid"] for r in res.rows.collect())
    assert ids == ["2", "3", "dummy_00004", "dummy_9"]
    assert res.violations.count() == 0
    views = jobs.mapping_views(res.mapping, spark.createDataFrame([("00001",)], "GEOID string"))
    assert all(v.count() > 0 for v in views.values())
    checks = jobs.group_diagnostics(res.rows)
    assert {r["state"]: r["n_rows"] for r in checks["state_validity"].collect()} == {"s1": 3, "s2": 1}
    assert sum(r["n_rows"] for r in checks["by_kind"].collect()) == 4


# ---------------------------------------------------------------------- stream

def test_stream_restart_and_compaction(spark, tmp_dir):
    schema = "ts timestamp_ntz, event_type string, value double"
    kind = spark.createDataFrame([], schema).schema
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    t = dt.datetime(2024, 1, 1, 0, 10)

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        run_available(spark, src, kind, out, ck, "ts", ["event_type"], "value", sum_scale=3)

    def now():
        return {(r["ts"].hour, r["event_type"]): (r["sum_value"], r["n_rows"])
                for r in current_result(spark, out, "ts", ["event_type"], "value").collect()}

    arrive([(t, "a", 0.004), (t, "b", 1.0)])
    arrive([(t, "a", 0.004)])  # restarted from the checkpoint
    assert now() == {(1, "a"): (0.008, 2), (1, "b"): (1.0, 1)}
    last = compact(spark, out, "ts", ["event_type"])
    assert last is not None and now() == {(1, "a"): (0.008, 2), (1, "b"): (1.0, 1)}
    arrive([(t + dt.timedelta(hours=1), "a", 5.0), (t, "b", 1.0)])
    assert now() == {(1, "a"): (0.008, 2), (1, "b"): (2.0, 2), (2, "a"): (5.0, 1)}
    assert compact(spark, out, "ts", ["event_type"]) > last and len(now()) == 3
