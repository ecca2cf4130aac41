"""Readers and writers on files written into a scratch folder."""

import csv
import glob
import os


from gridloom.sinks import writers
from gridloom.sources import files
from gridloom.sources.manifest import manifest_from_files
from gridloom.operators.timeseries import state_rollup


def write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)


def test_csv_tree_header_drift(spark, tmp_dir):
    write_csv(f"{tmp_dir}/a/up0-al-x.csv", ["timestamp", "in.state", "out.electricity.a.kwh"],
              [["2018-01-01 00:15:00", "AL", "1.5"]])
    write_csv(f"{tmp_dir}/b/up0-ak-x.csv", ["out.electricity.a.kwh", "timestamp", "in.state", "extra"],
              [["2.5", "2018-01-01 00:30:00", "AK", "z"]])
    df = files.read_csv_tree(spark, tmp_dir, "*.csv", {"out.electricity.a.kwh": "double"})
    got = sorted((r["in.state"], r["out.electricity.a.kwh"], r["extra"]) for r in df.collect())
    assert got == [("AK", 2.5, "z"), ("AL", 1.5, None)]


def test_county_series_and_state_rollup(spark, tmp_dir):
    col = "out.electricity.total.energy_consumption..kwh"
    for code, v in (("G0100010", 1.0), ("G0100030", 2.0), ("G9900010", 4.0)):
        write_csv(f"{tmp_dir}/upgrade=0/county={code}/up0-{code}-gap.csv", ["timestamp", col, "upgrade", "in.county"],
                  [["2018-01-01 01:00:00", v, 0, code], ["2018-01-01 02:00:00", v * 10, 0, code]])
    write_csv(f"{tmp_dir}/upgrade=0/loose/up0-x-gap.csv", ["timestamp", col], [["2018-01-01 01:00:00", 100.0]])
    series = files.read_county_series(spark, tmp_dir, col)
    res = state_rollup(series, "county", col)
    assert [tuple(r) for r in res.result.collect()] == [("2018-01-01 01:00:00", 3.0, "AL"),
                                                        ("2018-01-01 02:00:00", 30.0, "AL")]
    rej = {r.county: r.n_rows for r in res.rejected.collect()}
    assert rej == {"G9900010": 2, None: 1}


def test_zone_lookup_lowercase_and_pad(spark, tmp_dir):
    write_csv(f"{tmp_dir}/z.csv", ["FIPS", "r"], [["1001", "p1"], ["06001", "p9"]])
    z = files.read_zone_lookup(spark, f"{tmp_dir}/z.csv")
    assert sorted(tuple(r) for r in z.collect()) == [("01001", "p1"), ("06001", "p9")]


def test_parquet_tree_keeps_codes_as_text(spark, tmp_dir):
    df = spark.createDataFrame([(1, "01001", "AL"), (2, "06001", "CA")], "id int, fips string, state string")
    df.write.partitionBy("state", "fips").parquet(f"{tmp_dir}/tree")
    with open(f"{tmp_dir}/tree/README.txt", "w") as fh:
        fh.write("not parquet")
    got = files.read_parquet_tree(spark, f"{tmp_dir}/tree", state="CA")
    assert [(r.id, r.fips) for r in got.collect()] == [(2, "06001")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_sinks(spark, tmp_dir):
    df = spark.createDataFrame([("2018-01-01 02:00", 2.0, "CT"), ("2018-01-01 01:00", 1.0, "AL"), (None, None, "AK")],
                               "timestamp string, kwh double, State string")
    writers.write_sorted_csv(df, f"{tmp_dir}/sorted", ["State", "timestamp"])
    out = glob.glob(f"{tmp_dir}/sorted/*.csv")
    assert len(out) == 1
    lines = open(out[0]).read().splitlines()
    assert lines[0] == "timestamp,kwh,State" and lines[1].endswith(",AK") and lines[3].endswith(",CT")
    writers.write_quoted_csv(df, f"{tmp_dir}/quoted")
    q = open(glob.glob(f"{tmp_dir}/quoted/*.csv")[0]).read().splitlines()
    assert q[0] == '"timestamp","kwh","State"' and '"",' in "".join(q)
    n = writers.append_parts([df, df.select("timestamp", "kwh", "State")], f"{tmp_dir}/appended")
    assert n == 6


def test_normalise_for_sink(spark):
    df = spark.createDataFrame([(1, float("nan"), [1.0, 2.0])], "a tinyint, b float, c array<float>")
    out = writers.normalise_for_sink(df)
    assert [f.dataType.typeName() for f in out.schema.fields] == ["integer", "double", "string"]
    r = out.collect()[0]
    assert r.b is None and r.c == "[1.0,2.0]"


def test_manifest_from_files(spark, tmp_dir):
    write_csv(f"{tmp_dir}/m/upgrade=0/state=AL/a.csv", ["x"], [["1"]])
    m = manifest_from_files(spark, f"{tmp_dir}/m")
    got = [(r.key, r.size) for r in m.collect()]
    assert got[0][0] == "upgrade=0/state=AL/a.csv" and got[0][1] > 0


def test_csv_tree_types_and_null_tokens(spark, tmp_dir):
    write_csv(f"{tmp_dir}/t/a.csv", ["id", "x", "flag", "name", "empty", "mixed"],
              [["1", "1.5", "True", "NA", "", "3"], ["2", "NaN", "False", "b", "None", "z"],
               ["null", "2", "", "c", "NA", "4"]])
    df = files.read_csv_tree(spark, f"{tmp_dir}/t")
    types = dict(df.dtypes)
    assert types == {"id": "bigint", "x": "double", "flag": "boolean", "name": "string",
                     "empty": "double", "mixed": "string"}
    rows = sorted(df.collect(), key=lambda r: (r.id is None, r.id or 0))
    assert [r.id for r in rows] == [1, 2, None]
    assert [r.x for r in rows] == [1.5, None, 2.0]
    assert [r.flag for r in rows] == [True, False, None]
    assert [r.name for r in rows] == [None, "b", "c"]


def test_distinct_partition_values(spark):
    paths = spark.createDataFrame([("r/upgrade=10/state=AL/a.csv",), ("r/upgrade=2/state=AL/b.csv",),
                                   ("r/upgrade=2/x.csv",), ("r/upgrade=baseline/y.csv",), ("r/none/z.csv",)], "path string")
    got = [r.upgrade for r in files.distinct_partition_values(paths, "upgrade").orderBy("rank").collect()]
    assert got == ["2", "10", "baseline"]
