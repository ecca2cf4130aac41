"""The user-visible jobs end to end on small hand-made files."""

import csv
import datetime as dt
import glob
import os


from gridloom.operators import manifest as mf
from gridloom.plans import jobs


def write(path, header, rows, sep=","):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh, delimiter=sep)
        w.writerow(header)
        w.writerows(rows)


def test_long_end_use_job(spark, tmp_dir):
    hdr = ["timestamp", "in.state", "in.geometry_building_type_recs", "upgrade", "units_represented",
           "in.sqft", "out.electricity.cooling.energy_consumption.kwh", "out.natural_gas.heating.energy_consumption.kwh"]
    # in.sqft is numeric: neither key nor measure, so the rollup drops it
    rows = [["2018-01-01 00:15:00", "AL", bt, 0, 10, 100 + i, 1.0, 9.0] for i, bt in enumerate(("Office", "School"))]
    rows += [["2018-01-01 00:30:00", "AL", bt, 0, 20, 300 + i, 2.0, "NA"] for i, bt in enumerate(("Office", "School"))]
    write(f"{tmp_dir}/upgrade=0/state=AL/up0-al-a.csv", hdr, rows)
    df = jobs.long_end_use_table(spark, tmp_dir)
    assert "in.sqft" not in df.columns
    got = [r.asDict() for r in df.collect()]
    assert len(got) == 1
    r = got[0]
    assert r["kWh"] == 6.0 and r["units_represented"] == 30.0 and r["end_use"] == "cooling"
    assert r["timestamp"] == dt.datetime(2018, 1, 1, 1, 0)
    jobs.write_long_end_use(df, f"{tmp_dir}/out", fmt="csv")
    assert glob.glob(f"{tmp_dir}/out/*.csv")


def test_gap_by_state_job(spark, tmp_dir):
    col = jobs.GAP_ENERGY_COL
    for code, v in (("G0100010", 1.0), ("G0200130", 2.0)):
        write(f"{tmp_dir}/in/upgrade=0/county={code}/up0-{code}-gap.csv", ["timestamp", col, "upgrade", "in.county"],
              [["2018-01-01 01:00:00", v, 0, code]])
    res = jobs.gap_by_state(spark, f"{tmp_dir}/in", out_csv=f"{tmp_dir}/out", states=["AK"])
    assert [tuple(r) for r in res.collect()] == [("2018-01-01 01:00:00", 2.0, "AK")]
    lines = open(glob.glob(f"{tmp_dir}/out/*.csv")[0]).read().splitlines()
    assert lines == [f"timestamp,{col},State", "2018-01-01 01:00:00,2.0,AK"]


def test_county_groups_job(spark, tmp_dir):
    samples = [(1, "G0100010", "AL", "G01000100", 1.0), (2, "G0100030", "AL", "G01000100", 1.0),
               (3, "G0100050", "AL", "G01000200", 1.0), (4, "AK, Bethel Census Area", "AK", "G02000400", 1.0)]
    spark.createDataFrame(samples, "bldg_id long, `in.county` string, `in.state` string, `in.puma` string, weight double") \
        .write.parquet(f"{tmp_dir}/samples")
    write(f"{tmp_dir}/ref.txt", ["STATE", "STATEFP", "COUNTYFP", "COUNTYNAME"],
          [["AL", "01", "001", "A County"], ["AL", "01", "003", "B County"], ["AL", "01", "005", "C County"],
           ["AL", "01", "007", "D County"], ["AK", "02", "050", "Bethel Census Area"], ["PR", "72", "001", "X"]], sep="|")
    write(f"{tmp_dir}/tract.csv", ["STATEFP", "COUNTYFP", "TRACTCE", "PUMA5CE"],
          [["01", "007", "1", "100"], ["01", "007", "2", "100"], ["01", "007", "3", "200"]])
    write(f"{tmp_dir}/zones.csv", ["FIPS", "r"], [["1001", "p1"], ["1003", "p2"], ["1005", "p1"], ["1007", "p1"]])
    res = jobs.county_groups(spark, f"{tmp_dir}/samples", f"{tmp_dir}/ref.txt", f"{tmp_dir}/tract.csv",
                             f"{tmp_dir}/zones.csv", out_dir=f"{tmp_dir}/out")
    rows = {r.bldgid: r for r in res.rows.collect()}
    # counties 001 and 003 share area 100 -> group 0, but their zones differ -> split
    assert rows["1"].county_groups == "county_group_0" and rows["2"].county_groups == "county_group_1"
    assert rows["3"].county_groups == "independent_county_G0100050"
    assert rows["4"].county_fips5 == "02050" and rows["4"].R is None
    dummy = rows["dummy_01007"]
    assert dummy.puma == "G01000100" and dummy.weight == 0.0 and dummy.county_name == "D County"
    assert dummy.county_groups == "county_group_0" and dummy.R == "p1"
    assert len(rows) == 5
    assert glob.glob(f"{tmp_dir}/out/county_group_mapping/*.csv")


def test_annual_extract_and_selection(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2.5, "AL"), (2, float("nan"), "CA")], "id int, v float, state string")
    df.write.partitionBy("state").parquet(f"{tmp_dir}/tree")
    out, path = jobs.annual_extract(spark, f"{tmp_dir}/tree", f"{tmp_dir}/extract", state="CA")
    assert [(r.id, r.v) for r in out.collect()] == [(2, None)] and path == f"{tmp_dir}/extract"
    _, default = jobs.annual_extract(spark, f"{tmp_dir}/tree", state="CA", write=False)
    assert default == f"{tmp_dir}/tree/full/tree_CA"
    listing = spark.createDataFrame([("p/upgrade=0/state=AL/a.csv", 5), ("p/upgrade=1/state=AL/b.csv", 7)],
                                    "key string, size long")
    fails = spark.createDataFrame([("p/upgrade=0/state=AL/a.csv",)], "key string")
    sel, tot, rep = jobs.select_and_report(listing, "p/", mf.Selection(upgrades=["0"]), failures=fails,
                                           failed_keys_out=f"{tmp_dir}/failed")
    assert tot.collect()[0].n_files == 1
    assert {r.status: r.n_files for r in rep.collect()} == {"error": 1}
    assert open(glob.glob(f"{tmp_dir}/failed/*.txt")[0]).read().strip() == "p/upgrade=0/state=AL/a.csv"


def test_output_layout():
    from gridloom.sinks.layout import extract_name, infer_output_folder
    assert infer_output_folder("/d/agg", "/d/agg/by_state/basic/state=AL/a.parquet") == "/d/agg/by_state/basic"
    assert infer_output_folder("/d/by_state_and_puma/full", "/d/by_state_and_puma/full/x.parquet") == \
        "/d/by_state_and_puma/full"
    assert infer_output_folder("/d/by_state", "/d/by_state/state=AL/a.parquet") == "/d/by_state/full"
    assert infer_output_folder("/d/x", None) == "/d/x/full"
    assert extract_name("/d/by_state", "AL") == "by_state_AL"


def test_views(spark):
    series = spark.createDataFrame([("2018-01-01 01:00:00", 1e6, "AL"), ("2018-01-01 02:00:00", 3e6, "AL"),
                                    ("2018-02-01 01:00:00", 2e6, "AK")],
                                   f"timestamp string, `{jobs.GAP_ENERGY_COL}` double, State string")
    v = jobs.state_series_views(series)
    share = {(r.state, r.month, r.hour): r.share for r in v["share_of_state_total"].collect()}
    assert share == {("AL", 1, 1): 0.25, ("AL", 1, 2): 0.75, ("AK", 2, 1): 1.0}
    assert v["gwh_by_hour"].count() == 3
    mapping = spark.createDataFrame([("AL", "G0100010", "A", "01001", "p1", "county_group_12"),
                                     ("AL", "G0100030", "B", "01003", "p1", "county_group_12"),
                                     ("AL", "G0100050", "C", "01005", "p2", "independent_county_G0100050")],
                                    "state string, county string, county_name string, county_fips5 string, R string, county_groups string")
    bounds = spark.createDataFrame([("01001",), ("01003",), ("01999",)], "GEOID string")
    mv = jobs.mapping_views(mapping, bounds)
    assert {r.county_groups: r.group_label for r in mv["labelled"].collect()} == {
        "county_group_12": "12", "independent_county_G0100050": "i"}
    assert {r.county_groups: r.members for r in mv["members"].collect()}["county_group_12"] == "01001,01003"
    audit = {(r.county_fips5, r.GEOID) for r in mv["key_audit"].collect()}
    assert audit == {("01001", "01001"), ("01003", "01003"), ("01005", None), (None, "01999")}
