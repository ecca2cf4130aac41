"""Melt and rollups on hand-made wide tables, checked against pandas."""

import datetime as dt
import warnings

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.operators.reshape import melt_end_uses
from gridloom.operators.timeseries import (
    long_end_use, melt_rollup, merge_partials, rollup_to_period, share_of_total, state_rollup,
)

E1 = "out.electricity.cooling.energy_consumption.kwh"
E2 = "out.electricity.heating.energy_consumption..kwh"
E3 = "out.electricity.cooling.energy_savings.kwh"
G1 = "out.natural_gas.heating.energy_consumption.kwh"
BT = "in.geometry_building_type_recs"


def wide(spark):
    t0 = dt.datetime(2018, 1, 1, 0, 15)
    rows = []
    for i in range(8):
        ts = t0 + dt.timedelta(minutes=15 * i)
        for bt in ("Office", "School"):
            rows.append((ts, "AL", bt, 0, 10.0 + i, float(i), None if i == 3 else 2.0 * i, 99.0, 5.0, 100.0 + i))
    rows.append((t0, None, "Office", 0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0))  # null key: dropped
    schema = (f"timestamp timestamp_ntz, `in.state` string, `{BT}` string, upgrade int, `{E1}` double, "
              f"`{E2}` double, `{E3}` double, `{G1}` double, units_represented double, floor_area_represented double")
    return spark.createDataFrame(rows, schema)


def test_melt_shape_labels_nulls(spark):
    df = wide(spark)
    long = melt_end_uses(df)
    assert set(long.columns) == {"timestamp", "in.state", BT, "upgrade", "units_represented",
                                 "floor_area_represented", "end_use", "kWh"}
    assert long.count() == df.count() * 2          # rows x value columns
    assert {r.end_use for r in long.select("end_use").distinct().collect()} == {"cooling", "heating"}
    assert long.where(F.col("kWh").isNull()).count() == 0
    with_null = spark.createDataFrame([(1, None)], f"id int, `{E1}` double")
    assert melt_end_uses(with_null).where(F.col("kWh").isNull()).count() == 1


def test_melt_allowlist_and_empty(spark):
    df = wide(spark)
    assert {r.end_use for r in melt_end_uses(df, end_uses=[" HEATING "]).select("end_use").distinct().collect()} == {"heating"}
    assert melt_end_uses(df, end_uses=[]).count() == df.count() * 2
    ids_only = df.select("timestamp", "`in.state`")
    empty = melt_end_uses(ids_only)
    assert empty.count() == 0 and empty.columns == ["timestamp", "in.state", "end_use", "kWh"]


def test_melt_duplicate_labels_warn(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0)], f"id int, `{E1}` double, `out.electricity.cooling.peak.kwh` double")
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        melt_end_uses(df)
    assert any("share end use" in str(x.message) for x in w)


def test_hourly_two_stage_against_pandas(spark):
    long = melt_end_uses(wide(spark))
    got = long_end_use(long, unit="hour").toPandas()
    pdf = long.toPandas().dropna(subset=["in.state"])
    pdf["timestamp"] = pdf["timestamp"].dt.ceil("h")
    keys1 = ["timestamp", "in.state", BT, "end_use", "upgrade"]
    s1 = pdf.groupby(keys1, as_index=False).agg({"kWh": "sum", "units_represented": "mean",
                                                 "floor_area_represented": "mean"})
    s2 = s1.groupby(["timestamp", "in.state", "end_use", "upgrade"], as_index=False).agg(
        {"kWh": "sum", "units_represented": "sum", "floor_area_represented": "sum"})
    key = ["timestamp", "in.state", "end_use", "upgrade"]
    a = got.sort_values(key).reset_index(drop=True)[key + ["kWh", "units_represented", "floor_area_represented"]]
    b = s2.sort_values(key).reset_index(drop=True)[key + ["kWh", "units_represented", "floor_area_represented"]]
    pd.testing.assert_frame_equal(a, b, check_dtype=False)
    # hour-ending: 00:15..01:00 -> 01:00
    assert got["timestamp"].min() == pd.Timestamp("2018-01-01 01:00")
    # totals preserved
    assert abs(got["kWh"].sum() - pdf["kWh"].sum()) < 1e-9


def test_all_null_sum_is_zero_and_no_measure_passthrough(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 1, 1, 0, 15), "a", None), (dt.datetime(2018, 1, 1, 0, 30), "a", None)],
                               "timestamp timestamp_ntz, k string, x_kwh double")
    out = rollup_to_period(df).collect()
    assert len(out) == 1 and out[0].x_kwh == 0.0
    nomeasure = spark.createDataFrame([(dt.datetime(2018, 1, 1, 0, 15), "a")], "timestamp timestamp_ntz, k string")
    assert rollup_to_period(nomeasure).count() == 1
    nots = spark.createDataFrame([("a", 1.0)], "k string, x_kwh double")
    assert rollup_to_period(nots).collect() == nots.collect()


def test_partial_merge_equals_single_pass(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 3.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    parts = [df.where(F.col("v") < 2.5), df.where(F.col("v") >= 2.5)]
    partial = [p.groupBy("k").agg(F.sum("v").alias("v"), F.count("*").alias("n")) for p in parts]
    merged = merge_partials(partial[0].unionByName(partial[1]), ["k"], ["v", "n"], means={"mean": ("v", "n")})
    got = {r.k: (r.v, r.n, r.mean) for r in merged.collect()}
    assert got == {"a": (7.0, 3, 7.0 / 3), "b": (3.0, 1, 3.0)}


def test_state_rollup_and_rejects(spark):
    rows = [("2018-01-01 01:00", 1.0, "G0100010"), ("2018-01-01 01:00", 2.0, "G0100030"),
            ("2018-01-01 01:00", 5.0, "G0900010"), ("2018-01-01 01:00", 7.0, "G9900010"),
            ("2018-01-01 01:00", 7.0, "X0100010")]
    df = spark.createDataFrame(rows, "timestamp string, kwh double, county string")
    res = state_rollup(df, "county", "kwh", states=["al", "CT"])
    assert [tuple(r) for r in res.result.collect()] == [("2018-01-01 01:00", 3.0, "AL"),
                                                        ("2018-01-01 01:00", 5.0, "CT")]
    assert {r.county: r.n_rows for r in res.rejected.collect()} == {"G9900010": 1, "X0100010": 1}


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 3.0), ("b", 1, 2.0)], "k string, h int, v double")
    got = {(r.k, r.h): r.share for r in share_of_total(df, "v", ["k"]).collect()}
    assert got == {("a", 1): 0.25, ("a", 2): 0.75, ("b", 1): 1.0}


@pytest.mark.parametrize("by_bt", [False, True])
def test_melt_rollup_equals_melt_then_rollup(spark, by_bt):
    df = wide(spark)
    dup = df.withColumn("out.electricity.cooling.peak_demand.kwh", F.col(f"`{E1}`") * 2)
    for frame in (df, dup):
        a = long_end_use(melt_end_uses(frame), unit="hour", by_building_type=by_bt)
        b = melt_rollup(frame, unit="hour", by_building_type=by_bt)
        cols = sorted(a.columns)
        assert sorted(b.columns) == cols
        rows = lambda d: sorted(tuple(r[c] for c in cols) for r in d.collect())
        assert rows(a) == rows(b)
    assert melt_rollup(df, end_uses=["heating"]).select("end_use").distinct().collect()[0][0] == "heating"
    assert melt_rollup(df.select("timestamp", "`in.state`")).count() == 0
