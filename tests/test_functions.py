"""Column-level functions on hand-made rows (null, pad, code and time rules)."""

import datetime as dt

from pyspark.sql import functions as F

from gridloom.functions import codes
from gridloom.functions.columns import classify_wide, end_use_label, find_building_type_column
from gridloom.functions.scalars import format_bytes, numeric_then_lexical, rstrip_chars
from gridloom.functions.timefns import ceil_to


def test_hour_ending_and_year_spill(spark):
    rows = [(dt.datetime(2018, 1, 1, 0, 15),), (dt.datetime(2018, 1, 1, 0, 30),),
            (dt.datetime(2018, 1, 1, 0, 45),), (dt.datetime(2018, 1, 1, 1, 0),),
            (dt.datetime(2018, 12, 31, 23, 15),), (dt.datetime(2018, 12, 31, 23, 45),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    out = [r[0] for r in df.select(ceil_to("hour", F.col("ts"), df.schema["ts"].dataType)).collect()]
    assert out[:4] == [dt.datetime(2018, 1, 1, 1, 0)] * 4
    assert out[4:] == [dt.datetime(2019, 1, 1, 0, 0)] * 2
    assert df.select(ceil_to("hour", F.col("ts"), df.schema["ts"].dataType).alias("h")).schema["h"].dataType \
        == df.schema["ts"].dataType


def test_zfill_never_truncates(spark):
    df = spark.createDataFrame([("1001",), ("123456",), (None,)], "s string")
    assert [r[0] for r in df.select(codes.zfill("s", 5)).collect()] == ["01001", "123456", None]


def test_county_codes(spark):
    vals = ["G0900010", "AK, Bethel Census Area", "HI, Maui County", "XYZ", None, "G01000100"]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    got = [r[0] for r in df.select(codes.county_fips5(F.col("c"))).collect()]
    assert got == ["09001", "02050", "15009", None, None, None]
    st = [r[0] for r in df.select(codes.county_code_to_state(F.col("c"))).collect()]
    assert st == ["CT", None, None, None, None, "AL"]


def test_extract_or_null(spark):
    df = spark.createDataFrame([("G0100010",), ("nope",)], "c string")
    got = [r[0] for r in df.select(codes.extract_or_null("c", codes.GISJOIN_COUNTY_PATTERN, 1)).collect()]
    assert got == ["01", None]


def test_end_use_labels():
    assert end_use_label("out.electricity.cooling.energy_consumption.kwh") == "cooling"
    assert end_use_label("out.electricity.cooling.energy_consumption..kwh") == "cooling"
    assert end_use_label("out.electricity.fans.kwh") == "fans"
    assert end_use_label("out.electricity.kwh") == "out.electricity.kwh"


def test_classifier():
    cols = ["timestamp", "in.state", "out.electricity.cooling.energy_consumption.kwh",
            "out.electricity.cooling.energy_savings.kwh", "out.natural_gas.heating.kwh", "units_represented"]
    lay = classify_wide(cols)
    assert lay.values == ["out.electricity.cooling.energy_consumption.kwh"]
    assert lay.excluded == ["out.electricity.cooling.energy_savings.kwh"]
    assert lay.dropped == ["out.natural_gas.heating.kwh"]
    assert lay.ids == ["timestamp", "in.state", "units_represented"]
    assert find_building_type_column(["x_building_type", "in.geometry_building_type_recs"]) == "in.geometry_building_type_recs"
    assert find_building_type_column(["my_building_type_v2"]) == "my_building_type_v2"


# sizes and their texts, worked out by hand
SIZE_TEXTS = {
    0: "   0.0 B", 1: "   1.0 B", 999: " 999.0 B", 1023: "1023.0 B",
    1024: "   1.0 KB", 1280: "   1.2 KB",        # 1.25: half to even
    1331: "   1.3 KB",                            # 1.2998
    1408: "   1.4 KB",                            # 1.375
    1536: "   1.5 KB", 1587: "   1.5 KB",        # 1.5498
    1588: "   1.6 KB",                            # 1.5508
    1792: "   1.8 KB",                            # 1.75: half to even
    10 ** 6: " 976.6 KB",                         # 976.5625
    1024 ** 2 - 1: "1024.0 KB", 1024 ** 2: "   1.0 MB",
    5 * 1024 ** 3 + 123: "   5.0 GB", 3 * 1024 ** 4: "   3.0 TB",
    7 * 1024 ** 5 + 5: "   7.0 PB", 2 * 1024 ** 6: "2048.0 PB", 2 ** 62: "4096.0 PB",
}


def test_format_bytes(spark):
    df = spark.createDataFrame([(v,) for v in SIZE_TEXTS], "b long")
    assert {r[0]: r[1] for r in df.select("b", format_bytes("b")).collect()} == SIZE_TEXTS


def test_rstrip_and_numeric_sort(spark):
    df = spark.createDataFrame([("1200",), ("10",), ("9",), ("b",), ("a",), ("100",)], "s string")
    assert sorted(r[0] for r in df.select(rstrip_chars("s", "0")).collect()) == ["1", "1", "12", "9", "a", "b"]
    ordered = [r[0] for r in df.orderBy(*numeric_then_lexical("s")).collect()]
    assert ordered == ["9", "10", "100", "1200", "a", "b"]


def test_exact_sum_is_partition_invariant(spark):
    import random

    from gridloom.functions.scalars import exact_sum

    rng = random.Random(5)
    vals = [(round(rng.uniform(-1e6, 1e6), 2),) for _ in range(5000)]
    df = spark.createDataFrame(vals, "v double")
    results = {df.repartition(n).agg(exact_sum("v", 2).alias("s")).collect()[0].s for n in (1, 3, 7, 16)}
    assert len(results) == 1
    from decimal import Decimal
    assert results.pop() == float(sum(Decimal(str(v[0])) for v in vals))
