"""Object selection rules on a hand-made listing."""

import pytest

from gridloom.operators import manifest as mf
from gridloom.operators.sets import last_per_key

KEYS = [
    ("rel/timeseries/upgrade=0/state=AL/up0-al-office.csv", 10),
    ("rel/timeseries/upgrade=1/state=AL/up1-al-office.csv", 11),
    ("rel/timeseries/upgrade=0/state=CA/up0-ca-office.csv", 12),
    ("rel/timeseries/upgrade=0/state=CA/up0-ca-office.parquet", 13),
    ("rel/full/AL_upgrade0_agg.parquet", 20),
    ("rel/full/AL_upgrade10_agg.parquet", 21),
    ("rel/basic/CA_upgrade0_agg.csv", 22),
    ("rel/full/upgrade0.parquet", 23),
    ("rel/full/notes.parquet", 24),
    ("rel/gap/upgrade=0/county=G0100010/up0-G0100010-gap.csv", 30),
    ("rel/gap/upgrade=0/county=G0600010/up0-G0600010-gap.csv", 31),
    ("rel/gap/upgrade=0/county=AK, Bethel/x-gap.csv", 32),
    ("rel/gap/upgrade=0/nocounty/x-gap.csv", 33),
]


@pytest.fixture
def listing(spark):
    return spark.createDataFrame(KEYS, "key string, size long")


def keys(df):
    return sorted(r.key for r in df.collect())


def test_extension_upgrade_state(listing):
    sel = mf.Selection(upgrades=["0"], states=["al"], extensions=(".csv", ".parquet"))
    got = keys(mf.select_objects(listing, "rel/", sel))
    assert "rel/timeseries/upgrade=0/state=AL/up0-al-office.csv" in got
    assert "rel/timeseries/upgrade=1/state=AL/up1-al-office.csv" not in got
    assert "rel/full/AL_upgrade0_agg.parquet" in got
    assert "rel/full/AL_upgrade10_agg.parquet" not in got        # upgrade from the file name
    assert "rel/full/notes.parquet" not in got                    # no state in the name
    assert "rel/timeseries/upgrade=0/state=CA/up0-ca-office.csv" not in got


def test_no_upgrade_in_name_is_kept_and_version(listing):
    sel = mf.Selection(upgrades=["3"], extensions=(".parquet",), version="full")
    got = keys(mf.select_objects(listing, "rel/", sel))
    assert got == ["rel/full/notes.parquet"]


def test_substring_quirk_and_tokens(spark):
    df = spark.createDataFrame([("x/up0_upgrade0.parquet", 1), ("x/DE_upgrade0.parquet", 2)], "key string, size long")
    loose = keys(mf.select_objects(df, "x/", mf.Selection(states=["DE"], extensions=None)))
    assert loose == ["x/DE_upgrade0.parquet", "x/up0_upgrade0.parquet"]    # 'DE' inside 'UPGRADE'
    strict = keys(mf.select_objects(df, "x/", mf.Selection(states=["DE"], extensions=None, state_name_tokens=True)))
    assert strict == ["x/DE_upgrade0.parquet"]


def test_county_data_filters(listing):
    sel = mf.Selection(states=["AL"], county_data=True)
    got = keys(mf.select_objects(listing, "rel/gap/", sel))
    assert got == ["rel/gap/upgrade=0/county=G0100010/up0-G0100010-gap.csv", "rel/gap/upgrade=0/nocounty/x-gap.csv"]
    sel2 = mf.Selection(counties=["g0600010"], county_data=True)
    assert keys(mf.select_objects(listing, "rel/gap/", sel2)) == ["rel/gap/upgrade=0/county=G0600010/up0-G0600010-gap.csv"]


def test_unknown_state_raises(listing):
    with pytest.raises(ValueError):
        mf.select_objects(listing, "rel/", mf.Selection(states=["ZZ"]))


def test_dedupe_status_totals(spark, listing):
    dup = spark.createDataFrame([("a", 1, 0), ("a", 5, 1), ("b", 2, 0)], "key string, size long, listing_order int")
    assert {r.key: r.size for r in last_per_key(dup, "key", ["listing_order"]).collect()} == {"a": 5, "b": 2}
    inv = spark.createDataFrame([(KEYS[0][0], 10), (KEYS[1][0], 0)], "key string, size long")
    fail = spark.createDataFrame([(KEYS[2][0],)], "key string")
    st = {r.key: r.status for r in mf.transfer_status(listing, inv, fail).collect()}
    assert st[KEYS[0][0]] == "skipped" and st[KEYS[1][0]] == "ok" and st[KEYS[2][0]] == "error"
    tot = mf.selection_totals(listing).collect()[0]
    assert tot.n_files == len(KEYS) and tot.total_bytes == sum(s for _, s in KEYS)
    assert tot.total_size == "282.0 B"


def test_expand_prefixes():
    assert mf.expand_prefixes("ts/", upgrade=["0", "1"], state=["AL"]) == [
        "ts/upgrade=0/state=AL/", "ts/upgrade=1/state=AL/"]


def test_upgrade_from_file_name(spark):
    df = spark.createDataFrame([("p/AL_upgrade0_agg.parquet", 1), ("p/upgrade10.parquet", 2),
                                ("p/up0-al-x.csv", 3), ("p/AL_upgrade1_agg.parquet", 4)], "key string, size long")
    sel = mf.Selection(upgrades=["0", "10"], extensions=None)
    assert keys(mf.select_objects(df, "p/", sel)) == ["p/AL_upgrade0_agg.parquet", "p/up0-al-x.csv",
                                                      "p/upgrade10.parquet"]
