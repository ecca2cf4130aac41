"""County grouping: Spark plans against the row-loop rules, invariants,
order and partitioning invariance, gate branches, imputation."""


import pytest
from pyspark.sql import functions as F

from brute import assign_groups as bf_assign
from brute import merge as bf_merge
from brute import split_by_zone as bf_split
from conftest import SF_MID, SF_SMALL
from gridloom.operators import grouping as grp
from gridloom.plans.bases import county_zone, samples_b


def _rows(df):
    return [(r.bldgid, r.county, r.puma, r.weight) for r in df.collect()]


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_assign_matches_rules(spark, sf):
    b = samples_b(spark, sf)
    got = {r.county: r.county_groups for r in grp.assign_groups(b).collect()}
    assert got == bf_assign(_rows(b))


def test_assign_invariants(spark):
    b = samples_b(spark, SF_MID)
    labels = grp.assign_groups(b)
    assert labels.count() == b.select("county").distinct().count()
    sizes = (labels.where(F.col("county_groups").startswith("county_group_"))
             .groupBy("county_groups").count().where("count = 1").count())
    assert sizes == 0


def test_assign_order_and_partition_invariant(spark):
    b = samples_b(spark, SF_SMALL)
    base = {r.county: r.county_groups for r in grp.assign_groups(b).collect()}
    shuffled = b.orderBy(F.rand(7)).repartition(5)
    assert {r.county: r.county_groups for r in grp.assign_groups(shuffled).collect()} == base


def test_null_keys_and_ties(spark):
    rows = [(1, "c1", "p1", 1.0), (2, "c2", "p1", 1.0), (3, "c2", "p2", 1.0), (4, "c3", "p2", 1.0),
            (5, "c1", "p3", 1.0), (6, "c3", "p3", 1.0), (7, None, "p1", 5.0), (8, "c4", None, 1.0)]
    df = spark.createDataFrame(rows, "bldgid long, county string, puma string, weight double")
    got = {r.county: r.county_groups for r in grp.assign_groups(df).collect()}
    assert got == bf_assign(rows)


def _members(spark, sf):
    b = samples_b(spark, sf)
    m = grp.assign_groups(b, keep_first="first_order")
    return m.withColumn("R", county_zone(F.col("county")))


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_split_matches_rules(spark, sf):
    m = _members(spark, sf)
    rows = m.collect()
    label = {r.county: r.county_groups for r in rows}
    zone = {r.county: r.R for r in rows}
    got = {r.county: r.county_groups for r in grp.split_by_zone(m).collect()}
    assert got == bf_split(label, zone)
    # every county_group_* now lies in one zone
    zones = {}
    for c, g in got.items():
        if g.startswith("county_group_"):
            zones.setdefault(g, set()).add(zone[c])
    assert all(len(z) == 1 for z in zones.values())


def test_merge_gate_branches(spark):
    rows = [("a", "county_group_1", "Z1", 1), ("b", "county_group_2", "Z1", 2),
            ("c", "county_group_3", "Z2", 3), ("d", "county_group_4", None, 4),
            ("e", "county_group_5", None, 5), ("f", "county_group_6", "Z2", 6)]
    m = spark.createDataFrame(rows, "county string, county_groups string, R string, first_order long")
    specs_l = [("county_group_1", "county_group_2"),   # equal -> merge
               ("county_group_3", "county_group_2"),   # unequal -> skip
               ("county_group_4", "county_group_5"),   # both null -> merge
               ("county_group_9", "county_group_6"),   # absent source, target has a zone -> skip
               ("county_group_6", "county_group_1"),   # unequal
               ("county_group_6", "county_group_3")]   # equal, later spec wins for the source
    specs = spark.createDataFrame([(s, t, i) for i, (s, t) in enumerate(specs_l)],
                                  "source_group string, target_group string, spec_order int")
    res = grp.merge_groups(m, specs, order=["first_order"], spec_order="spec_order")
    got = {r.county: r.county_groups for r in res.result.collect()}
    label = {r[0]: r[1] for r in rows}
    zone = {r[0]: r[2] for r in rows}
    first = {r[0]: r[3] for r in rows}
    assert got == bf_merge(label, zone, first, specs_l)
    decisions = {(r.source_group, r.target_group): r.decision for r in res.report.collect()}
    assert decisions[("county_group_3", "county_group_2")] == "zone mismatch"
    assert decisions[("county_group_4", "county_group_5")] == "merged"
    assert decisions[("county_group_9", "county_group_6")] == "zone mismatch"


def test_impute_missing(spark):
    rows = [(1, "c1", "p1", 2.0, "g1"), (2, "c2", "p1", 1.0, "g2"), (3, "c3", "p2", 1.0, "g2")]
    samples = spark.createDataFrame(rows, "bldgid long, county string, puma string, weight double, county_groups string")
    samples = samples.withColumn("county_fips5", F.col("county"))
    ref = spark.createDataFrame([("c1",), ("c2",), ("c3",), ("c4",), ("c5",), ("c6",)], "county string") \
        .withColumn("county_fips5", F.col("county"))
    cross = spark.createDataFrame([("c4", "p1"), ("c4", "p2"), ("c4", "p2"), ("c5", "p1"), ("c5", "p2"),
                                   ("c6", "p9")], "county_fips5 string, puma string")
    out = grp.impute_missing_members(samples, ref, cross)
    d = {r.county: (r.bldgid, r.puma, r.weight, r.county_groups) for r in out.where("bldgid like 'dummy_%'").collect()}
    assert d["c4"] == ("dummy_c4", "p2", 0.0, "g2")
    assert d["c5"] == ("dummy_c5", "p1", 0.0, "g1")   # tie on tracts -> lowest area; majority weight g1
    assert d["c6"] == ("dummy_c6", "p9", 0.0, "independent_county_c6")
    assert out.count() == 6


def test_build_county_groups_end_to_end(spark):
    b = samples_b(spark, SF_SMALL).withColumn("county_fips5", F.col("county"))
    specs = spark.createDataFrame([("county_group_0", "county_group_1", 0)],
                                  "source_group string, target_group string, spec_order int")
    res = grp.build_county_groups(b, zone_of=county_zone(F.col("county")), specs=specs)
    rows = res.rows
    assert rows.count() == b.count()
    assert rows.where(F.col("county_groups").isNull()).count() == 0
    per_member = rows.groupBy("county").agg(F.countDistinct("county_groups").alias("n"))
    assert per_member.where("n != 1").count() == 0
    assert res.mapping.count() == b.select("county").distinct().count()


def test_zone_violations_reported(spark):
    rows = [("c1", "independent_county_c1", "Z1"), ("c2", "independent_county_c1", "Z2"),
            ("c3", "county_group_1", "Z1"), ("c4", "county_group_1", None)]
    df = spark.createDataFrame(rows, "county string, county_groups string, R string")
    got = [(r.county_groups, r.n_zones, r.zones) for r in grp.zone_violations(df).collect()]
    assert got == [("independent_county_c1", 2, "Z1,Z2")]
