"""Registered queries: one function per operator family, each
``(spark, sf_dir) -> DataFrame`` over the driver tables.

Money and ``value`` columns carry two decimals; sums over them use the
exact (decimal) form so results do not depend on partitioning.  Means are
rounded to 6 places and shares to 9 for comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from gridloom.functions import codes
from gridloom.functions.codes import FIPS_TO_STATE, STATE_TO_FIPS, lookup, zfill
from gridloom.functions.columns import (
    MeasureRules, find_building_type_column, find_timestamp_column, token_after,
)
from gridloom.functions.scalars import (
    exact_sum, format_bytes, is_all_digits, last_token_label, numeric_then_lexical,
    rstrip_chars,
)
from gridloom.functions.timefns import ceil_to, parse_timestamp, trunc_to
from gridloom.operators import diagnostics as diag
from gridloom.operators import grouping as grp
from gridloom.operators import manifest as mf
from gridloom.operators.joins import (
    anti_join, key_audit, lookup_join, measured_hot_join, route_by_lookup, semi_join,
)
from gridloom.operators.ranking import dense_ordinal, first_seen_ordinal, pick_per_group
from gridloom.operators.reshape import melt_end_uses
from gridloom.operators.sets import append_and_count, last_per_key, union_by_name
from gridloom.operators.timeseries import (
    distinct_keys, long_end_use, melt_rollup, merge_partials, month_hour_profile,
    rollup_to_period, share_of_total, state_rollup, sum_by_truncated_time,
)
from gridloom.plans.jobs import group_diagnostics
from gridloom.plans.bases import county_zone, documents_manifest, samples_b
from gridloom.session import materialize
from gridloom.sinks.writers import normalise_for_sink
from gridloom.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def _gwh(col: str = "value") -> "F.Column":
    # SUM(value / 1e6) computed as an exact sum of cents, then scaled.
    return exact_sum(col, 2) / F.lit(1e6)


# ---------------------------------------------------------------- reshape / C1

def q_long_end_use(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: melt three measures, ceil to day, mean-then-sum the
    population measure, roll up across the 'building type'.  Aggregated on
    the wide rows, melted last (``melt_rollup``)."""
    li = table(spark, sf, "lineitem").select(
        "l_shipdate", "l_returnflag", "l_linestatus", "l_discount",
        "l_quantity", "l_extendedprice", "l_tax")
    rules = MeasureRules(energy_marker="kwh", population=("l_discount",))
    out = melt_rollup(li, unit="day", ts_col="l_shipdate", building_type_col="l_linestatus",
                      rules=rules, sum_scale=2, label=token_after("_"),
                      value_columns=["l_quantity", "l_extendedprice", "l_tax"],
                      drop_prefix=None, exclude_substring=None, value_name="kwh")
    return out.withColumn("l_discount", F.round("l_discount", 6))


def _numeric_measures(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]


def q_melt_measures(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                             "l_extendedprice", "l_discount", "l_tax")
    return melt_end_uses(li, value_columns=_numeric_measures(li), label=token_after("_"),
                         drop_prefix=None, exclude_substring="DISC", value_name="kwh")


def q_melt_allowlist(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                             "l_extendedprice", "l_discount", "l_tax")
    return melt_end_uses(li, end_uses=[" Quantity", "TAX ", ""], value_columns=_numeric_measures(li),
                         label=token_after("_"), drop_prefix=None, exclude_substring=None,
                         value_name="kwh")


# ---------------------------------------------------------------- time series

def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("ts", "event_type", "value")


_EVENT_RULES = MeasureRules(energy_marker=None, population=("mean_value",), extra_energy=("value",))


def q_hourly_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Hour-ending sum and row count per event type; the mean is the exact
    sum over the count (no rounding: identical bits in every engine)."""
    ev = _events(spark, sf)
    rules = MeasureRules(energy_marker=None, population=(), extra_energy=("value",))
    out = rollup_to_period(ev, unit="hour", ts_col="ts", rules=rules, sum_scale=2, count_as="n_rows")
    return out.withColumn("mean_value", F.col("value") / F.col("n_rows"))


def q_two_stage_rollup(spark: SparkSession, sf: str) -> DataFrame:
    ev = _events(spark, sf).withColumn("mean_value", F.col("value"))
    out = long_end_use(ev, unit="hour", ts_col="ts", building_type_col="event_type",
                       rules=_EVENT_RULES, sum_scale=2)
    return out.withColumn("mean_value", F.round("mean_value", 6))


def q_partial_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Aggregate chunks of the input separately, as an incremental run would,
    and merge the partial results with (sum, count).  The chunk is a grouping
    column (here: who sent the event), so one scan makes all partials and
    nearly every (hour, type) key receives several."""
    ev = table(spark, sf, "events").select("ts", "event_type", "value", "user_id")
    hour = ceil_to("hour", F.col("ts"), ev.schema["ts"].dataType)
    parts = (ev.groupBy(F.pmod(F.col("user_id"), F.lit(4)).alias("chunk"), hour.alias("ts"), "event_type")
             .agg(exact_sum("value", 2).alias("value"), F.count(F.lit(1)).alias("n_rows")))
    merged = merge_partials(parts, ["ts", "event_type"], ["value", "n_rows"],
                            means={"mean_value": ("value", "n_rows")}, sum_scale=2)
    return merged.withColumn("n_rows", F.col("n_rows").cast("long"))


def q_distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_keys(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


def _nation_region(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    return lookup_join(nation, region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")


def q_sum_by_parent_time(spark: SparkSession, sf: str) -> DataFrame:
    """Sum order value by (region, order date), the region reached through
    customer -> nation -> region.  The lookups are joined to the customers
    first (few columns), the orders to the result (broadcast or a join whose
    hot customers adaptive execution splits), then one partial + final
    aggregate."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    parent = _nation_region(spark, sf).select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    cust = lookup_join(table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"),
                       parent, "c_nationkey", "inner")
    rows = orders.join(cust, "o_custkey")
    return state_rollup(rows, code_col="c_nationkey", value_col="o_totalprice", ts_col="o_orderdate",
                        parent=F.col("r_name"), parent_name="region", sum_scale=2).result


def q_reject_unknown(spark: SparkSession, sf: str) -> DataFrame:
    """Customers whose nation is missing from a lookup that covers only
    regions 0-3: routed aside and counted per nation."""
    lookup_tbl = (table(spark, sf, "nation").where(F.col("n_regionkey") != 4)
                  .select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("parent")))
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    _, rejected = route_by_lookup(cust, lookup_tbl, "c_nationkey", "parent")
    return rejected


def q_hour_trunc_sum(spark: SparkSession, sf: str) -> DataFrame:
    return sum_by_truncated_time(_events(spark, sf), "ts", _gwh(), unit="hour")


def q_month_hour_profile(spark: SparkSession, sf: str) -> DataFrame:
    out = month_hour_profile(_events(spark, sf), "ts", _gwh())
    return out.withColumn("month", F.col("month").cast("long")).withColumn("hour", F.col("hour").cast("long"))


def q_pct_of_total(spark: SparkSession, sf: str) -> DataFrame:
    ev = _events(spark, sf)
    agg = (ev.groupBy("event_type", F.month("ts").cast("long").alias("month"), F.hour("ts").cast("long").alias("hour"))
           .agg(exact_sum("value", 2).alias("value")))
    return share_of_total(agg, "value", ["event_type"]).withColumn("share", F.round("share", 9))


def q_drill_rollup(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer").select("c_nationkey", "c_mktsegment", "c_acctbal")
    dims = _nation_region(spark, sf).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    rows = lookup_join(cust, dims, "c_nationkey")
    out = diag.drill_rollup(rows, ["r_name", "n_name", "c_mktsegment"],
                            {"n_customers": diag.Measure("count"), "total_acctbal": diag.Measure("sum", "c_acctbal", 2),
                             "mean_acctbal": diag.Measure("mean", "c_acctbal", 2), "least_acctbal": diag.Measure("min", "c_acctbal")})
    for g in ("g_r_name", "g_n_name", "g_c_mktsegment"):
        out = out.withColumn(g, F.col(g).cast("int"))
    return out


# ---------------------------------------------------------------- joins / lookups

def q_constant_map_lookup(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    fips = zfill(F.col("n_nationkey").cast("string"), 2)
    return (nation.withColumn("fips2", fips)
            .withColumn("state", lookup(FIPS_TO_STATE, F.col("fips2")))
            .where(F.col("fips2").isin(list(STATE_TO_FIPS.values()))))


def q_lookup_left_join(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with the zone that a lookup (the labels, which cover
    some of them) gives its padded code; the check for duplicate keys is part
    of the plan."""
    rows = table(spark, sf, "documents").select(zfill(F.col("doc_id").cast("string"), 7).alias("county_fips5"), "source")
    zones = table(spark, sf, "labels").select(
        zfill(F.col("doc_id").cast("string"), 7).alias("county_fips5"),
        F.concat(F.lit("R"), F.col("quality").cast("string")).alias("R"))
    return lookup_join(rows, zones, "county_fips5", "left", check_unique=True)


def q_anti_join_missing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return anti_join(docs, table(spark, sf, "labels").select("doc_id"), "doc_id")


def q_shared_key_self_join(spark: SparkSession, sf: str) -> DataFrame:
    out = diag.shared_area_neighbours(samples_b(spark, sf), "C00013")
    return out.withColumn("weight", F.col("weight").cast("double"))


def q_full_outer_audit(spark: SparkSession, sf: str) -> DataFrame:
    return key_audit(table(spark, sf, "labels"), table(spark, sf, "pages"), "doc_id", "page_id")


def q_prefix_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    """Keep customers whose composed county code lies in a wanted state
    (state -> FIPS prefix, semi-join to the small prefix table)."""
    wanted = ["AL", "AK", "AZ", "CA", "CO"]
    prefixes = spark.createDataFrame([(STATE_TO_FIPS[s],) for s in wanted], "prefix string")
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    coded = cust.select("c_custkey", F.concat(F.lit("G"), zfill(F.col("c_nationkey").cast("string"), 2),
                                              F.lit("00010")).alias("county"))
    keyed = coded.withColumn("prefix", codes.state_fips_prefix(F.col("county")))
    # the prefix table has at most 51 rows (one per state): a proven bound
    return semi_join(keyed, F.broadcast(prefixes), "prefix").drop("prefix")


# ---------------------------------------------------------------- grouping on B

_SPEC = grp.GroupingSpec()


def q_pair_weight(spark: SparkSession, sf: str) -> DataFrame:
    b = samples_b(spark, sf)
    return b.groupBy("county", "puma").agg(F.sum("weight").cast("double").alias("weight"))


def q_nunique_having(spark: SparkSession, sf: str) -> DataFrame:
    b = samples_b(spark, sf)
    pairs = b.select("county", "puma").na.drop().distinct()
    return grp.multi_member_areas(pairs)


def q_forall_group(spark: SparkSession, sf: str) -> DataFrame:
    b = samples_b(spark, sf)
    pairs = b.select("county", "puma").na.drop().distinct()
    return grp.independent_multi_area_members(pairs)


def q_argmax_assign(spark: SparkSession, sf: str) -> DataFrame:
    b = samples_b(spark, sf)
    pairs = grp.pair_weights(b, _SPEC)
    return grp.dominant_area(pairs).select("county", "puma", F.col("_w").cast("double").alias("weight"))


def q_singleton_relabel(spark: SparkSession, sf: str) -> DataFrame:
    labels = grp.assign_groups(samples_b(spark, sf), relabel_singletons=False)
    return grp.relabel_singletons(labels)


def q_assign_groups(spark: SparkSession, sf: str) -> DataFrame:
    b = samples_b(spark, sf)
    labels = grp.assign_groups(b)
    return grp.attach_labels(b.select("bldgid", "county", "puma"), labels)


def _members_with_zone(spark: SparkSession, sf: str) -> DataFrame:
    """Member-level table: county, label, first order key, zone
    (materialised: the split reads it several times)."""
    b = samples_b(spark, sf)
    members = grp.assign_groups(b, keep_first="first_order")
    return materialize(members.withColumn("R", county_zone(F.col("county"))), "members")


def q_split_by_attribute(spark: SparkSession, sf: str) -> DataFrame:
    split = grp.split_by_zone(_members_with_zone(spark, sf))
    return split.select("county", "R", "county_groups")


# Merge specs are user data.  Chosen against the sf0.01 labels to hit every
# gate branch: equal zones, different zones, both zones missing, a source
# that does not exist, and one source listed twice (last allowed wins).
MERGE_SPECS = [
    ("county_group_1", "county_group_4"),
    ("county_group_2", "county_group_3"),
    ("county_group_50", "county_group_53"),
    ("independent_county_C00022", "county_group_52"),
    ("county_group_999", "county_group_7"),
    ("independent_county_C00000", "county_group_0"),
    ("county_group_9", "county_group_12"),
    ("county_group_9", "county_group_14"),
]


def merge_specs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, t, i) for i, (s, t) in enumerate(MERGE_SPECS)],
                                 "source_group string, target_group string, spec_order int")


def q_gated_merge(spark: SparkSession, sf: str) -> DataFrame:
    split = grp.split_by_zone(_members_with_zone(spark, sf))
    res = grp.merge_groups(split, merge_specs(spark), order=["first_order"], spec_order="spec_order")
    return res.result.select("county", "county_groups")


def _impute_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reference counties = those of B plus one absent county per nation;
    crosswalk 'tracts' = one per customer for its own county, and one per
    customer for its nation's absent county."""
    b = samples_b(spark, sf)
    nation = table(spark, sf, "nation").select("n_nationkey")
    absent = F.concat(F.lit("C9"), zfill(F.col("n_nationkey").cast("string"), 4))
    ref = (b.select("county").distinct()
           .unionByName(nation.select(absent.alias("county")))
           .withColumn("county_fips5", F.col("county")))
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    cross_own = b.select(F.col("county").alias("county_fips5"), "puma")
    cross_abs = (cust.join(b.select(F.col("bldgid").alias("c_custkey"), "puma"), "c_custkey")
                 .select(F.concat(F.lit("C9"), zfill(F.col("c_nationkey").cast("string"), 4)).alias("county_fips5"),
                         "puma"))
    return b, ref, cross_own.unionByName(cross_abs)


def q_impute_missing(spark: SparkSession, sf: str) -> DataFrame:
    b, ref, cross = _impute_inputs(spark, sf)
    rows = grp.attach_labels(b, grp.assign_groups(b)).withColumn("county_fips5", F.col("county"))
    out = grp.impute_missing_members(rows, ref, cross)
    return out.select("bldgid", "county", "puma", F.col("weight").cast("double").alias("weight"),
                      "county_groups")


def q_mapping_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """The mapping of the whole county-group job, all its columns."""
    b = samples_b(spark, sf).withColumns({
        "state": F.substring("county", 1, 3), "county_fips5": F.substring("county", 2, 5),
        "county_name": F.concat(F.lit("County "), F.substring("county", 2, 5))})
    return grp.build_county_groups(b, zone_of=county_zone(F.col("county"))).mapping


def q_collect_members(spark: SparkSession, sf: str) -> DataFrame:
    """Customers by nation, as sorted lists in pages of 25."""
    return diag.collect_members(table(spark, sf, "customer"), "c_nationkey", "c_custkey", page=25)


def q_group_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, groups and members by kind of group, and members by their number
    of areas."""
    b = samples_b(spark, sf)
    rows = grp.attach_labels(b, grp.assign_groups(b)).withColumns(
        {"state": F.substring("county", 1, 2), "county_fips5": F.col("county")})
    found = group_diagnostics(rows)
    areas = found["areas_per_member"].select(F.concat(F.lit("areas "), F.col("n_areas").cast("string")).alias("kind"),
                                             F.lit(None).cast("long").alias("n_rows"), F.lit(None).cast("long").alias("n_groups"),
                                             "n_members")
    return found["by_kind"].unionByName(areas)


def q_merge_report(spark: SparkSession, sf: str) -> DataFrame:
    """Every merge spec with both zones and the decision."""
    split = grp.split_by_zone(_members_with_zone(spark, sf))
    return grp.merge_groups(split, merge_specs(spark), order=["first_order"], spec_order="spec_order").report


def q_zone_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Groups that span several zones before they are split."""
    return grp.zone_violations(_members_with_zone(spark, sf))


def q_hot_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """Line items joined to parts, a third of them to one part: the hot key is
    found by counting and its rows are spread."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_partkey")).alias("p_partkey"))
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    return measured_hot_join(li, parts, "p_partkey", "left", share=0.05)


# ---------------------------------------------------------------- ranking

def q_top1_tiebreak(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer")
    counts = cust.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n_customers"))
    return pick_per_group(counts, ["c_nationkey"], ["c_mktsegment", "n_customers"],
                          desc=["n_customers"], asc=["c_mktsegment"])


def q_weighted_majority(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer").na.drop(subset=["c_nationkey", "c_mktsegment"])
    sums = cust.groupBy("c_nationkey", "c_mktsegment").agg(
        F.sum(F.col("c_acctbal").cast("decimal(38,2)")).alias("_w"))
    best = pick_per_group(sums, ["c_nationkey"], ["c_mktsegment", "_w"], desc=["_w"], asc=["c_mktsegment"])
    return best.select("c_nationkey", "c_mktsegment", F.col("_w").cast("double").alias("total_acctbal"))


def q_first_seen_ordinal(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return first_seen_ordinal(orders, "o_custkey", "o_orderkey", first_col="first_order")


def q_numeric_lexical_sort(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    values = (part.select(F.element_at(F.split("p_brand", "#"), -1).alias("value"))
              .unionByName(part.select(F.col("p_type").alias("value"))))
    return dense_ordinal(values, "value", by=numeric_then_lexical("value")[:2], out="rank")


def q_group_size_topk(spark: SparkSession, sf: str) -> DataFrame:
    return diag.top_k_by_count(table(spark, sf, "lineitem"), "l_suppkey", 20, "n_lines")


def q_count_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return diag.count_histogram(table(spark, sf, "orders"), "o_custkey", "n_orders", "n_customers")


def q_conditional_counts(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return diag.conditional_counts(
        c,
        {"n_building": F.col("c_mktsegment") == "BUILDING",
         "n_negative": F.col("c_acctbal") < 0,
         "n_prefix": F.col("c_name").startswith("Customer#0000001")},
        {"n_nations": "c_nationkey", "n_segments": "c_mktsegment"})


def _acct_code() -> "F.Column":
    return F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string")).otherwise(
        F.floor(F.col("c_acctbal") * 10).cast("long").cast("string"))


def q_validity_report(spark: SparkSession, sf: str) -> DataFrame:
    return diag.validity_report(table(spark, sf, "customer"), _acct_code(), "c_mktsegment")


def q_sample_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return diag.first_n_per_group(table(spark, sf, "customer"), "c_mktsegment", "c_name", 5)


# ---------------------------------------------------------------- scalars / projection

def q_group_label(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    name = F.when(F.col("p_type") == "ECONOMY", F.lit("economy part")).otherwise(F.col("p_brand"))
    label = last_token_label(name, marker="#", sep="#")
    return part.select("p_partkey", label.alias("label"), (label == "i").alias("in_set"))


def _coded_customers(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    digits4 = F.substring("c_name", 15, 4)
    st = zfill(F.col("c_nationkey").cast("string"), 2)
    county = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat(F.lit("G"), st, digits4, F.lit("0")))
              .when(F.col("c_mktsegment") == "BUILDING",
                    F.when(F.col("c_acctbal") > 5000, F.lit("AK, Bethel Census Area"))
                    .otherwise(F.lit("AK, Unknown Borough")))
              .when(F.col("c_mktsegment") == "FURNITURE", F.lit("HI, Maui County"))
              .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit("XYZ"), F.col("c_custkey").cast("string")))
              .otherwise(F.concat(F.lit("G"), st, digits4)))
    return c.select("c_custkey", county.alias("county"))


def q_code_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return grp.add_county_fips5(_coded_customers(spark, sf))


def q_compose_codes(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    st = zfill(F.col("n_regionkey").cast("string"), 2)
    cty = zfill(F.col("n_nationkey").cast("string"), 3)
    return n.select("n_nationkey",
                    F.concat(st, cty).alias("county_fips5"),
                    codes.gisjoin_county(st, cty).alias("gisjoin"),
                    codes.gisjoin_puma(st, (F.col("n_nationkey") * 99991).cast("string")).alias("puma_g"))


def q_required_projection(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer")
    return grp.load_samples(cust, {"c_custkey": "bldgid", "c_name": "county", "c_nationkey": "state",
                                   "c_mktsegment": "puma", "c_acctbal": "weight"})


def q_resolve_columns(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    ts = find_timestamp_column(ev.columns, ["timestamp", "time", "ts"])
    bt = find_building_type_column(ev.columns, marker="type")
    return ev.select(F.col(ts).alias("timestamp"), F.col(bt).alias("building_type"), "value")


def q_scan_filter_project(spark: SparkSession, sf: str) -> DataFrame:
    return (table(spark, sf, "events").where(F.col("event_type") == "click")
            .select("event_id", "ts", "value"))


def q_type_normalise(spark: SparkSession, sf: str) -> DataFrame:
    emb = table(spark, sf, "embeddings")
    milli = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000))
    return normalise_for_sink(emb.select(
        "vec_id", "label", F.size("embedding").alias("dims"), F.element_at("embedding", -1).alias("last"),
        milli.alias("milli"), F.struct("vec_id", F.size("embedding").alias("dims")).alias("pair"),
        F.col("vec_id").cast("decimal(12,2)").alias("dec")))


def q_union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nationkey"))
    return union_by_name([c, s])


def q_append_union_count(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers appended by position (name, nation, balance)."""
    c = table(spark, sf, "customer").select("c_name", "c_nationkey", "c_acctbal")
    s = table(spark, sf, "supplier").select("s_name", "s_nationkey", "s_acctbal")
    return append_and_count([c, s])


def q_dedupe_by_key(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    return last_per_key(ev, "user_id", ["ts", "event_id"])


def q_path_partitions(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "pages").select("page_id", "url")
    url = F.col("url")
    return p.select("page_id",
                    F.split_part(url, F.lit("/"), F.lit(3)).alias("host"),
                    F.split_part(url, F.lit("/"), F.lit(4)).alias("section"),
                    F.regexp_extract(url, r"[?&]page=([^&#]*)", 1).alias("page"),
                    F.regexp_extract(url, r"[?&]ref=([^&#]*)", 1).alias("ref"))


# ---------------------------------------------------------------- manifest

MANIFEST_SELECTION = mf.Selection(upgrades=["0", "2"], states=["CA", "TX"], extensions=(".csv",))


def q_manifest_filter(spark: SparkSession, sf: str) -> DataFrame:
    m = documents_manifest(spark, sf)
    return mf.select_objects(m, sel=MANIFEST_SELECTION).select("key", "size")


def q_manifest_status(spark: SparkSession, sf: str) -> DataFrame:
    m = documents_manifest(spark, sf)
    labels = table(spark, sf, "labels")
    inventory = (labels.where(F.col("quality") == 1).join(m, "doc_id").select("key", "size"))
    failures = labels.where((F.col("toxic") == 1) & (F.col("quality") == 0)).join(m, "doc_id").select("key")
    return mf.status_report(mf.transfer_status(m, inventory, failures))


def q_format_bytes(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    size = (F.col("n_chars") * F.col("n_chars") * F.lit(10)).cast("long")
    return d.select("doc_id", size.alias("size_bytes"), format_bytes(size).alias("size_text"))


def q_scalar_strings(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    num = F.split_part(F.col("c_name"), F.lit("#"), F.lit(2))
    c = c.withColumn("num", num)
    return c.select(
        "c_custkey",
        F.upper("c_mktsegment").alias("seg_upper"),
        F.lower("c_name").alias("name_lower"),
        F.length("c_name").cast("long").alias("name_len"),
        "num",
        rstrip_chars("num", "0").alias("num_rstrip"),
        F.substring("c_name", 1, 5).alias("head5"),
        F.regexp_replace("c_name", "^Customer", "C").alias("short_name"),
        F.col("c_name").startswith("Customer#00000001").alias("starts"),
        F.col("c_name").endswith("7").alias("ends7"),
        F.col("c_mktsegment").contains("URE").alias("has_ure"),
        F.concat(F.col("c_mktsegment"), F.lit("/"), F.col("c_nationkey").cast("string")).alias("seg_nation"),
        is_all_digits("num").alias("all_digits"),
        zfill(F.col("c_nationkey").cast("string"), 3).alias("nation3"),
        F.trim(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "))).alias("seg_trim"),
    )


def q_scalar_dates(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events").select("event_id", "ts")
    dt = ev.schema["ts"].dataType
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return ev.select(
        "event_id",
        ceil_to("hour", F.col("ts"), dt).alias("hour_ending"),
        ceil_to("day", F.col("ts"), dt).alias("day_ending"),
        trunc_to("hour", F.col("ts"), dt).alias("hour_start"),
        F.month("ts").cast("long").alias("month"),
        F.hour("ts").cast("long").alias("hour"),
        F.year("ts").cast("long").alias("year"),
        text.alias("ts_text"),
        parse_timestamp(text).cast("timestamp_ntz").alias("ts_parsed"),
    )


QUERIES: dict[str, Query] = {
    "long_end_use": q_long_end_use,
    "melt_measures": q_melt_measures,
    "melt_allowlist": q_melt_allowlist,
    "hourly_rollup": q_hourly_rollup,
    "two_stage_rollup": q_two_stage_rollup,
    "partial_merge": q_partial_merge,
    "distinct_keys": q_distinct_keys,
    "sum_by_parent_time": q_sum_by_parent_time,
    "reject_unknown": q_reject_unknown,
    "hour_trunc_sum": q_hour_trunc_sum,
    "month_hour_profile": q_month_hour_profile,
    "pct_of_total": q_pct_of_total,
    "drill_rollup": q_drill_rollup,
    "constant_map_lookup": q_constant_map_lookup,
    "lookup_left_join": q_lookup_left_join,
    "anti_join_missing": q_anti_join_missing,
    "shared_key_self_join": q_shared_key_self_join,
    "full_outer_audit": q_full_outer_audit,
    "prefix_semi_join": q_prefix_semi_join,
    "pair_weight": q_pair_weight,
    "nunique_having": q_nunique_having,
    "forall_group": q_forall_group,
    "argmax_assign": q_argmax_assign,
    "top1_tiebreak": q_top1_tiebreak,
    "weighted_majority": q_weighted_majority,
    "first_seen_ordinal": q_first_seen_ordinal,
    "singleton_relabel": q_singleton_relabel,
    "assign_groups": q_assign_groups,
    "split_by_attribute": q_split_by_attribute,
    "gated_merge": q_gated_merge,
    "impute_missing": q_impute_missing,
    "mapping_distinct": q_mapping_distinct,
    "collect_members": q_collect_members,
    "group_kinds": q_group_kinds,
    "merge_report": q_merge_report,
    "zone_violations": q_zone_violations,
    "hot_key_join": q_hot_key_join,
    "group_label": q_group_label,
    "code_fallback": q_code_fallback,
    "compose_codes": q_compose_codes,
    "required_projection": q_required_projection,
    "resolve_columns": q_resolve_columns,
    "scan_filter_project": q_scan_filter_project,
    "type_normalise": q_type_normalise,
    "union_by_name": q_union_by_name,
    "append_union_count": q_append_union_count,
    "dedupe_by_key": q_dedupe_by_key,
    "numeric_lexical_sort": q_numeric_lexical_sort,
    "group_size_topk": q_group_size_topk,
    "count_histogram": q_count_histogram,
    "conditional_counts": q_conditional_counts,
    "validity_report": q_validity_report,
    "sample_per_group": q_sample_per_group,
    "path_partitions": q_path_partitions,
    "manifest_filter": q_manifest_filter,
    "manifest_status": q_manifest_status,
    "format_bytes": q_format_bytes,
    "scalar_strings": q_scalar_strings,
    "scalar_dates": q_scalar_dates,
}
