"""County grouping: assign members (counties) to groups through shared
areas (PUMAs), impute members missing from the samples, split groups that
span several zones, apply gated merges, and list the mapping.

Every step is set-based.  The sample table (the large input) is touched
by partial+final aggregates only: pair weights, first-appearance order and
area/group weights.  All group logic then runs on member-level and
pair-level frames (one row per county or per county x area), and the
labels are joined back to the samples once.  Orders that the rules depend
on ("first appearance", "lowest code") are explicit sort keys, never row
order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.codes import county_fips5
from gridloom.functions.columns import q, require_columns
from gridloom.operators.joins import anti_join
from gridloom.operators.ranking import pick_per_group, range_sequence
from gridloom.session import materialize

GROUP_PREFIX = "county_group_"
INDEPENDENT_PREFIX = "independent_county_"
MISSING_ZONE = "__MISSING__"

# Column names of the sample table and their engine names.
# The columns of the grouped samples and of the mapping.
ROW_COLUMNS = ("bldgid", "county", "state", "puma", "weight", "county_fips5", "county_groups", "county_name", "R")
MAPPING_COLUMNS = ("state", "county", "county_name", "county_fips5", "R", "county_groups")
SAMPLE_COLUMNS = {"bldg_id": "bldgid", "in.county": "county", "in.state": "state",
                  "in.puma": "puma", "weight": "weight"}


def load_samples(df: DataFrame, columns: dict[str, str] = SAMPLE_COLUMNS) -> DataFrame:
    """Required-column check, projection and rename (Spark prunes the scan
    to these columns)."""
    require_columns(df, list(columns))
    return df.select(*[F.col(q(src)).alias(dst) for src, dst in columns.items()])


def add_county_fips5(samples: DataFrame, county: str = "county", out: str = "county_fips5") -> DataFrame:
    """Five-digit FIPS from the county code (regex, AK/HI names, zero-fill)."""
    return samples.withColumn(out, county_fips5(F.col(q(county))))


@dataclass(frozen=True)
class GroupingSpec:
    member: str = "county"
    area: str = "puma"
    weight: str = "weight"
    order: str = "bldgid"
    group: str = "county_groups"


def pair_weights(samples: DataFrame, s: GroupingSpec = GroupingSpec()) -> DataFrame:
    """Summed weight per (member, area), rows with a null member or area
    left out."""
    return (samples.na.drop(subset=[s.member, s.area])
            .groupBy(F.col(q(s.member)).alias(s.member), F.col(q(s.area)).alias(s.area))
            .agg(_weight(s.weight).alias("_w")))


def _weight(col: str) -> Column:
    """Summed weight; a group without any weight weighs 0."""
    return F.coalesce(F.sum(F.col(q(col))), F.lit(0))


def multi_member_areas(pairs: DataFrame, s: GroupingSpec = GroupingSpec()) -> DataFrame:
    """Areas shared by more than one distinct member (with the count)."""
    return (pairs.groupBy(s.area).agg(F.countDistinct(F.col(q(s.member))).alias("num_counties"))
            .where(F.col("num_counties") > 1))


def independent_multi_area_members(pairs: DataFrame, s: GroupingSpec = GroupingSpec()) -> DataFrame:
    """Members with more than one area where every area is single-member."""
    shared = multi_member_areas(pairs, s).select(s.area, F.lit(True).alias("_shared"))
    return (pairs.join(shared, s.area, "left")
            .groupBy(s.member)
            .agg(F.countDistinct(F.col(q(s.area))).alias("num_pumas"),
                 F.bool_and(F.col("_shared").isNull()).alias("_all_single"))
            .where((F.col("num_pumas") > 1) & F.col("_all_single"))
            .select(s.member, "num_pumas"))


def dominant_area(pairs: DataFrame, s: GroupingSpec = GroupingSpec()) -> DataFrame:
    """Per member, among its shared areas, the one with the largest summed
    weight; ties go to the lowest area code.  Members without a shared
    area are absent."""
    shared = multi_member_areas(pairs, s).select(s.area)
    cands = pairs.join(shared, s.area, "left_semi")
    return pick_per_group(cands, [s.member], [s.area, "_w"], desc=["_w"], asc=[s.area])


def assign_groups(samples: DataFrame, spec: GroupingSpec = GroupingSpec(),
                  relabel_singletons: bool = True, keep_first: str | None = None) -> DataFrame:
    """Member-level group labels: (member, group[, keep_first]).

    1. an area is *shared* when more than one distinct member has it;
    2. a member with no shared area is independent;
    3. otherwise it joins its shared area of largest weight (tie: lowest
       area code);
    4. chosen areas are numbered 0.. in order of the first appearance
       (smallest ``order``) of any member choosing them ->
       ``county_group_<n>``; independent -> ``independent_county_<member>``;
    5. groups left with one member become independent (their numbers
       stay unused).
    Rows with a null member get no label.  With ``keep_first`` the
    member's first order key is kept under that name (the order later
    steps use, so they need not go back to the samples).
    """
    s = spec
    # One pass over the samples: weight and first order key per (member,
    # area), null areas kept as their own key so the member's first
    # appearance counts every row.  Materialised: everything below reads
    # this pair-level table, never the samples again.
    pf = materialize(samples.where(F.col(q(s.member)).isNotNull())
                     .groupBy(F.col(q(s.member)).alias(s.member), F.col(q(s.area)).alias(s.area))
                     .agg(_weight(s.weight).alias("_w"), F.min(F.col(q(s.order))).alias("_first")),
                     "pairs")
    pairs = pf.where(F.col(q(s.area)).isNotNull()).select(s.member, s.area, "_w")
    chosen = dominant_area(pairs, s).select(s.member, s.area)
    first = pf.groupBy(s.member).agg(F.min("_first").alias("_first"))
    per_area = (chosen.join(first, s.member)
                .groupBy(s.area)
                .agg(F.min("_first").alias("_first"), F.count(F.lit(1)).alias("_size")))
    numbered = range_sequence(per_area, [F.col("_first"), F.col(q(s.area))], out="_gid")
    labels = (first.select(s.member)
              .join(chosen, s.member, "left")
              .join(numbered.select(s.area, "_gid", "_size"), s.area, "left"))
    keep = F.col("_gid").isNotNull()
    if relabel_singletons:
        keep = keep & (F.col("_size") > 1)
    label = (F.when(keep, F.concat(F.lit(GROUP_PREFIX), F.col("_gid").cast("string")))
             .otherwise(F.concat(F.lit(INDEPENDENT_PREFIX), F.col(q(s.member)))))
    extra = [F.col("_first").alias(keep_first)] if keep_first else []
    if keep_first:
        labels = labels.join(first, s.member)
    return labels.select(s.member, label.alias(s.group), *extra)


def relabel_singletons(labels: DataFrame, member: str = "county", group: str = "county_groups") -> DataFrame:
    """``county_group_*`` labels held by exactly one member become
    ``independent_county_<member>``."""
    sizes = (labels.where(F.col(q(group)).startswith(GROUP_PREFIX))
             .groupBy(group).agg(F.countDistinct(F.col(q(member))).alias("_n"))
             .where(F.col("_n") == 1).select(group, F.lit(True).alias("_single")))
    return (labels.join(sizes, group, "left")
            .withColumn(group, F.when(F.col("_single"), F.concat(F.lit(INDEPENDENT_PREFIX), F.col(q(member))))
                        .otherwise(F.col(q(group))))
            .drop("_single"))


def attach_labels(samples: DataFrame, labels: DataFrame, member: str = "county") -> DataFrame:
    """Join member labels back to every sample row (left)."""
    return samples.join(labels, member, "left")


def split_by_zone(frame: DataFrame, member: str = "county", group: str = "county_groups",
                  zone: str = "R") -> DataFrame:
    """Split every ``county_group_*`` whose members lie in several zones.

    Zones are ranked per group by (distinct members desc, zone asc), a
    null zone counting as the value ``__MISSING__``; the first keeps the
    label; every other (group, zone) gets ``county_group_<max+1>``,
    ``<max+2>`` ... in order of group name as text, then zone rank, where
    max is the highest number in use.  Members are relabelled everywhere
    they occur.
    """
    level = (frame.select(F.col(q(member)).alias(member), F.col(q(group)).alias(group),
                          F.coalesce(F.col(q(zone)), F.lit(MISSING_ZONE)).alias("_zkey"))
             .distinct())
    grouped = level.where(F.coalesce(F.col(q(group)).startswith(GROUP_PREFIX), F.lit(False)))
    stats = grouped.groupBy(group, "_zkey").agg(F.countDistinct(F.col(q(member))).alias("_n"))
    primary = pick_per_group(stats, [group], ["_zkey"], desc=["_n"], asc=["_zkey"])
    extra = stats.join(primary, [group, "_zkey"], "left_anti")
    ids = F.regexp_extract(F.col(q(group)), r"^county_group_(\d+)$", 1)
    above = level.select(F.max(F.when(ids != "", ids.cast("long"))) + 1).scalar()
    start = F.coalesce(above, F.lit(0).cast("long"))
    renumbered = range_sequence(extra, [F.col(q(group)), -F.col("_n"), F.col("_zkey")], out="_nid", start=start)
    moved = (grouped.join(renumbered.select(group, "_zkey", "_nid"), [group, "_zkey"])
             .select(member, F.concat(F.lit(GROUP_PREFIX), F.col("_nid").cast("string")).alias("_new")))
    return (frame.join(moved, member, "left")
            .withColumn(group, F.coalesce(F.col("_new"), F.col(q(group))))
            .drop("_new"))


@dataclass(frozen=True)
class MergeResult:
    result: DataFrame
    report: DataFrame


def zone_violations(frame: DataFrame, member: str = "county", group: str = "county_groups",
                    zone: str = "R") -> DataFrame:
    """Groups whose members lie in more than one (non-null) zone, with the
    zones.  After the split only ``independent_county_*`` groups that
    absorbed imputed members can appear here; they are reported, not
    changed."""
    level = frame.select(member, group, zone).where(F.col(q(zone)).isNotNull()).distinct()
    return (level.groupBy(group)
            .agg(F.countDistinct(F.col(q(zone))).alias("n_zones"),
                 F.array_join(F.sort_array(F.collect_set(F.col(q(zone)))), ",").alias("zones"))
            .where(F.col("n_zones") > 1))


def group_zones(frame: DataFrame, group: str = "county_groups", zone: str = "R",
                order: Sequence[Column | str] = ()) -> DataFrame:
    """Zone of each group: its first non-null zone in ``order`` (lowest zone
    when no order is given)."""
    nonnull = frame.where(F.col(q(zone)).isNotNull() & F.col(q(group)).isNotNull())
    return pick_per_group(nonnull, [group], [zone], asc=list(order) + [F.col(q(zone))])


def merge_groups(frame: DataFrame, specs: DataFrame, group: str = "county_groups", zone: str = "R",
                 order: Sequence[Column | str] = (), spec_order: str | None = None) -> MergeResult:
    """Relabel ``source`` groups to ``target`` when both have the same zone
    (two missing zones count as equal).

    One pass, not transitive; for a source listed twice the last allowed
    spec (by ``spec_order``) wins.  ``report`` lists every spec with both
    zones, whether the source exists, and the decision.
    """
    require_columns(specs, ["source_group", "target_group"])
    zones = group_zones(frame, group, zone, order)
    present = frame.select(F.col(q(group)).alias("source_group")).distinct().withColumn("source_present", F.lit(True))
    src = zones.select(F.col(q(group)).alias("source_group"), F.col(q(zone)).alias("source_zone"))
    tgt = zones.select(F.col(q(group)).alias("target_group"), F.col(q(zone)).alias("target_zone"))
    gated = (specs.join(src, "source_group", "left").join(tgt, "target_group", "left")
             .join(present, "source_group", "left")
             .withColumn("source_present", F.coalesce(F.col("source_present"), F.lit(False)))
             .withColumn("merged", F.col("source_zone").eqNullSafe(F.col("target_zone"))))
    report = gated.select("source_group", "target_group", "source_zone", "target_zone",
                          "source_present", "merged",
                          F.when(~F.col("merged"), F.lit("zone mismatch"))
                          .when(~F.col("source_present"), F.lit("absent source"))
                          .otherwise(F.lit("merged")).alias("decision"))
    allowed = gated.where(F.col("merged"))
    if spec_order:
        mapping = allowed.groupBy("source_group").agg(F.max_by("target_group", spec_order).alias("_to"))
    else:
        mapping = allowed.groupBy("source_group").agg(F.max("target_group").alias("_to"))
    # The mapping holds at most one row per spec; AQE broadcasts it at runtime.
    result = (frame.join(mapping.withColumnRenamed("source_group", group), group, "left")
              .withColumn(group, F.coalesce(F.col("_to"), F.col(q(group))))
              .drop("_to"))
    return MergeResult(result=result, report=report)


def placeholder_members(samples: DataFrame, reference: DataFrame, crosswalk: DataFrame,
                        key: str = "county_fips5", member: str = "county", area: str = "puma",
                        group: str = "county_groups", weight: str = "weight",
                        order: str = "bldgid", extra: dict[str, Column] | None = None) -> DataFrame:
    """One placeholder row per reference member absent from the samples.

    The member's area is its crosswalk area with most rows (tie: lowest
    code); its group is the area's group with the largest summed weight
    among the samples (tie: lowest name), else
    ``independent_county_<member>``.  Placeholders get ``dummy_<key>`` as
    order id and weight 0.  ``reference`` needs ``key`` and ``member``;
    every other column of it with a sample-table name is carried over.
    """
    missing = anti_join(reference, samples, key)
    tract_counts = crosswalk.na.drop(subset=[key, area]).groupBy(key, area).agg(F.count(F.lit(1)).alias("_n"))
    primary = pick_per_group(tract_counts, [key], [area], desc=["_n"], asc=[area])
    weights = (samples.na.drop(subset=[area, group]).groupBy(area, group)
               .agg(_weight(weight).alias("_w")))
    majority = pick_per_group(weights, [area], [group], desc=["_w"], asc=[group])
    dummies = (missing.join(primary, key, "left").join(majority, area, "left")
               .withColumn(group, F.coalesce(F.col(q(group)),
                                             F.concat(F.lit(INDEPENDENT_PREFIX), F.col(q(member)))))
               .withColumn(order, F.concat(F.lit("dummy_"), F.col(q(key))))
               .withColumn(weight, F.lit(0).cast(samples.schema[weight].dataType)))
    for name, expr in (extra or {}).items():
        dummies = dummies.withColumn(name, expr)
    return dummies.select(*[c for c in samples.columns if c in dummies.columns])


def with_placeholders(samples: DataFrame, placeholders: DataFrame, order: str = "bldgid") -> DataFrame:
    """The samples and the placeholder rows, order ids as text."""
    base = samples.withColumn(order, F.col(q(order)).cast("string"))
    return base.unionByName(placeholders, allowMissingColumns=True)


def impute_missing_members(samples: DataFrame, reference: DataFrame, crosswalk: DataFrame,
                           order: str = "bldgid", **options) -> DataFrame:
    """The samples plus one ``placeholder_members`` row per missing member."""
    return with_placeholders(samples, placeholder_members(samples, reference, crosswalk, order=order, **options), order)


@dataclass(frozen=True)
class GroupingResult:
    rows: DataFrame
    members: DataFrame
    mapping: DataFrame
    merge_report: DataFrame | None
    violations: DataFrame


def build_county_groups(samples: DataFrame, zone_of: Column | None = None,
                        zones: DataFrame | None = None, reference: DataFrame | None = None,
                        crosswalk: DataFrame | None = None, specs: DataFrame | None = None,
                        spec: GroupingSpec = GroupingSpec(), key: str = "county_fips5",
                        zone: str = "R") -> GroupingResult:
    """The whole county-group job: assign, impute missing members, attach
    zones, split by zone, apply gated merges, list the mapping.

    The chain runs on a member-level table (one row per county with its
    first order key; imputed members sort after every sampled one),
    materialised so its several uses do not recompute the sample
    aggregates; labels are joined back to the sample rows once at the end.
    Zones come either as an expression of the member (``zone_of``) or as a
    lookup table (``zones``: ``key``, ``zone``).

    Rows have the columns of ``ROW_COLUMNS`` first, in that order, then any
    others; the mapping has those of ``MAPPING_COLUMNS`` that the samples
    carry; ``violations`` lists groups that still span zones.
    """
    s = spec
    members = assign_groups(samples, s, keep_first="first_order")
    rows = attach_labels(samples, members.drop("first_order"), s.member)
    if reference is not None and crosswalk is not None:
        placeholders = materialize(placeholder_members(
            rows, reference, crosswalk, key=key, member=s.member, area=s.area, group=s.group, weight=s.weight,
            order=s.order), "placeholders")
        rows = with_placeholders(rows, placeholders, s.order)
        members = members.unionByName(placeholders.select(
            s.member, s.group, F.lit(None).cast(members.schema["first_order"].dataType).alias("first_order")))
    if zone_of is not None:
        members = members.withColumn(zone, zone_of)
    elif zones is not None:
        keyed = rows.select(s.member, key).distinct()
        members = members.join(keyed, s.member, "left").join(zones, key, "left").drop(key)
    else:
        members = members.withColumn(zone, F.lit(None).cast("string"))
    members = materialize(members, "members")
    members = split_by_zone(members, s.member, s.group, zone)
    report = None
    if specs is not None:
        order = [F.col("first_order").isNull(), F.col("first_order")]
        merged = merge_groups(members, specs, s.group, zone, order=order,
                              spec_order="spec_order" if "spec_order" in specs.columns else None)
        members, report = merged.result, merged.report
    members = materialize(members, "members_final")
    final = members.select(s.member, s.group, zone)
    # one row per county on the right: a large county splits as a skewed join
    rows = rows.drop(s.group, zone).join(final, s.member, "left")
    first = [c for c in ROW_COLUMNS if c in rows.columns]
    rows = rows.select(*first, *[c for c in rows.columns if c not in first])
    listed = [c for c in MAPPING_COLUMNS if c in rows.columns]
    mapping = (rows.select(*listed).distinct()
               .orderBy(*[F.col(q(c)).asc_nulls_last() for c in ("state", key, zone, s.group, s.member) if c in listed]))
    return GroupingResult(rows=rows, members=members, mapping=mapping, merge_report=report,
                          violations=zone_violations(members, s.member, s.group, zone))
