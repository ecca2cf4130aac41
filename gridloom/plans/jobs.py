"""The user-visible jobs, each a reader -> operators -> writer composition
with function parameters in place of command-line flags.  Every job builds
one lazy plan per output and runs one action at its sink."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.columns import find_timestamp_column, measure_types
from gridloom.operators import grouping as grp
from gridloom.operators import manifest as mf
from gridloom.functions.scalars import last_token_label
from gridloom.operators.diagnostics import (
    Measure, collect_members, count_histogram, drill_rollup, top_k_by_count, validity_report,
)
from gridloom.operators.joins import key_audit
from gridloom.operators.ledger import ChunkLedger, folder_below, folder_versions
from gridloom.operators.timeseries import (
    melt_rollup, merge_wide_partials, month_hour_profile, share_of_total, state_rollup, sum_by_truncated_time,
    wide_partials,
)
from gridloom.session import materialize
from gridloom.sinks import layout, writers
from gridloom.sources import files
from gridloom.sources.census import read_county_reference, read_tract_crosswalk

GAP_ENERGY_COL = "out.electricity.total.energy_consumption..kwh"


def long_end_use_table(spark: SparkSession, input_dir: str, glob: str = "*.csv",
                       end_uses: Iterable[str] | None = None, keep_15min: bool = False,
                       by_building_type: bool = False, types: dict[str, str] | None = None,
                       multi_line: bool = False) -> DataFrame:
    """Wide end-use CSV tree -> long table (hour-ending, optionally per
    building type).  Columns are matched by header name across files.

    Measures are numbers by their names; ``types`` may name those of the other
    columns, else only those few are inferred from their values."""
    raw = files.read_csv_tree(spark, input_dir, glob, lambda names: measure_types(names) | (types or {}),
                              multi_line=multi_line)
    ts = find_timestamp_column(raw.columns)
    if ts is not None:
        raw = raw.withColumn(ts, F.to_timestamp(F.col(f"`{ts}`")).cast("timestamp_ntz"))
    return melt_rollup(raw, end_uses=end_uses, unit=None if keep_15min else "hour",
                       by_building_type=by_building_type)


def long_end_use_incremental(spark: SparkSession, input_dir: str, ledger: str, glob: str = "*.csv",
                             end_uses: Iterable[str] | None = None, by_building_type: bool = False,
                             types: dict[str, str] | None = None, multi_line: bool = False) -> DataFrame:
    """``long_end_use_table`` over a tree that grows: each folder is a chunk
    whose partial aggregates are kept under ``ledger``, with headers and types.
    Only folders with new, changed or removed files are read; a folder that is
    gone is withdrawn.  The result equals one pass over the tree as it is."""
    listing = files.list_files(spark, input_dir, glob)
    folder = folder_below(F.col("path"), input_dir)
    versions = materialize(folder_versions(listing, input_dir), "versions")
    book = ChunkLedger(spark, f"{ledger}/partials")
    todo = materialize(book.pending(versions), "pending")
    new = [r["path"] for r in listing.join(todo, folder == todo["chunk"], "left_semi").select("path").collect()]
    if new:
        everything = len(new) == listing.count()
        raw = files.read_csv_tree(spark, input_dir if everything else new, glob,
                                  lambda names: measure_types(names) | (types or {}), multi_line=multi_line,
                                  index=f"{ledger}/headers", with_path="_file")
        raw = raw.withColumn("chunk", folder_below(F.col("_file"), input_dir)).drop("_file")
        ts = find_timestamp_column(raw.columns)
        if ts is not None:
            raw = raw.withColumn(ts, F.to_timestamp(F.col(f"`{ts}`")).cast("timestamp_ntz"))
        book.record(wide_partials(raw, end_uses=end_uses), todo)
    gone = book.vanished(versions)
    if not gone.isEmpty():
        book.withdraw(materialize(gone, "gone"))
    return merge_wide_partials(book.partials(), by_building_type, end_uses)


def write_long_end_use(df: DataFrame, out: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    if fmt == "csv":
        writers.write_long_csv(df, out, partition_by)
    else:
        writers.write_extract(df, out, partition_by)


def gap_by_state(spark: SparkSession, input_dir: str, out_csv: str | None = None,
                 states: Sequence[str] | None = None, single_file: bool = False, index: str | None = None) -> DataFrame:
    """County gap series -> one state series, sorted by state, timestamp;
    written as CSV parts in that order when ``out_csv`` is given (a small
    result is one part; ``single_file`` forces one).  ``index``: where the
    headers of the series are kept between runs."""
    series = files.read_county_series(spark, input_dir, GAP_ENERGY_COL, index=index)
    res = state_rollup(series, "county", GAP_ENERGY_COL, states=states)
    if out_csv and single_file:
        writers.write_sorted_csv(res.result, out_csv, ["State", "timestamp"])
    elif out_csv:
        writers.write_sorted_parts(res.result, out_csv, ["State", "timestamp"])
    return res.result


def county_groups(spark: SparkSession, samples_path: str, county_ref_path: str, crosswalk_path: str,
                  zone_path: str, specs: DataFrame | None = None, out_dir: str | None = None
                  ) -> grp.GroupingResult:
    """Sample table -> county groups constrained to one zone each, with
    missing counties imputed and gated merges applied; writes the grouped
    samples (one file per task), the mapping and the zone violations (one
    file each) as fully quoted CSVs when ``out_dir`` is given."""
    samples = grp.add_county_fips5(grp.load_samples(spark.read.parquet(samples_path)))
    reference = read_county_reference(spark, county_ref_path)
    names = reference.select("county_fips5", "county_name").dropDuplicates(["county_fips5"])
    samples = samples.join(names, "county_fips5", "left")
    crosswalk = read_tract_crosswalk(spark, crosswalk_path)
    zones = files.read_zone_lookup(spark, zone_path)
    res = grp.build_county_groups(samples, zones=zones, reference=reference, crosswalk=crosswalk,
                                  specs=specs)
    if out_dir:
        # samples: one row per building, written by every task in parallel;
        # the mapping has one row per county and stays a single file
        writers.write_quoted_csv(res.rows, f"{out_dir}/grouped_samples", single_file=False)
        writers.write_quoted_csv(res.mapping, f"{out_dir}/county_group_mapping", single_file=True)
        writers.write_quoted_csv(res.violations, f"{out_dir}/zone_violations", single_file=True)
    return res


def annual_extract(spark: SparkSession, input_dir: str, out: str | None = None,
                   state: str | None = None, partition_by: Sequence[str] = (),
                   write: bool = True, replace: bool = False) -> tuple[DataFrame, str]:
    """Partitioned Parquet tree -> one normalised extract (optionally one
    state, pruned at listing when ``state`` is a partition column).

    ``replace`` writes into an extract that is there: only the partitions (of
    ``partition_by``) that the new rows fall into are replaced, and with a
    ``state`` that state's partition even when it has no rows left.  Without ``out`` the extract goes to
    ``<input>/<aggregation>/<version>/<name>[_<STATE>]`` inferred from the
    tree.  Returns the extract frame and its output path."""
    df = writers.normalise_for_sink(files.read_parquet_tree(spark, input_dir, state=state))
    if out is None:
        root = input_dir.rstrip("/")
        first = (files.list_files(spark, root, "*.parquet").select("path")
                 .orderBy("path").limit(1).collect())
        first_path = first[0]["path"] if first else None
        out = f"{layout.infer_output_folder(root, first_path)}/{layout.extract_name(root, state)}"
    if write and replace:
        covers = [(state,)] if state is not None and list(partition_by) == ["state"] else []
        writers.replace_partitions(df, out, partition_by, covers)
    elif write:
        writers.write_extract(df, out, partition_by)
    return df, out


def group_diagnostics(rows: DataFrame, member: str = "county", group: str = "county_groups", area: str = "puma",
                      state: str = "state", code: str = "county_fips5") -> dict[str, DataFrame]:
    """The checks over grouped samples: rows and groups by kind, members per
    group with the largest groups, and per state the samples, null codes and
    codes of a wrong length."""
    kind = F.when(F.col(group).startswith(grp.GROUP_PREFIX), "group").when(
        F.col(group).startswith(grp.INDEPENDENT_PREFIX), "independent").otherwise("none")
    members = rows.select(member, group).where(F.col(member).isNotNull()).distinct()
    return {
        "by_kind": rows.groupBy(kind.alias("kind")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.countDistinct(group).alias("n_groups"),
            F.countDistinct(member).alias("n_members")),
        "group_sizes": count_histogram(members, group, "n_members", "n_groups"),
        "largest_groups": top_k_by_count(members, group, 20, "n_members"),
        "state_validity": validity_report(rows, F.col(code), state),
        "areas_per_member": count_histogram(rows.select(member, area).distinct(), member, "n_areas", "n_members"),
    }


def select_and_report(manifest: DataFrame, prefix: str, sel: mf.Selection,
                      inventory: DataFrame | None = None, failures: DataFrame | None = None,
                      failed_keys_out: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Object selection -> (selected, totals, status report); the failed
    keys go to a text file when ``failed_keys_out`` is given."""
    selected = mf.select_objects(manifest, prefix, sel)
    totals = mf.selection_totals(selected)
    inv = inventory if inventory is not None else selected.limit(0)
    statuses = mf.transfer_status(selected, inv, failures)
    if failed_keys_out:
        writers.write_key_list(statuses, failed_keys_out)
    return selected, totals, mf.status_report(statuses)


def state_series_views(series: DataFrame, ts_col: str = "timestamp", value_col: str = GAP_ENERGY_COL,
                       state_col: str = "State") -> dict[str, DataFrame]:
    """The saved views over the state series: GWh by truncated hour and
    state, GWh by month x hour of day and state, and each month x hour
    cell's share of its state's total."""
    ts = F.col(f"`{ts_col}`")
    rows = series.select(F.to_timestamp(ts).cast("timestamp_ntz").alias("ts"),
                         F.col(f"`{value_col}`").alias("kwh"), F.col(f"`{state_col}`").alias("state"))
    gwh = F.sum(F.col("kwh") / F.lit(1e6))
    by_hour = sum_by_truncated_time(rows, "ts", gwh, keys=["state"])
    profile = month_hour_profile(rows, "ts", gwh, keys=["state"])
    share = share_of_total(profile, "gwh", ["state"])
    return {"gwh_by_hour": by_hour, "month_hour_profile": profile, "share_of_state_total": share}


def mapping_views(mapping: DataFrame, boundaries: DataFrame | None = None) -> dict[str, DataFrame]:
    """The saved views over the county-group mapping: a short group label
    (``i`` for independent counties) with its set flag, member lists per
    group, drill-path counts (group > county name > state), and, given
    county boundary attributes, the key audit of ``county_fips5 = GEOID``."""
    labelled = mapping.withColumn("group_label", last_token_label(F.col("county_groups"), marker="group")) \
                      .withColumn("is_independent", F.col("group_label") == "i")
    views = {
        "labelled": labelled,
        "members": collect_members(mapping, "county_groups", "county_fips5"),
        "drill": drill_rollup(mapping, ["county_groups", "county_name", "state"], {"n_counties": Measure("count")}),
    }
    if boundaries is not None:
        views["key_audit"] = key_audit(mapping, boundaries, "county_fips5", "GEOID")
    return views
