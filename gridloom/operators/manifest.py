"""Object-manifest selection and transfer reports.

A manifest is a DataFrame of (``key``, ``size``) rows: a listing table, or
Spark's ``binaryFile`` source metadata (see ``sources.manifest``).  The
selection filters are column expressions on the key, evaluated in one
scan; path segments ``k=v`` become columns with ``regexp_extract``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.codes import STATE_TO_FIPS, state_fips_prefix
from gridloom.functions.scalars import format_bytes

# Fixed value: how an upgrade number stands in an object's file name.
UPGRADE_IN_NAME = r"(?:^|_)upgrade(\d+)(?:_|\.|$)"


def _segment_value(rel: Column, name: str) -> Column:
    """Value of the last ``name=value`` directory segment of a relative key
    (file name excluded); null when absent."""
    dirs = F.regexp_replace(rel, r"[^/]*$", "")
    return F.nullif(F.regexp_extract(dirs, rf"(?:^|.*/){name}=([^/]*)/", 1), F.lit(""))


def file_name(rel: Column) -> Column:
    return F.element_at(F.split(rel, "/"), -1)


@dataclass(frozen=True)
class Selection:
    upgrades: Sequence[str] | None = None
    states: Sequence[str] | None = None
    counties: Sequence[str] | None = None
    version: str | None = None
    extensions: Sequence[str] | None = (".csv",)
    county_data: bool = False
    state_name_tokens: bool = False


def _validate_states(states: Iterable[str]) -> list[str]:
    wanted = [s.strip().upper() for s in states if s and s.strip()]
    unknown = [s for s in wanted if s not in STATE_TO_FIPS]
    if unknown:
        raise ValueError(f"unknown state abbreviations: {unknown}")
    return wanted


def select_objects(manifest: DataFrame, prefix: str = "", sel: Selection = Selection(),
                   key: str = "key") -> DataFrame:
    """Keep manifest rows under ``prefix`` matching the selection.

    * extension: key ends with any of ``extensions`` (None keeps all);
    * version: first segment after ``prefix`` equals it;
    * upgrade: the ``upgrade=`` segment if any, else ``upgradeN`` in the
      file name; keys with neither are kept;
    * county data: ``county=`` segment (upper-cased) in ``counties``, and
      its state part in the FIPS codes of ``states`` (a non-``G`` code has
      no state part and is dropped; a missing segment is kept);
    * otherwise: the ``state=`` segment in ``states``, else a state code in
      the upper-cased file name (substring, or whole ``_.-`` token with
      ``state_name_tokens``).
    """
    k = F.col(key)
    rel = F.substring(k, len(prefix) + 1, 1 << 30) if prefix else k
    # Only keys under the prefix are listed (a pushed-down StartsWith).
    cond = k.startswith(prefix) if prefix else F.lit(True)
    if sel.extensions is not None:
        ext = F.lit(False)
        for e in sel.extensions:
            ext = ext | k.endswith(e)
        cond = cond & ext
    if sel.version:
        cond = cond & (F.split(rel, "/").getItem(0) == F.lit(sel.version))
    if sel.upgrades:
        ups = [str(u) for u in sel.upgrades]
        seg = _segment_value(rel, "upgrade")
        named = F.nullif(F.regexp_extract(file_name(rel), UPGRADE_IN_NAME, 1), F.lit(""))
        up = F.coalesce(seg, named)
        cond = cond & (up.isNull() | up.isin(ups))
    if sel.county_data:
        county = F.upper(F.coalesce(_segment_value(rel, "county"), F.lit("")))
        if sel.counties:
            cond = cond & county.isin([c.strip().upper() for c in sel.counties])
        if sel.states:
            fips = [STATE_TO_FIPS[s] for s in _validate_states(sel.states)]
            cond = cond & ((county == "") | state_fips_prefix(county).isin(fips))
    elif sel.states:
        wanted = _validate_states(sel.states)
        seg = F.upper(F.coalesce(_segment_value(rel, "state"), F.lit("")))
        name = F.upper(file_name(rel))
        if sel.state_name_tokens:
            tokens = F.split(name, r"[_.\-]")
            in_name = F.exists(tokens, lambda t: t.isin(wanted))
        else:
            in_name = F.lit(False)
            for s in wanted:
                in_name = in_name | name.contains(s)
        cond = cond & F.when(seg != "", seg.isin(wanted)).otherwise(in_name)
    return manifest.where(cond)


def selection_totals(selected: DataFrame, size: str = "size") -> DataFrame:
    """File count, total bytes and the readable total."""
    return (selected.agg(F.count(F.lit(1)).alias("n_files"),
                         F.coalesce(F.sum(size), F.lit(0)).alias("total_bytes"))
            .withColumn("total_size", F.trim(format_bytes("total_bytes"))))


def transfer_status(selected: DataFrame, inventory: DataFrame, failures: DataFrame | None = None,
                    key: str = "key", size: str = "size") -> DataFrame:
    """Status per selected object: ``skipped`` when the inventory already
    holds it with size > 0, ``error`` when it is in ``failures``, else
    ``ok``."""
    have = inventory.where(F.col(size) > 0).select(key).distinct().withColumn("_have", F.lit(True))
    out = selected.join(have, key, "left")
    if failures is not None:
        out = out.join(failures.select(key).distinct().withColumn("_fail", F.lit(True)), key, "left")
        failed = F.coalesce(F.col("_fail"), F.lit(False))
    else:
        failed = F.lit(False)
    status = (F.when(F.coalesce(F.col("_have"), F.lit(False)), F.lit("skipped"))
              .when(failed, F.lit("error")).otherwise(F.lit("ok")))
    return out.withColumn("status", status).drop("_have", "_fail")


def status_report(statuses: DataFrame, size: str = "size") -> DataFrame:
    """Objects and bytes per status."""
    return statuses.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"),
                                          F.sum(size).alias("total_bytes"))


def expand_prefixes(base: str, **levels: Sequence[str]) -> list[str]:
    """Listing prefixes for every combination of the given path levels,
    e.g. ``expand_prefixes("ts/", upgrade=["0","1"], state=["AL"])``.

    This expands *parameters* (a handful of user-given values) on the
    driver; it never touches data.
    """
    out = [base]
    for name, values in levels.items():
        out = [f"{p}{name}={v}/" for p in out for v in values]
    return out
