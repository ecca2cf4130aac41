"""Time-series rollups: hour-ending aggregation, roll-up across building
types, county -> state sums, profiles and shares.

All of these are ``groupBy().agg()`` plans: Spark runs a partial
(map-side) aggregate before each exchange, so a hot key (one state or one
hour holding a third of the rows) is combined inside every map task and
never reaches one reducer as raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.codes import county_code_to_state
from gridloom.functions.columns import (
    ELECTRICITY_PREFIX, EXCLUDED_SUBSTRING, OUTPUT_PREFIX, MeasureRules, classify_wide, default_group_keys,
    end_use_label, find_building_type_column, find_timestamp_column, q,
)
from gridloom.functions.scalars import exact_sum, not_nan
from gridloom.functions.timefns import ceil_to, trunc_to
from gridloom.operators.reshape import melt_end_uses, normalise_allow_list


def _drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Group-by in the series tools drops rows with a null key.  (An explicit
    # filter: ``na.drop(subset=...)`` cannot address names with dots.)
    if not keys:
        return df
    cond = F.col(q(keys[0])).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(q(k)).isNotNull()
    return df.where(cond)


def rollup_to_period(df: DataFrame, unit: str = "hour", ts_col: str | None = None,
                     keys: Sequence[str] | None = None,
                     rules: MeasureRules = MeasureRules(),
                     sum_scale: int | None = None, count_as: str | None = None,
                     bucketed: bool = False) -> DataFrame:
    """Stage 1: hour-ending (period-ending) aggregate.

    The timestamp is ceiled to ``unit``; keys default to every string
    column + the timestamp + ``upgrade``; energy measures are summed,
    population measures averaged.  Without a timestamp column the input is
    returned unchanged; without measures only the timestamp is relabelled.
    ``bucketed`` says the timestamp is already period-ending (see
    ``bucket_time``), so it is not recomputed.
    """
    ts = ts_col or find_timestamp_column(df.columns)
    if ts is None:
        return df
    if not bucketed:
        df = bucket_time(df, unit, ts)
    group = list(keys) if keys is not None else default_group_keys(df.schema, ts)
    if ts not in group:
        group.append(ts)
    energy, pop = rules.split(df.columns, group)
    if not energy and not pop:
        return df
    aggs = [exact_sum(q(c), sum_scale).alias(c) for c in energy]
    aggs += [F.avg(not_nan(F.col(q(c)))).alias(c) for c in pop]
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    return _drop_null_keys(df, group).groupBy(*[F.col(q(k)) for k in group]).agg(*aggs)


def bucket_time(df: DataFrame, unit: str = "hour", ts_col: str | None = None) -> DataFrame:
    """Replace the timestamp by its period-ending label.  Apply it to the
    wide table *before* a melt: the timestamp is an id column, so the result
    is the same and the label is computed once per wide row instead of once
    per end use."""
    ts = ts_col or find_timestamp_column(df.columns)
    if ts is None:
        return df
    return df.withColumn(ts, ceil_to(unit, F.col(q(ts)), df.schema[ts].dataType))


def rollup_across(df: DataFrame, drop_key: str | None = None, ts_col: str | None = None,
                  keys: Sequence[str] | None = None,
                  rules: MeasureRules = MeasureRules(),
                  sum_scale: int | None = None) -> DataFrame:
    """Stage 2: sum over one dimension (the building type by default).

    Energy and population measures are both summed.  With no such column,
    or no measure, the input is returned unchanged.
    """
    bt = drop_key or find_building_type_column(df.columns)
    if bt is None or bt not in df.columns:
        return df
    ts = ts_col or find_timestamp_column(df.columns)
    if keys is None:
        group = [c for c in default_group_keys(df.schema, ts) if c != bt]
    else:
        group = [k for k in keys if k != bt]
    energy, pop = rules.split(df.columns, group + [bt])
    if not energy and not pop:
        return df
    aggs = [exact_sum(q(c), sum_scale).alias(c) for c in energy]
    aggs += [exact_sum(q(c), None).alias(c) for c in pop]
    return _drop_null_keys(df, group).groupBy(*[F.col(q(k)) for k in group]).agg(*aggs)


def long_end_use(df: DataFrame, unit: str | None = "hour", by_building_type: bool = False,
                 ts_col: str | None = None, building_type_col: str | None = None,
                 keys: Sequence[str] | None = None,
                 rules: MeasureRules = MeasureRules(),
                 sum_scale: int | None = None, bucketed: bool = False) -> DataFrame:
    """Roll a melted end-use table up: stage 1 to ``unit`` (``None`` keeps
    the 15-minute grain and does no aggregation), stage 2 across building
    types unless ``by_building_type``.  ``bucketed``: the timestamp was
    already labelled by ``bucket_time`` before the melt."""
    if unit is None:
        return df
    ts = ts_col or find_timestamp_column(df.columns)
    if ts is None:
        return df
    out = rollup_to_period(df, unit=unit, ts_col=ts, keys=keys, rules=rules, sum_scale=sum_scale,
                           bucketed=bucketed)
    if by_building_type:
        return out
    return rollup_across(out, drop_key=building_type_col, ts_col=ts,
                         keys=None if keys is None else list(keys), rules=rules,
                         sum_scale=sum_scale)


def merge_partials(parts: DataFrame, keys: Sequence[str], sums: Sequence[str],
                   means: dict[str, tuple[str, str]] | None = None,
                   sum_scale: int | None = None) -> DataFrame:
    """Re-aggregate partial aggregates (from chunks, batches or files).

    ``sums`` (sums and counts) are re-summed; each ``means`` entry
    ``out -> (sum_col, count_col)`` is rebuilt as sum / count, so the
    result equals a single pass whatever the chunking.  (Averaging
    averages, or summing them, would not.)
    """
    aggs = [exact_sum(q(c), sum_scale).alias(c) for c in sums]
    out = parts.groupBy(*[F.col(q(k)) for k in keys]).agg(*aggs)
    for name, (s_col, n_col) in (means or {}).items():
        out = out.withColumn(name, F.try_divide(F.col(q(s_col)), F.col(q(n_col))))  # no value: null
    return out


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Aggregation without measures: one row per key combination."""
    return df.select(*[F.col(q(k)) for k in keys]).dropDuplicates()


@dataclass(frozen=True)
class StateRollup:
    result: DataFrame
    rejected: DataFrame


def state_rollup(df: DataFrame, code_col: str, value_col: str, ts_col: str = "timestamp",
                 states: Sequence[str] | None = None, parent: Column | None = None,
                 parent_name: str = "State", sum_scale: int | None = None) -> StateRollup:
    """Sum a county series to its parent (state) by timestamp.

    ``parent`` defaults to the state of a ``G`` county code.  Rows whose
    code maps to nothing are routed to ``rejected`` (count per code) rather
    than silently lost; ``states`` (upper-cased) filters the parents before
    the aggregate, which Spark pushes down to the scan where it can.
    The result is (timestamp, value, parent); a sink that needs an order
    sorts it.
    """
    par = parent if parent is not None else county_code_to_state(F.col(q(code_col)))
    tagged = df.withColumn("_parent", par)
    rejected = (tagged.where(F.col("_parent").isNull())
                .groupBy(F.col(q(code_col)).alias(code_col)).agg(F.count(F.lit(1)).alias("n_rows")))
    kept = tagged.where(F.col("_parent").isNotNull())
    if states:
        kept = kept.where(F.col("_parent").isin([s.strip().upper() for s in states]))
    result = (kept.groupBy(F.col("_parent").alias(parent_name), F.col(q(ts_col)).alias(ts_col))
              .agg(exact_sum(q(value_col), sum_scale).alias(value_col))
              .select(F.col(q(ts_col)), F.col(q(value_col)), F.col(q(parent_name))))
    return StateRollup(result=result, rejected=rejected)


def sum_by_truncated_time(df: DataFrame, ts_col: str, value: Column, unit: str = "hour",
                          keys: Sequence[str] = (), out_ts: str = "ts_hour",
                          out_value: str = "gwh") -> DataFrame:
    """SUM(value) x truncated time (hour-beginning buckets)."""
    dtype = df.schema[ts_col].dataType
    return (df.groupBy(trunc_to(unit, F.col(q(ts_col)), dtype).alias(out_ts), *[F.col(q(k)) for k in keys])
            .agg(value.alias(out_value)))


def month_hour_profile(df: DataFrame, ts_col: str, value: Column, keys: Sequence[str] = (),
                       out_value: str = "gwh") -> DataFrame:
    """SUM(value) by month x hour of day (the load-shape grid)."""
    return (df.groupBy(*[F.col(q(k)) for k in keys],
                       F.month(F.col(q(ts_col))).alias("month"),
                       F.hour(F.col(q(ts_col))).alias("hour"))
            .agg(value.alias(out_value)))


def share_of_total(agg: DataFrame, value_col: str, partition: Sequence[str],
                   out: str = "share") -> DataFrame:
    """value / total of its partition, on an already-aggregated frame.

    Totals come from a second partial+final aggregate joined back on the
    partition keys (one row per key; AQE broadcasts it when small), so a
    partition holding most of the cells is still summed map-side instead of
    landing whole in one window task.
    """
    keys = [q(p) for p in partition]
    totals = agg.groupBy(*[F.col(k).alias(f"_p{i}") for i, k in enumerate(keys)]).agg(
        F.sum(F.col(q(value_col))).alias("_total"))
    same = F.lit(True)
    for i, k in enumerate(keys):  # a null partition is a partition too
        same = same & F.col(k).eqNullSafe(F.col(f"_p{i}"))
    return (agg.join(totals, same)
            .withColumn(out, F.col(q(value_col)) / F.col("_total"))
            .drop("_total", *[f"_p{i}" for i in range(len(keys))]))


def melt_rollup(df: DataFrame, end_uses=None, unit: str | None = "hour", by_building_type: bool = False,
                ts_col: str | None = None, building_type_col: str | None = None,
                rules: MeasureRules = MeasureRules(), sum_scale: int | None = None,
                label=None, value_prefix: str | None = None, drop_prefix: str | None = "out.",
                exclude_substring: str | None = "savings", value_columns=None,
                var_name: str = "end_use", value_name: str = "kWh") -> DataFrame:
    """Melt + hour-ending rollup + roll-up across building types, computed
    on the *wide* table and melted last.

    Same result as ``long_end_use(melt_end_uses(df))``: each wide row
    gives exactly one long row per end use, so a per-(keys, end use) sum
    is a column sum over wide rows and a population mean per (keys, end
    use) is the mean over wide rows.  Aggregating first means the shuffles
    carry one wide row per key and period instead of one row per end use
    (key columns are not repeated), the hash tables hold fewer keys, and
    the unpivot only expands the final aggregates.  End-use columns sharing
    a label are summed column-wise before the melt.
    """
    label = label or end_use_label
    layout, pairs = _end_use_columns(df.columns, end_uses, label, value_prefix, drop_prefix, exclude_substring, value_columns)
    ts = ts_col or find_timestamp_column(df.columns)
    if unit is None or ts is None or not pairs:
        long = melt_end_uses(df.select(*[F.col(q(c)) for c in layout.ids + [p for p, _ in pairs]]),
                             end_uses=end_uses, value_columns=[p for p, _ in pairs], label=label,
                             value_prefix=value_prefix or ELECTRICITY_PREFIX, drop_prefix=drop_prefix,
                             exclude_substring=exclude_substring, var_name=var_name, value_name=value_name)
        return long if unit is None or ts is None else long_end_use(
            long, unit=unit, by_building_type=by_building_type, ts_col=ts,
            building_type_col=building_type_col, rules=rules, sum_scale=sum_scale)
    keys, id_energy, pop = _roles(df, layout.ids, ts, rules)
    values = [c for c, _ in pairs] + id_energy
    wide = bucket_time(df.select(*[F.col(q(c)) for c in layout.ids + [p for p, _ in pairs]]), unit, ts)
    aggs = [exact_sum(q(c), sum_scale).alias(c) for c in values]
    aggs += [F.avg(not_nan(F.col(q(c)))).alias(c) for c in pop]
    out = _drop_null_keys(wide, keys).groupBy(*[F.col(q(k)) for k in keys]).agg(*aggs)
    bt = building_type_col or find_building_type_column(layout.ids)
    return _melt_totals(out, keys, pairs, id_energy, pop, None if by_building_type else bt, sum_scale, var_name, value_name)


def _end_use_columns(columns, end_uses, label, value_prefix, drop_prefix, exclude_substring, value_columns):
    """The column layout, and (column, label) of the allowed end uses."""
    layout = classify_wide(columns, value_prefix=value_prefix or ELECTRICITY_PREFIX, drop_prefix=drop_prefix,
                           exclude_substring=exclude_substring, value_columns=value_columns)
    allow = normalise_allow_list(end_uses)
    return layout, [(c, label(c)) for c in layout.values if allow is None or label(c).lower() in allow]


def _roles(df: DataFrame, ids: Sequence[str], ts: str, rules: MeasureRules) -> tuple[list[str], list[str], list[str]]:
    """(keys, energy, population) among the id columns."""
    keys = default_group_keys(df.select(*[F.col(q(c)) for c in ids]).schema, ts)
    return (keys, *rules.split(ids, keys))


def _melt_totals(out: DataFrame, keys: list[str], pairs: list[tuple[str, str]], id_energy: list[str], pop: list[str],
                 across: str | None, sum_scale: int | None, var_name: str, value_name: str) -> DataFrame:
    """Wide period totals, summed over the key ``across`` if there is one, and melted."""
    if across in keys:
        keys = [k for k in keys if k != across]
        aggs = [exact_sum(q(c), sum_scale).alias(c) for c in [c for c, _ in pairs] + id_energy]
        aggs += [exact_sum(q(c), None).alias(c) for c in pop]
        out = out.groupBy(*[F.col(q(k)) for k in keys]).agg(*aggs)
    # one column per distinct label (duplicates summed), then the melt
    by_label: dict[str, list[str]] = {}
    for c, lab in pairs:
        by_label.setdefault(lab, []).append(c)
    names, kept = list(by_label), [F.col(q(c)) for c in keys + id_energy + pop]
    summed = [sum((F.col(q(c)) for c in cols[1:]), F.col(q(cols[0]))).alias(f"_l{i}") for i, cols in enumerate(by_label.values())]
    long = out.select(*kept, *summed).unpivot(kept, [F.col(f"_l{i}") for i in range(len(names))], "_slot", value_name)

    def by_slot(values: Sequence) -> Column:
        return F.element_at(F.create_map(*[x for i, v in enumerate(values) for x in (F.lit(f"_l{i}"), F.lit(v))]), F.col("_slot"))

    # melting first gives an id-side energy once per end-use column, so a
    # label shared by several columns holds it as often
    times = by_slot([len(by_label[n]) for n in names])
    return long.select(*[F.col(q(k)) for k in keys], by_slot(names).alias(var_name), F.col(q(value_name)),
                       *[(F.col(q(c)) * times).alias(c) for c in id_energy], *[F.col(q(c)) for c in pop])


#: Suffix of the column that counts the values behind a partial population sum.
COUNT = "__n"


def wide_partials(df: DataFrame, end_uses=None, unit: str = "hour", ts_col: str | None = None,
                  rules: MeasureRules = MeasureRules(), sum_scale: int | None = None) -> DataFrame:
    """The totals behind ``melt_rollup`` in a form that merges: per period and
    keys (text columns, so a chunk's name is one) the sum of each end-use
    column and each energy, and of population measures sum and count.  Columns
    keep their names, so chunks with other end uses merge too."""
    layout, pairs = _end_use_columns(df.columns, end_uses, end_use_label, None, OUTPUT_PREFIX, EXCLUDED_SUBSTRING, None)
    ts = ts_col or find_timestamp_column(df.columns)
    if ts is None:
        raise KeyError("period totals need a timestamp column")
    keys, id_energy, pop = _roles(df, layout.ids, ts, rules)
    values = [c for c, _ in pairs] + id_energy
    wide = bucket_time(df.select(*[F.col(q(c)) for c in keys + values + pop]), unit, ts)
    aggs = [exact_sum(q(c), sum_scale).alias(c) for c in values]
    for c in pop:
        aggs += [exact_sum(q(c), None).alias(c), F.count(not_nan(F.col(q(c)))).alias(c + COUNT)]
    return _drop_null_keys(wide, keys).groupBy(*[F.col(q(k)) for k in keys]).agg(*aggs or [F.lit(0).alias(COUNT)])


def merge_wide_partials(parts: DataFrame, by_building_type: bool = False, end_uses=None, ignore: Sequence[str] = ("chunk",),
                        ts_col: str | None = None, building_type_col: str | None = None,
                        rules: MeasureRules = MeasureRules(), sum_scale: int | None = None,
                        var_name: str = "end_use", value_name: str = "kWh") -> DataFrame:
    """The long end-use table from ``wide_partials`` of any number of chunks:
    equals ``melt_rollup`` over all their rows."""
    layout, pairs = _end_use_columns([c for c in parts.columns if c not in ignore], end_uses, end_use_label, None,
                                     OUTPUT_PREFIX, EXCLUDED_SUBSTRING, None)
    ids = [c for c in layout.ids if not c.endswith(COUNT)]
    keys, id_energy, pop = _roles(parts, ids, ts_col or find_timestamp_column(ids), rules)
    if not pairs:
        return melt_end_uses(parts.select(*[F.col(q(c)) for c in ids]), value_columns=[], var_name=var_name, value_name=value_name)
    merged = merge_partials(parts, keys, [c for c, _ in pairs] + id_energy + pop + [p + COUNT for p in pop],
                            {p: (p, p + COUNT) for p in pop}, sum_scale)
    bt = building_type_col or find_building_type_column(ids)
    return _melt_totals(merged, keys, pairs, id_energy, pop, None if by_building_type else bt, sum_scale, var_name, value_name)
