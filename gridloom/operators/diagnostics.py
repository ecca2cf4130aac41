"""Diagnostics over group tables: counts, histograms, top-k, samples,
validity, shared-area neighbours, member lists and drill-path totals."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.columns import q
from gridloom.functions.scalars import exact_sum, not_nan
from gridloom.operators.ranking import global_sequence


def conditional_counts(df: DataFrame, counts: dict[str, Column],
                       distincts: dict[str, str] | None = None) -> DataFrame:
    """One-row report: ``count_if`` per named predicate plus distinct counts.
    With several distinct counts Spark expands each row once per column and
    exchanges the distinct values, then the one-row partials."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in counts.items()]
    aggs += [F.countDistinct(F.col(q(c))).alias(n) for n, c in (distincts or {}).items()]
    return df.agg(*aggs)


def count_histogram(df: DataFrame, key: str, count_name: str = "n_items",
                    freq_name: str = "n_keys") -> DataFrame:
    """Count of counts: rows per key, then keys per row count."""
    per_key = df.groupBy(F.col(q(key))).agg(F.count(F.lit(1)).alias(count_name))
    return per_key.groupBy(count_name).agg(F.count(F.lit(1)).alias(freq_name))


def top_k_by_count(df: DataFrame, key: str, k: int, count_name: str = "n_rows") -> DataFrame:
    """The ``k`` keys with most rows, ties by key (a distributed
    TakeOrdered: each task keeps its best ``k``)."""
    return (df.groupBy(F.col(q(key)).alias(key)).agg(F.count(F.lit(1)).alias(count_name))
            .orderBy(F.col(count_name).desc(), F.col(q(key)).asc()).limit(k))


def first_n_per_group(df: DataFrame, group: str, value: str, n: int, rank_name: str = "rn") -> DataFrame:
    """The first ``n`` distinct values per group in value order.

    ``row_number() <= n`` is planned with a partial window-group limit
    before the shuffle, so each task forwards at most ``n`` rows per group.
    """
    w = Window.partitionBy(F.col(q(group))).orderBy(F.col(q(value)).asc())
    return (df.select(group, value).distinct()
            .withColumn(rank_name, F.row_number().over(w))
            .where(F.col(rank_name) <= n)
            .withColumn(rank_name, F.col(rank_name).cast("long")))


def validity_report(df: DataFrame, code: Column, by: str, length: int = 5) -> DataFrame:
    """Per group: rows, null codes, codes of the wrong length."""
    return (df.groupBy(F.col(q(by)).alias(by))
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(code.isNull()).alias("n_null"),
                 F.count_if(code.isNull() | (F.length(code) != length)).alias("n_invalid")))


def shared_area_neighbours(samples: DataFrame, member_value: str, member: str = "county",
                           area: str = "puma", weight: str = "weight") -> DataFrame:
    """For one member: every member sharing any of its areas, with summed
    weight per (area, member).  Only the target's areas are joined, so the
    output is bounded by the target's neighbourhood, not all pairs."""
    pairs = (samples.na.drop(subset=[member, area])
             .groupBy(member, area).agg(F.sum(F.col(q(weight))).alias("weight")))
    own = pairs.where(F.col(q(member)) == F.lit(member_value)).select(area)
    return pairs.join(own, area, "left_semi")


def collect_members(frame: DataFrame, group: str, member: str, sep: str = ",",
                    out: str = "members", page: int = 10_000) -> DataFrame:
    """Sorted distinct members per group as text, in pages: (group, page,
    members, n_members); a group's pages in order, joined by ``sep``, are its
    list.

    Members are numbered over ranges of (group, member), so neither a list nor
    a task ever holds more than ``page`` members at once, whatever the group's
    size.  Groups of at most ``page`` members have page 0 only."""
    distinct = frame.select(group, member).where(F.col(q(member)).isNotNull()).distinct()
    at = global_sequence(distinct, [group, member], out="_at")
    start = at.groupBy(F.col(q(group)).alias("_group")).agg(F.min("_at").alias("_start"))
    paged = at.join(start, F.col(q(group)).eqNullSafe(F.col("_group"))).withColumn(
        "page", F.floor((F.col("_at") - F.col("_start")) / page))
    return (paged.groupBy(group, "page")
            .agg(F.array_join(F.sort_array(F.collect_list(F.col(q(member)))), sep).alias(out),
                 F.count(F.lit(1)).alias("n_members")))


class Measure(NamedTuple):
    """A measure whose state merges: ``count`` of rows, ``sum``, ``min``,
    ``max`` or ``mean`` of a column (``scale``: decimals of an exact sum)."""

    kind: str
    column: str | None = None
    scale: int | None = None

    def states(self, name: str) -> list[Column]:
        """Aggregates of rows."""
        c = None if self.column is None else F.col(q(self.column))
        if self.kind == "count":
            return [F.count(F.lit(1)).alias(name)]
        if self.kind in ("min", "max"):
            return [getattr(F, self.kind)(c).alias(name)]
        total = exact_sum(q(self.column), self.scale).alias(name)
        if self.kind == "sum":
            return [total]
        if self.kind == "mean":
            return [total, F.count(not_nan(c)).alias(f"{name} n")]
        raise ValueError(f"unknown measure {self.kind!r}")

    def merged(self, name: str) -> list[Column]:
        """Aggregates of states."""
        if self.kind in ("min", "max"):
            return [getattr(F, self.kind)(F.col(q(name))).alias(name)]
        if self.kind == "count":
            return [F.sum(F.col(q(name))).alias(name)]
        total = exact_sum(q(name), self.scale).alias(name)
        return [total] if self.kind == "sum" else [total, F.sum(F.col(q(f"{name} n"))).alias(f"{name} n")]

    def value(self, name: str) -> Column:
        c = F.col(q(name))
        return F.try_divide(c, F.col(q(f"{name} n"))).alias(name) if self.kind == "mean" else c


def drill_rollup(df: DataFrame, levels: Sequence[str], measures: dict[str, Measure]) -> DataFrame:
    """Totals at every prefix of a drill path (ROLLUP), with ``g_<level>``
    flags telling subtotal rows apart from null keys.

    Rows are aggregated to the finest cells first, and the roll-up merges the
    states of cells, so only cells are multiplied by the levels, not rows."""
    keys = [F.col(q(c)) for c in levels]
    cells = df.groupBy(*keys).agg(*[s for n, m in measures.items() for s in m.states(n)])
    rolled = cells.rollup(*keys).agg(*[s for n, m in measures.items() for s in m.merged(n)],
                                     *[F.grouping(k).alias(f"g_{c}") for k, c in zip(keys, levels)])
    return rolled.select(*keys, *[m.value(n) for n, m in measures.items()], *[F.col(q(f"g_{c}")) for c in levels])
