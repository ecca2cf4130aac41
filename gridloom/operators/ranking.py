"""Ranking without single-task windows.

* ``pick_per_group`` - top-1 per group with a full tie-break, written as a
  ``min_by`` aggregate over a struct key: Spark combines it map-side, so a
  group holding a third of all rows is reduced inside every map task.
* ``global_sequence`` - consecutive 0-based ids in a global order, computed
  distributed: range-partition + sort, per-partition counts (one row per
  partition) and offsets.  No window without a partition clause, nothing
  on the driver.
* ``range_sequence`` - the same in one plan with nothing stored between:
  fixed range bounds, counts per range, rank in the range.
* ``first_seen_ordinal`` - "numbered in order of first appearance" as the
  sequence over each item's first order key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from gridloom.functions.columns import q
from gridloom.session import ensure_checkpoint_dir, materialize


def _col(c: Column | str) -> Column:
    return F.col(q(c)) if isinstance(c, str) else c


def order_key(desc: Sequence[Column | str] = (), asc: Sequence[Column | str] = ()) -> Column:
    """A struct that sorts ascending like ORDER BY desc... DESC, asc... ASC.

    Descending keys must be numeric (they are negated); a null, of either
    direction, comes after every value.
    """
    parts = []
    for i, c in enumerate(desc):
        parts += [_col(c).isNull().alias(f"dn{i}"), (-_col(c)).alias(f"d{i}")]
    for i, c in enumerate(asc):
        parts += [_col(c).isNull().alias(f"an{i}"), _col(c).alias(f"a{i}")]
    return F.struct(*parts)


def pick_per_group(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                   desc: Sequence[Column | str] = (), asc: Sequence[Column | str] = ()) -> DataFrame:
    """For each ``keys`` group, the ``values`` of the first row in the order
    (``desc`` descending, then ``asc`` ascending).  Give a tie-break that
    makes the order total, or the pick among equal rows is arbitrary."""
    pick = F.min_by(F.struct(*[_col(v).alias(v) for v in values]), order_key(desc, asc))
    return (df.groupBy(*[_col(k) for k in keys]).agg(pick.alias("_pick"))
            .select(*[_col(k) for k in keys], *[F.col(f"_pick.{q(v)}").alias(v) for v in values]))


def global_sequence(df: DataFrame, order: Sequence[Column | str], out: str = "seq",
                    start: int | Column = 0, num_partitions: int | None = None) -> DataFrame:
    """Append ``out`` = position of each row in ``order`` (``start``-based).

    Rows are range-partitioned and sorted on ``order``; inside a task the
    partition index and the position in it are stored as columns
    (``spark_partition_id``, ``monotonically_increasing_id``) and the frame
    is checkpointed, so the sampled range bounds cannot change between the
    two uses below (adaptive execution may merge neighbouring ranges,
    which keeps the order).  A one-row-per-partition offset table
    (bounded by the partition count) is broadcast back.
    ``order`` should be a total order (add a unique tie-break column).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cols = [_col(c) for c in order]
    # Without an explicit count adaptive execution sizes the ranges to the data.
    spread = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    ranged = (spread.sortWithinPartitions(*cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    ranged = materialize(ranged, "sequence")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    first = start if isinstance(start, Column) else F.lit(start)
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_local") + first).cast("long"))
            .drop("_pid", "_local", "_off"))


def range_bounds(df: DataFrame, order: Sequence[Column | str], ranges: int, per_range: int = 50) -> list[Row]:
    """Up to ``ranges - 1`` ascending cut points of ``order``, from a sample of
    ``ranges * per_range`` rows: those with the least hash of their order key,
    so the same rows always give the same bounds.  A bounded top-k, whose rows
    alone reach the driver.  An input with fewer rows than that is cut into
    fewer ranges, of at least ``per_range`` rows where two have as many."""
    key = F.struct(*[_col(c).alias(f"o{i}") for i, c in enumerate(order)])
    sample = df.select(key.alias("key")).orderBy(F.xxhash64("key"), "key").limit(ranges * per_range)
    found = sample.agg(F.array_sort(F.collect_list("key")).alias("keys")).first()["keys"]
    ranges = min(ranges, max(2, len(found) // per_range))
    cuts = [found[len(found) * i // ranges] for i in range(1, ranges)] if found else []
    return [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]]


def range_sequence(df: DataFrame, order: Sequence[Column | str], out: str = "seq", start: int | Column = 0,
                   ranges: int = 64, keep_range: bool = False) -> DataFrame:
    """``global_sequence`` as one plan, without storing anything between: rows
    fall into ranges by fixed cut points, a row's number is the rows of earlier
    ranges (a prefix sum over one count per range) plus its rank in its own.

    For inputs that are cheap to read twice, as the counts are made beside the
    ranks.  A small input has fewer ranges, two at least: a window over one
    constant range would be planned without a partition.  ``order`` should be
    a total order; with fewer distinct keys than ranges, or equal keys, a range
    is as wide as its keys make it."""
    cuts = range_bounds(df, order, ranges)
    key = F.struct(*[_col(c).alias(f"o{i}") for i, c in enumerate(order)])
    fields = df.select(key.alias("key")).schema["key"].dataType.fields
    bounds = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(cut, fields)]) for cut in cuts]
    ranged = df.withColumn("_range", F.size(F.filter(F.array(*bounds), lambda c: c <= key)) if bounds else F.lit(0))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # one row a range: their prefix sums are taken in one small array
    listed = counts.agg(F.array_sort(F.collect_list(F.struct("_range", "_n"))).alias("_all"))
    offsets = listed.select(F.inline(F.transform("_all", lambda c: F.struct(c["_range"].alias("_range"), F.aggregate(
        F.filter("_all", lambda d: d["_range"] < c["_range"]), F.lit(0).cast("long"), lambda n, d: n + d["_n"]).alias("_off")))))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(*[_col(c) for c in order]))
    first = start if isinstance(start, Column) else F.lit(start)
    numbered = (ranged.withColumn("_rank", rank).join(F.broadcast(offsets), "_range")
                .withColumn(out, (F.col("_off") + F.col("_rank") - 1 + first).cast("long")).drop("_rank", "_off"))
    return numbered if keep_range else numbered.drop("_range")


def dense_ordinal(df: DataFrame, value: str, by: Sequence[Column | str] | None = None,
                  out: str = "ordinal", start: int = 0) -> DataFrame:
    """Dense rank of the distinct values of ``value`` (ordered by ``by``,
    default the value itself), ``start``-based; one row per distinct value."""
    distinct = df.select(_col(value).alias(value), *[_col(b).alias(f"_by{i}") for i, b in enumerate(by or [])]).distinct()
    keys = [F.col(f"_by{i}") for i in range(len(by or []))] + [F.col(q(value))]
    return range_sequence(distinct, keys, out=out, start=start).drop(*[f"_by{i}" for i in range(len(by or []))])


def first_seen_ordinal(df: DataFrame, item: str, order_col: str, out: str = "ordinal",
                       first_col: str = "first_seen") -> DataFrame:
    """Number the distinct ``item`` values 0.. in order of their first
    appearance (smallest ``order_col``), ties by the item itself."""
    first = df.where(_col(item).isNotNull()).groupBy(_col(item).alias(item)).agg(F.min(_col(order_col)).alias(first_col))
    return global_sequence(first, [F.col(first_col), F.col(q(item))], out=out)
