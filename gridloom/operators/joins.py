"""Lookup joins.

Which side is broadcast is left to Catalyst and adaptive execution, which
decide by measured bytes (``spark.sql.autoBroadcastJoinThreshold``), and skewed
keys of the large side are split by adaptive execution.  Literal maps of fixed
size use ``functions.codes.lookup`` and need no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.columns import q


def unique_lookup(lookup: DataFrame, keys: Sequence[str], what: str = "lookup") -> DataFrame:
    """``lookup`` with a check inside the plan: the job fails when a key has
    several rows (a left join would multiply rows)."""
    values = [c for c in lookup.columns if c not in keys]
    shown = F.concat_ws(", ", *[F.col(q(k)).cast("string") for k in keys])
    held = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"{what} has duplicate keys, e.g. "), shown))).otherwise(
        F.col("_r"))
    return (lookup.groupBy(*[F.col(q(k)) for k in keys])
            .agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*[F.col(q(c)) for c in values])).alias("_r"))
            .withColumn("_r", held)
            .select(*[F.col(q(k)) for k in keys], *[F.col(f"_r.{q(c)}").alias(c) for c in values]))


def lookup_join(left: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left",
                check_unique: bool = False) -> DataFrame:
    """Join ``left`` to a lookup on equal keys; ``check_unique`` fails the job
    when the join is not many-to-one."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(unique_lookup(lookup, keys) if check_unique else lookup, on=keys, how=how)


def anti_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose non-null key is absent from ``right``.
    Rows with a null key are excluded first, as a set difference of keys.
    The right side is reduced to its distinct keys first (a partial
    aggregate in every map task), so a large right side ships each key
    once per task rather than once per row."""
    keys = [on] if isinstance(on, str) else list(on)
    right_keys = right.select(*keys).na.drop().distinct()
    return left.na.drop(subset=keys).join(right_keys, on=keys, how="left_anti")


def semi_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right`` (right reduced to
    distinct keys first)."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*keys).distinct(), on=keys, how="left_semi")


def key_audit(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Distinct (left key, right key) pairs of a full outer join: matches
    side by side, orphans of either side with a null partner."""
    lk = left.select(F.col(q(left_key)).alias(left_key)).distinct()
    rk = right.select(F.col(q(right_key)).alias(right_key)).distinct()
    return lk.join(rk, lk[left_key] == rk[right_key], "full_outer").select(left_key, right_key)


def route_by_lookup(df: DataFrame, lookup: DataFrame, on: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` by whether its key is known to ``lookup``.

    Returns (matched rows with ``value`` attached, rejected row counts per
    key): unknown codes are counted and set aside with a report instead of
    being dropped silently or failing the job."""
    tagged = lookup_join(df, lookup.select(on, value), on, "left")
    matched = tagged.where(F.col(q(value)).isNotNull())
    rejected = (tagged.where(F.col(q(value)).isNull())
                .groupBy(F.col(q(on)).alias(on)).agg(F.count(F.lit(1)).alias("n_rows")))
    return matched, rejected


def split_hot_join(big: DataFrame, other: DataFrame, on: str, hot: Sequence, how: str = "inner",
                   buckets: int = 32) -> DataFrame:
    """Equi-join that spreads the declared ``hot`` keys of ``big`` over
    ``buckets`` tasks, for plans that adaptive execution cannot split.

    One scan of each side: rows of ``big`` with a hot key get a salt from a
    hash of the whole row (deterministic, so a retried task salts the same
    way), other rows salt 0; hot rows of ``other`` are replicated once per
    salt.  Equals the plain join for ``inner`` and ``left`` whatever the list
    holds.
    """
    if how not in ("inner", "left"):
        raise ValueError("split_hot_join supports inner and left joins")
    is_hot = F.coalesce(F.col(q(on)).isin(list(hot)), F.lit(False)) if hot else F.lit(False)
    salt = F.pmod(F.xxhash64(*[F.col(q(c)) for c in big.columns]), F.lit(buckets))
    salted = big.withColumn("_salt", F.when(is_hot, salt).otherwise(F.lit(0).cast("long")))
    last = F.when(is_hot, F.lit(buckets - 1)).otherwise(F.lit(0)).cast("long")
    copied = other.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return salted.join(copied, [on, "_salt"], how).drop("_salt")


def heavy_keys(df: DataFrame, on: str, share: float = 0.01, buckets: int = 1 << 16) -> list:
    """The non-null keys that hold more than ``share`` of all rows, exactly;
    fewer than 1 / ``share`` of them.

    Two narrow passes over the key column.  The first counts rows by a hash of
    the key in ``buckets`` cells, a sketch of fixed size per task: a heavy key
    makes its cell heavy.  The second counts the keys of heavy cells only."""
    key = F.col(q(on))
    cell = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    held = df.where(key.isNotNull()).select(key.alias("key"), cell.alias("cell"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # over at most ``buckets`` rows
    cells = held.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).withColumn("total", total)
    heavy = cells.where(F.col("n") > share * F.col("total")).select("cell", "total").collect()
    if not heavy:
        return []
    limit = share * heavy[0]["total"]
    counts = held.where(F.col("cell").isin([r["cell"] for r in heavy])).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return sorted(r["key"] for r in counts.where(F.col("n") > limit).select("key").collect())


def measured_hot_join(big: DataFrame, other: DataFrame, on: str, how: str = "inner", share: float = 0.01,
                      buckets: int | None = None) -> DataFrame:
    """``split_hot_join`` whose hot keys are found in ``big`` (``heavy_keys``).
    A hot key is spread over as many tasks as the shuffle has partitions
    unless ``buckets`` says otherwise."""
    if buckets is None:
        buckets = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return split_hot_join(big, other, on, heavy_keys(big, on, share), how, buckets)
