"""Set operations: union by name, positional append with a row count,
last-row-per-key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.columns import q


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union aligning columns by name; a column missing from a frame is
    null there (types are widened by Spark)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def append_positional(frames: Sequence[DataFrame]) -> DataFrame:
    """``INSERT INTO t SELECT *`` per part: columns matched by position."""
    return reduce(lambda a, b: a.union(b), frames)


def append_and_count(frames: Sequence[DataFrame]) -> DataFrame:
    """One-row frame with the row count of the positional append."""
    return append_positional(frames).agg(F.count(F.lit(1)).alias("n_rows"))


def last_per_key(df: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """The last row per key in ``order`` (a ``max_by`` aggregate: combined
    map-side, so one hot key does not land whole in one task)."""
    cols = [c for c in df.columns if c != key]
    ordering = F.struct(*[F.col(q(o)) if isinstance(o, str) else o for o in order])
    pick = F.max_by(F.struct(*[F.col(q(c)) for c in cols]), ordering)
    return df.groupBy(F.col(q(key))).agg(pick.alias("_r")).select(
        key, *[F.col(f"_r.{q(c)}").alias(c) for c in cols])
