"""Distributed difference-cover (DC3) suffix sort of many symbol strings.

``suffix_order`` sorts the suffixes of all strings: it names the triples at
offsets 1 and 2 mod 3 by one global sort, recurses on the strings of names
until names are unique or ``depth`` levels cover enough symbols, and merges
the suffixes at offsets 0 mod 3 into the order of the others.

Everything is sorts, joins and windows by string; a rank is a number that
rises with the order (the partition and place in a range-partitioned sort), so
no counting pass and no single-task window over the data is needed.  Suffixes
that are equal (as far as the levels reach) are neighbours in the order; their
ranks may be equal or not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import store

KEY = ["sid", "path", "off"]


def _numbered(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows`` plus a number that rises with ``order`` over all partitions;
    stored, so that the sampled ranges cannot change between uses."""
    return store(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn(name, F.monotonically_increasing_id() + 1), name)


def _following(strings: DataFrame, *more: str) -> DataFrame:
    """The two symbols after each (0 past the end), and of ``more`` columns."""
    along = Window.partitionBy("sid", "path").orderBy("off")
    return strings.withColumns({f"{c}{k}": F.coalesce(F.lead(c, k).over(along), F.lit(0))
                                for c in ("sym", *more) for k in (1, 2)})


def _named(rows: DataFrame) -> tuple[DataFrame, bool]:
    """Rows with the name of their triple; whether all names differ."""
    triple = ["sym", "sym1", "sym2"]
    distinct = _numbered(rows.groupBy(*triple).agg(F.count("*").alias("n")), triple, "name")
    unique = distinct.filter("n > 1").limit(1).count() == 0
    return rows.join(distinct.drop("n"), triple), unique


def _last_before(rows: DataFrame, order: list) -> DataFrame:
    """Of each row without a rank: the largest rank of the rows before it in
    the global order (0: none)."""
    placed = store(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("place", F.monotonically_increasing_id())
                   .withColumn("part", F.shiftright("place", 33)), "merge")
    within = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    tops = placed.groupBy("part").agg(F.max("rank").alias("top"))  # one row per partition
    carried = tops.withColumn("carried", F.max("top").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).select("part", "carried")
    return (placed.withColumn("seen", F.max("rank").over(within))
            .filter("rank is null").join(F.broadcast(carried), "part")
            .select(*KEY, F.greatest("seen", "carried", F.lit(0)).alias("before")))


def suffix_order(strings: DataFrame, depth: int) -> DataFrame:
    """(sid, path, off, sym) with symbols above 0 -> (sid, path, off, rank).
    ``depth`` levels of triples compare 3^depth symbols at least."""
    triples = store(_following(strings), "triples")
    longest = triples.agg(F.max("off")).first()[0]
    if longest is None:
        return triples.select(*KEY, F.lit(0).cast("long").alias("rank"))
    if depth <= 1 or longest <= 2:
        named, _ = _named(triples)
        return store(named.select(*KEY, F.col("name").alias("rank")), "ranks")

    residue = F.col("off") % 3
    named, unique = _named(triples.filter(residue != 0))
    named = store(named.select(*KEY, "name"), "names")
    if unique:
        sample = named.withColumnRenamed("name", "rank")
    else:
        smaller = named.select("sid", (F.col("path") * 3 + residue).alias("path"),
                               F.floor(F.col("off") / 3).alias("off"), F.col("name").alias("sym"))
        sample = suffix_order(smaller, depth - 1).select(
            "sid", F.floor(F.col("path") / 3).alias("path"),
            (F.col("off") * 3 + F.col("path") % 3).alias("off"), "rank")

    # merge: each remaining suffix goes after the last sampled one below it
    ranked = store(_following(triples.select(*KEY, "sym").join(sample, KEY, "left"), "rank"), "ranked")
    rest = residue == 0
    after1 = ranked.filter(residue != 2).select(*KEY, "rank", "sym", F.col("rank1").alias("q"))
    after2 = ranked.filter(residue != 1).select(*KEY, "rank", "sym", F.col("sym1").alias("p"), F.col("rank2").alias("q"))
    tie = [F.col("rank").isNull(), *KEY]
    one = _last_before(after1, ["sym", "q", *tie])
    two = _last_before(after2, ["sym", "p", "q", *tie])
    below = (one.withColumnRenamed("before", "one").join(two.withColumnRenamed("before", "two"), KEY)
             .select(*KEY, F.greatest("one", "two").alias("below")))
    rest_keys = ranked.filter(rest).join(below, KEY).select(*KEY, "below", F.col("sym").alias("a"), F.col("rank1").alias("b"))
    all_keys = sample.select(*KEY, F.col("rank").alias("below"), F.lit(0).cast("long").alias("a"),
                             F.lit(0).cast("long").alias("b")).unionByName(rest_keys)
    ranks = _numbered(all_keys.groupBy("below", "a", "b").count().drop("count"), ["below", "a", "b"], "rank")
    return store(all_keys.join(ranks, ["below", "a", "b"]).select(*KEY, "rank"), "ranks")
