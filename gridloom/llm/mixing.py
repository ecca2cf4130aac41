"""Mixing sources to target weights by a multivariate-hypergeometric
splitting tree.

1. Sizes: every document counts its words.  A source's target share of the
   mix is its weight's; a target above ``max_repeats`` times the source's
   size stops there, and the excess is shared again by weight.
2. Blocks: each source is cut into ``blocks`` blocks by a seeded hash of its
   documents, which is a random permutation into blocks that needs no sort
   and no window over the source.  The mix takes every block floor(target /
   size) times; of a last partial round it takes the first blocks in permuted
   order that fit into the rest of the target, then, largest first, others
   that fit into the gap that is left, and the smallest of the others if that
   comes nearer than leaving the gap.
3. Tree: the sources' exact block quotas are split among the output shards:
   the root holds all quotas, a node draws how many blocks of each source go
   to its left half (a multivariate hypergeometric draw of the left half's
   size) and recurses; a leaf is one shard.  More than ``BATCH`` sources are
   split level by level: first the sums of runs of ``BATCH`` sources (of runs
   of such runs, if there are many), then each run's sources among what the
   run got, which is the same law.  A task draws one run.
4. Each shard draws disjoint runs of each source's permuted blocks and
   shuffles its documents locally by a seeded hash.

Any number of sources is mixed: their totals, numbers, targets, quotas and
splits are rows of tables.  The driver sees one row per weight and round of
resharing, and the number of sources.

All draws are seeded; reruns over the same rows agree, whatever the
partitioning.

Edge cases: a null or empty text has size 0 and is taken as often as its
block; a null source is a source of its own, last in the order; a source
without words has target 0 and is taken 0 times; identical rows share a
block and are taken alike; texts of any length are counted whole; an empty
table gives no rows.  Input columns that
clash with the operator's (``size``, ``taken``, ``shard`` ...) are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import null_safe, store
from gridloom.operators.ranking import global_sequence

BATCH = 4096
#: numpy draws from fewer than 1e9 items only.
MAX_DRAW = 10**9
BLOCKS = 4096
SHARDS = 64
FILLS = 4
SEED = 20240601


def word_count(text: Column) -> Column:
    return F.regexp_count(null_safe(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def water_fill(sizes: list[int], weights: list[float], share: float,
               max_repeats: float) -> list[float]:
    """Targets that share ``share`` x all sizes by weight, none above
    ``max_repeats`` x its size; the excess is shared again until none is."""
    caps = [max_repeats * s for s in sizes]
    targets = [0.0] * len(sizes)
    left, free = share * sum(sizes), [i for i, s in enumerate(sizes) if s > 0]
    left = min(left, sum(caps))
    while free:
        unit = left / sum(weights[i] for i in free)
        over = {i for i in free if unit * weights[i] >= caps[i]}
        if not over:
            for i in free:
                targets[i] = unit * weights[i]
            break
        for i in sorted(over):
            targets[i] = float(caps[i])
            left -= caps[i]
        free = [i for i in free if i not in over]
    return targets


def water_level(sources: DataFrame, weights: tuple[float, ...], share: float, max_repeats: float) -> float:
    """The level of ``water_fill`` for a table of sources (size, number): a
    source's target is the less of level x weight and ``max_repeats`` x size.
    A round is one aggregate of a row per weight, and its sums are exact."""
    used = sources.filter("size > 0").withColumn("kind", F.pmod("number", F.lit(len(weights))).cast("int"))
    level, free_before = 0.0, None
    while True:
        over = F.lit(level) * _weight(weights) >= F.lit(float(max_repeats)) * F.col("size")
        rows = used.groupBy("kind").agg(F.sum("size").alias("size"), F.sum(F.when(over, F.col("size")).otherwise(0)).alias("capped"),
                                        F.count(F.when(~over, 1)).alias("free")).collect()
        free = sum(r["free"] for r in rows)
        heavy = sum(weights[r["kind"]] * r["free"] for r in rows)
        if not heavy or free == free_before:
            return level
        left = min(share, max_repeats) * sum(r["size"] for r in rows) - max_repeats * sum(r["capped"] for r in rows)
        level, free_before = max(level, left / heavy), free


def _weight(weights: tuple[float, ...]) -> Column:
    """The weight of a source, by its ``number`` in code point order."""
    return F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("number", F.lit(len(weights))).cast("int") + 1)


def draw(rng: np.random.Generator, counts: np.ndarray, n: int) -> np.ndarray:
    """How many of each kind are among ``n`` of all items, drawn without
    replacement (multivariate hypergeometric)."""
    total = int(counts.sum())
    if total < MAX_DRAW:
        return rng.multivariate_hypergeometric(counts, n, method="marginals")
    # every item by a coin; those too many, or missing, are drawn one by one
    taken = rng.binomial(counts, n / total)
    excess = int(taken.sum()) - n
    pool = taken if excess > 0 else counts - taken
    hits = rng.choice(int(pool.sum()), abs(excess), replace=False)
    kinds = np.searchsorted(np.cumsum(pool), hits, side="right")
    return taken - np.sign(excess) * np.bincount(kinds, minlength=len(counts))


def split_tree(quotas: list[int], shards: int, seed: int, columns: list[int] | None = None,
               branch: tuple[int, ...] = ()) -> np.ndarray:
    """(sources x shards) block counts: rows sum to the quotas, columns to
    ``columns``, or else are as even as whole blocks allow."""
    out = np.zeros((len(quotas), shards), dtype=np.int64)

    def split(counts: np.ndarray, lo: int, hi: int) -> None:
        if hi - lo == 1:
            out[:, lo] = counts
            return
        mid = (lo + hi) // 2
        total = int(counts.sum())
        n_left = total * (mid - lo) // (hi - lo) if columns is None else sum(columns[lo:mid])
        rng = np.random.Generator(np.random.PCG64([seed, lo, hi, *branch]))
        left = draw(rng, counts, n_left) if total else counts
        split(left, lo, mid)
        split(counts - left, mid, hi)

    if len(quotas):
        split(np.asarray(quotas, dtype=np.int64), 0, shards)
    return out


def split_sources(quotas: DataFrame, n_sources: int, shards: int, seed: int) -> DataFrame:
    """(number, quota) -> (number, split: blocks of each shard), for sources
    numbered 0 .. ``n_sources`` - 1."""
    levels = [quotas.select("number", "quota")]
    while n_sources > BATCH:
        levels.append(store(levels[-1].groupBy(F.expr(f"number div {BATCH}").alias("number"))
                            .agg(F.sum("quota").alias("quota")), "mix-runs"))
        n_sources = -(-n_sources // BATCH)
    above = None
    for depth, level in reversed(list(enumerate(levels))):
        rows = level.withColumn("run", F.expr(f"number div {BATCH}"))
        if above is not None:
            rows = rows.join(above, "run")
        found = rows.groupBy("run").applyInPandas(_run_splitter(depth, shards, seed), "number long, split array<long>")
        above = found.select(F.col("number").alias("run"), F.col("split").alias("columns"))
    return found


def _run_splitter(depth: int, shards: int, seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def split(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("number")
        if "columns" in rows:
            columns, branch = [int(x) for x in rows["columns"].iloc[0]], (depth + 1, int(rows["run"].iloc[0]))
        else:
            columns, branch = None, ()
        found = split_tree(rows["quota"].tolist(), shards, seed, columns, branch)
        return pd.DataFrame({"number": rows["number"].to_numpy(), "split": list(found)})

    return split


def plan_mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
             max_repeats: float = 2.0, blocks: int = BLOCKS, shards: int = SHARDS,
             seed: int = SEED) -> DataFrame:
    """One row per document row: row_key, doc_id, source, size, source_size,
    target, copies, taken, shards (array, one entry per copy)."""
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), null_safe(F.col("text")))
    sizes = store(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("row_key")
    ).withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "row_key"), F.lit(blocks)).cast("int")),
        "mix-sizes")

    # one row per (source, block): at most sources x blocks
    per_block = sizes.groupBy("source", "block").agg(F.sum("size").alias("words"))
    numbered = store(global_sequence(
        sizes.groupBy("source").agg(F.sum("size").alias("size")),
        [F.col("source").isNull(), F.col("source")], out="number"), "mix-sources")
    level = water_level(numbered, weights, share, max_repeats)
    size = F.col("size")
    cap = F.lit(float(max_repeats)) * size
    target = F.when(size > 0, F.least(F.lit(level) * _weight(weights), cap)).otherwise(0.0)
    rounds = F.when(size > 0, F.round((F.col("target") - F.col("target") % size) / size)).otherwise(0).cast("int")
    table = (numbered.withColumn("target", target).withColumn("rounds", rounds)
             .select("source", "number", size.alias("source_size"), "target", "rounds",
                     (F.col("target") - F.col("rounds") * size).alias("rest")))

    # the partial round, over at most ``blocks`` rows per source
    source = Window.partitionBy("source")
    order, by_size = source.orderBy("block"), source.orderBy(F.col("words").desc(), "block")
    parts = per_block.join(table, per_block.source.eqNullSafe(table.source)).drop(table.source)
    parts = parts.withColumn("last", (F.col("rest") > 0) & (F.sum("words").over(order) <= F.col("rest")))
    for _ in range(FILLS):
        gap = F.col("rest") - F.sum(F.when(F.col("last"), F.col("words")).otherwise(0)).over(source)
        parts = parts.withColumn("gap", gap)
        fits = ~F.col("last") & F.col("words").between(1, F.col("gap"))
        parts = (parts.withColumn("fits", fits)
                 .withColumn("filled", F.sum(F.when(F.col("fits"), F.col("words")).otherwise(0)).over(by_size))
                 .withColumn("last", F.col("last") | (F.col("fits") & (F.col("filled") <= F.col("gap")))))
    gap = F.col("rest") - F.sum(F.when(F.col("last"), F.col("words")).otherwise(0)).over(source)
    free = F.when(~F.col("last") & (F.col("words") > 0), F.struct("words", "block"))
    parts = parts.withColumns({"gap": gap, "least": F.min(free).over(source)}).withColumn(
        "last", F.col("last") | F.coalesce((F.col("block") == F.col("least.block")) & (F.col("words") < 2 * F.col("gap")), F.lit(False)))
    planned = store(
        parts.withColumns({
            "copies": F.col("rounds") + F.col("last").cast("int"), "idx": F.row_number().over(order) - 1,
            "last_idx": F.sum(F.col("last").cast("int")).over(order) - 1,
            "n_blocks": F.count("*").over(source)}).drop("gap", "fits", "filled", "least"), "mix-blocks")

    quotas = store(planned.groupBy("number").agg(F.sum("copies").alias("quota")), "mix-quotas")
    split = split_sources(quotas, quotas.count(), shards, seed)
    # running sums: the place in the source's order at which each shard's run ends
    ends = split.select("number", F.expr(
        "transform(sequence(1, size(split)), i -> aggregate(slice(split, 1, i), 0L, (a, x) -> a + x))").alias("ends"))
    # a block copy's place in its source's order, round by round, tells its shard
    place = F.expr("transform(sequence(0, copies - 1), r -> size(filter(ends, "
                   "e -> e <= r * n_blocks + if(r = rounds, last_idx, idx))))")
    blocks_out = (planned.join(ends, "number")
                  .withColumn("shards", F.when(F.col("copies") > 0, place)
                              .otherwise(F.array().cast("array<int>")))
                  .select(F.col("source").alias("b_source"), F.col("block").alias("b_block"),
                          "source_size", "target", "copies", "shards"))
    return (sizes.join(blocks_out, sizes.source.eqNullSafe(F.col("b_source"))
                       & (F.col("block") == F.col("b_block")))
            .select("row_key", "doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken"), "shards"))


def mix(docs: DataFrame, seed: int = SEED, shards: int = SHARDS, **options) -> DataFrame:
    """The mix itself: every taken copy of every document with its ``shard``
    and ``copy`` number, shuffled within the shard (rows of a shard are
    sorted by a seeded hash, kept as ``shard_order``)."""
    plan = plan_mix(docs, seed=seed, shards=shards, **options)
    # identical rows share a key: one plan row stands for all of them
    keyed = plan.filter("copies > 0").groupBy(F.col("row_key").alias("_mix_key")).agg(F.first("shards").alias("_shards"))
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), null_safe(F.col("text")))
    added = ("shard", "copy", "shard_order")
    copies = (docs.drop(*added).withColumn("_mix_key", key).join(keyed, "_mix_key")
              .select(*[f"`{c}`" for c in docs.columns if c not in added], "_mix_key",
                      F.posexplode("_shards").alias("copy", "shard"))
              .withColumn("shard_order", F.xxhash64(F.lit(seed + 2), "_mix_key", "copy"))
              .drop("_mix_key"))
    return (copies.repartition(shards, "shard")
            .sortWithinPartitions("shard", "shard_order", "doc_id", "copy"))
