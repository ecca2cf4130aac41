"""Prefix trie of conversations by ROLLUP over positional turn columns.

A conversation is cut into blocks of ``width`` turns.  A block is one row: its
number, the key of the node that closes the block before it, and ``width``
turn-id columns (null after the last turn).  One

    GROUP BY block, key, ROLLUP(t1, ..., tw)

with ``grouping_id`` then aggregates all prefixes that end in a block, of all
blocks at once: a group at roll-up level j is the node at depth
``block * width + j``.  The key of a block is the exclusive-or of 128-bit
hashes of all earlier (turn id, position), so it comes from running
aggregates, not from a walk down the trie.

Sums over subtrees need no walk either.  A node belongs to its smallest
member; along a conversation's path the nodes that it owns are a suffix.  With
``fork(c)`` the depth of the first node that ``c`` owns (one beyond its end if
none), and ``above(d)`` the code points of a path above depth d:

* leaves below a node = its members that own the childless node they end in,
* children = members that fork one below it, plus the owner if it goes on,
* saved code points = sum of ``above(fork(c)) - above(depth)`` over the
  members other than the owner,

so a second ROLLUP of per-conversation numbers gives them.  A node's parent
has the same owner unless the owner forks there; only those are looked up, the
few parents with over a thousandth of all nodes as children by a broadcast
(fewer than a thousand rows), the rest by a join.  Digests of long id lists
are made from sorted pages, streamed.

Turns are compared by 128-bit hashes of role and text, plus the text's length.

Edge cases: null role or text is empty; turns are ordered by ``turn`` (null
first), ties by the turn's hash, so repeated rows are turns of their own; rows
with a null conversation id belong to none and are left out; a conversation
without turns ends in the root; an empty table has no conversations and so
not even a root.  A conversation may hold any number of turns: its rows are
numbered over ranges, its blocks go to separate tasks, and running hashes are
taken over runs of ``SPAN`` blocks.  Long texts pass only through a hash.
Only the named columns are read, so others may clash with anything.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from gridloom.llm.common import null_safe, store
from gridloom.operators.ranking import global_sequence

WIDTH = 4
SPAN = 4096
PAGE = 4096
HEAD = 5
HEAVY = 1000  # a heavy parent has over 1 / HEAVY of all nodes as children


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, tid): every turn's number in the order of all turns, and
    its id, 16 bytes of hash and 8 of the text's length."""
    role, text = null_safe(F.col("role")), null_safe(F.col("text"))
    size = F.unhex(F.lpad(F.hex(F.length(text).cast("long")), 16, "0"))
    both = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.concat(F.unhex(F.md5(both.cast("binary"))), size).alias("tid"),
        F.monotonically_increasing_id().alias("row"))  # spreads equal rows over ranges
    return global_sequence(turns, ["conv_id", "turn", "tid", "row"], out="at").select("conv_id", "at", "tid")


def rebuilt_turns(turns: DataFrame, period: int = 100) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt from the head of the first of their hundred.

    Returns (conv_id, total) per conversation and its turns (conv_id, place
    from 1, tid).  ``h`` is crc32 of the id mod 6; the first ``h`` turns are
    those of the head conversation."""
    sizes = turns.groupBy("conv_id").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n"))
    convs = sizes.withColumns({
        "head": F.col("conv_id") - F.col("conv_id") % period,
        "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)})
    heads = sizes.select(F.col("conv_id").alias("head"), F.col("n").alias("n_head"))
    convs = (convs.join(heads, "head", "left")
             .withColumn("taken", F.least("h", F.coalesce("n_head", F.lit(0).cast("long"))))
             .withColumn("total", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))))
    placed = turns.join(convs, "conv_id").withColumn("place", F.col("at") - F.col("start") + 1)
    own = placed.filter("place > h").select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "tid")
    # at most HEAD turns of a head, for fewer than 2 * period conversations
    first = placed.filter((F.col("conv_id") == F.col("head")) & (F.col("place") <= HEAD)).select("head", "place", "tid")
    shared = first.join(convs.select("head", "conv_id", "taken"), "head").filter("place <= taken")
    return convs.select("conv_id", "total"), own.unionByName(shared.select("conv_id", "place", "tid"))


def blocks_of(convs: DataFrame, turns: DataFrame, width: int = WIDTH, span: int = SPAN) -> DataFrame:
    """One row per block of ``width`` turns: conv_id, total, block, k1 and k2
    (key: hash of all earlier turns), n1 and n2 (the next block's key), before
    (code points of earlier turns), t1 .. tw.  Every conversation has a block 0."""
    slots = [f"t{j}" for j in range(1, width + 1)]
    cut = turns.withColumns({"block": F.floor((F.col("place") - 1) / width), "slot": (F.col("place") - 1) % width})
    rows = cut.groupBy("conv_id", "block").agg(
        *[F.max(F.when(F.col("slot") == j, F.col("tid"))).alias(t) for j, t in enumerate(slots)],
        *[F.bit_xor(F.xxhash64("tid", "place", F.lit(seed))).alias(f"x{seed}") for seed in (1, 2)],
        F.sum(chars(F.col("tid"))).alias("chars"))
    rows = rows.join(convs, "conv_id")
    none = convs.filter("total = 0").select(
        "conv_id", F.lit(0).cast("long").alias("block"), *[F.lit(None).cast("binary").alias(t) for t in slots],
        *[F.lit(0).cast("long").alias(c) for c in ("x1", "x2", "chars")], "total")
    rows = rows.unionByName(none).withColumn("run", F.floor(F.col("block") / span))

    def earlier(window, prefix: str) -> dict[str, Column]:
        window = window.rowsBetween(Window.unboundedPreceding, -1)
        zero = F.lit(0).cast("long")
        return {f"{prefix}1": F.coalesce(F.bit_xor("x1").over(window), zero), f"{prefix}2": F.coalesce(F.bit_xor("x2").over(window), zero),
                f"{prefix}c": F.coalesce(F.sum("chars").over(window), zero)}

    within = rows.withColumns(earlier(Window.partitionBy("conv_id", "run").orderBy("block"), "w"))
    # what lies before a run: of conversations with more than one
    runs = (rows.filter(F.col("total") > span * width).groupBy("conv_id", "run")
            .agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("chars").alias("chars"))
            .withColumns(earlier(Window.partitionBy("conv_id").orderBy("run"), "r")).drop("x1", "x2", "chars"))
    keyed = within.join(runs, ["conv_id", "run"], "left").fillna(0, ["r1", "r2", "rc"])
    k1, k2 = F.col("w1").bitwiseXOR(F.col("r1")), F.col("w2").bitwiseXOR(F.col("r2"))
    return keyed.select("conv_id", "total", "block", k1.alias("k1"), k2.alias("k2"),
                        k1.bitwiseXOR(F.col("x1")).alias("n1"), k2.bitwiseXOR(F.col("x2")).alias("n2"),
                        (F.col("wc") + F.col("rc")).alias("before"), *slots)


def chars(tid: Column) -> Column:
    """Code points of the text, from the turn id."""
    return F.conv(F.hex(F.substring(tid, 17, 8)), 16, 10).cast("long")


def _node_id(block: Column, k1: Column, k2: Column, *tids: Column) -> Column:
    parts = [c.cast("string") for c in (block, k1, k2)] + [F.hex(t) for t in tids]
    return F.unhex(F.md5(F.concat_ws("|", *parts).cast("binary")))


def _path_id(level: int, width: int) -> Column:
    """Id of the node at ``level`` of a row of ``blocks_of``; a node that
    closes a block is named as the next block's key."""
    if level == width:
        return _node_id(F.col("block") + 1, F.col("n1"), F.col("n2"))
    return _node_id(F.col("block"), F.col("k1"), F.col("k2"), *[F.col(f"t{j}") for j in range(1, level + 1)])


def _at_level(by_level: list[Column]) -> Column:
    out = by_level[0]
    for j, c in enumerate(by_level[1:], 1):
        out = F.when(F.col("level") == j, c).otherwise(out)
    return out


def _rolled(blocks: DataFrame, width: int, *aggregates: str) -> DataFrame:
    """All nodes: block, k1, k2, t1 .. tw (null beyond the node), level,
    depth, above (code points above the node) and the aggregates."""
    slots = [f"t{j}" for j in range(1, width + 1)]
    listed = ", ".join(slots)
    rolled = blocks.sparkSession.sql(
        f"SELECT block, k1, k2, {listed}, {width} - bit_count(grouping_id()) AS level, max(before) AS before, "
        f"{', '.join(aggregates)} FROM {{blocks}} GROUP BY block, k1, k2, ROLLUP({listed})", blocks=blocks)
    # level 0 is the closing node of the block before, but for the root
    real = _at_level([F.col("block") == 0, *[F.col(t).isNotNull() for t in slots]])
    sums = [F.col("before")]  # above a node: the texts of the turns before its own
    for t in slots:
        sums.append(sums[-1] + F.coalesce(chars(F.col(t)), F.lit(0)))
    return rolled.filter(real).withColumns({
        "depth": F.col("block") * width + F.col("level"), "above": _at_level([sums[0], *sums[:-1]])})


def forks(blocks: DataFrame, width: int = WIDTH) -> DataFrame:
    """(conv_id, fork, free, leaf) per conversation: the depth of the first
    node that it owns (null: none), the code points that it shares with
    smaller conversations, and 1 if it owns the childless node it ends in."""
    nodes = _rolled(blocks, width, "min(conv_id) AS owner", "max(total) AS longest")
    owned = nodes.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min("depth").alias("fork"), F.min_by("above", "depth").alias("free"),
        F.max((F.col("longest") == F.col("depth")).cast("int")).alias("leaf"))
    sizes = [F.coalesce(chars(F.col(f"t{j}")), F.lit(0)) for j in range(1, width + 1)]
    whole = blocks.groupBy("conv_id").agg(F.max(F.col("before") + sum(sizes, F.lit(0))).alias("whole"))
    return whole.join(owned, "conv_id", "left").select(
        "conv_id", "fork", F.coalesce("free", "whole").alias("free"), F.coalesce("leaf", F.lit(0)).alias("leaf"))


def end_digests(blocks: DataFrame, width: int = WIDTH, page: int = PAGE) -> DataFrame:
    """(id, ends_sha256) of the nodes in which conversations end: SHA-256 of
    their ids, ascending, comma-joined."""
    filled = sum((F.col(f"t{j}").isNotNull().cast("int") for j in range(1, width + 1)), F.lit(0))
    last = blocks.filter(F.floor((F.greatest("total", F.lit(1)) - 1) / width) == F.col("block")).withColumn("level", filled)
    ends = last.select(_at_level([_path_id(j, width) for j in range(width + 1)]).alias("id"), "conv_id")

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of at most ``page`` ids of one node; rows come sorted."""
        node, held = None, []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([node], pa.binary()), pa.array([held[0]], pa.int64()), pa.array([",".join(map(str, held))])],
                ["id", "first", "ids"])

        for batch in batches:
            for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (key != node or len(held) == page):
                    yield packed()
                    held = []
                node = key
                held.append(conv)
        if held:
            yield packed()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One hash a node, a page at a time; pages come sorted."""
        node, state, done = None, None, ([], [])

        def full() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(done[0], pa.binary()), pa.array(done[1], pa.string())], ["id", "ends_sha256"])
            done[0].clear(), done[1].clear()
            return out

        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key != node:
                    if state is not None:
                        done[0].append(node), done[1].append(state.hexdigest())
                    node, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield full()
        if state is not None:
            done[0].append(node), done[1].append(state.hexdigest())
        yield full()

    spread = ends.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
    paged = spread.mapInArrow(pages, "id binary, first long, ids string")
    return (paged.repartition("id").sortWithinPartitions("id", "first")
            .mapInArrow(digest, "id binary, ends_sha256 string"))


def trie(convs: DataFrame, turns: DataFrame, width: int = WIDTH, span: int = SPAN, page: int = PAGE,
         heavy: int = HEAVY) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, place, tid) of
    ``convs`` (conv_id, total)."""
    blocks = store(blocks_of(convs, turns, width, span), "trie-blocks")
    marked = blocks.join(forks(blocks, width), "conv_id")
    ahead = [f"count_if(fork = block * {width} + {j + 1}) AS fork{j}" for j in range(width + 1)]
    nodes = _rolled(marked, width, "min(conv_id) AS conv_id", "count(*) AS n_convs", "sum(free) AS free",
                    "min_by(free, conv_id) AS own_free", "sum(leaf) AS n_leaves", "min_by(fork, conv_id) AS fork",
                    "min_by(total, conv_id) AS total", "max(n1) AS n1", "max(n2) AS n2", *ahead)
    children = _at_level([F.col(f"fork{j}") for j in range(width + 1)]) + (F.col("total") > F.col("depth")).cast("long")
    saved = F.col("free") - F.col("own_free") - (F.col("n_convs") - 1) * F.col("above")
    nodes = nodes.select(
        "conv_id", "depth", F.col("n_convs"), children.alias("n_children"), F.col("n_leaves").cast("long").alias("n_leaves"),
        saved.alias("saved_tokens"), (F.col("fork") == F.col("depth")).alias("forked"),
        _at_level([_path_id(j, width) for j in range(width + 1)]).alias("id"),
        _at_level([F.lit(None).cast("binary"), *[_path_id(j, width) for j in range(width)]]).alias("parent"))
    seen = Observation()
    nodes = store(nodes.observe(seen, F.count(F.lit(1)).alias("n")), "trie-nodes")
    inner = nodes.filter("n_children > 0").select(F.col("id").alias("parent"), F.col("conv_id").alias("up"), "n_children")
    much = F.col("n_children") * heavy > seen.get["n"]  # each node has one parent, so fewer than ``heavy`` rows
    found = (nodes.filter("depth > 0 and forked").select("id", "parent")
             .join(F.broadcast(inner.filter(much).select("parent", F.col("up").alias("heavy_up"))), "parent", "left"))
    light = found.filter("heavy_up is null").select("id", "parent").join(inner.filter(~much), "parent").select("id", "up")
    ups = found.filter("heavy_up is not null").select("id", F.col("heavy_up").alias("up")).unionByName(light)
    out = nodes.join(ups, "id", "left").join(end_digests(blocks, width, page), "id", "left")
    return out.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("up", "conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def rebuilt_trie(conversations: DataFrame, **options) -> DataFrame:
    """The trie of the rebuilt conversations (see ``rebuilt_turns``)."""
    return trie(*rebuilt_turns(numbered_turns(conversations)), **options)
