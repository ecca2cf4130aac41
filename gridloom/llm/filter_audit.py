"""Interaction audit of document filters by removal-game potentials.

Filters overlap: what one of them removes depends on those applied before.
Every document is reduced to the set of filters that it fails, so a table
becomes the counts of at most 2^k such sets per part.  From them follows the
removal game ``v(S)``: how many documents the coalition ``S`` of filters
removes.  Its Hart-Mas-Colell potential is computed recursively over all
coalitions,

    P(empty) = 0,   P(S) = (v(S) + sum of P(S without i) over i in S) / |S|,

and a filter's Shapley value is the grand potential minus the potential of
all filters but it.  The recursion runs on ``|S|! P(S)``, which is a whole
number, so ``shapley`` (the value times k!: the filter's removals summed over
all orders) is exact.  Differences of coalitions give each step of each
order: what a filter removes after others is ``v(S + f) - v(S)``.

Repeated texts are found without bringing copies together: rows are counted
per id and text digest, then per digest, part and label in partial aggregates;
only the smallest id of each such cell meets those of the digest's other cells.

Edge cases: null and empty texts are the same text, have no words and no
characters; a null part is the empty string; a null id is smaller than
nothing and has nothing smaller, so such rows never count as repeats; repeated
rows with one id are no repeats of each other, but each counts; of several
label rows of an id, one with quality 1 (toxic 1) suffices; without label rows
a document is neither.  An empty table has no parts and gives no rows.  Texts
of any length are judged whole.  Only the named columns are read, so others
may clash with anything.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import null_safe

BLANK = r"[\x20\x09-\x0D]+"
REPEAT = "E"

_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that look at one text alone."""
    words = F.filter(F.split(text, BLANK), lambda w: w != "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > 3 * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failure_cells(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None,
                  text_col: str = "text", part_col: str = "lang", repeat: str | None = REPEAT) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters that they
    fail (bit i for the i-th filter; ``repeat``, when given, is one more, failed
    by documents whose text a smaller id has too)."""
    text = null_safe(F.col(text_col))
    filters = text_filters(text) if filters is None else filters
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(filters.values())), F.lit(0))
    facts = docs.select("doc_id", null_safe(F.col(part_col)).alias("part"), bits.alias("mask"),
                        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    rows = facts.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    marks = (labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("string").alias("key"))
             .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                  F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    # rows without an id meet no label; their key spreads them
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null "), F.hex("digest")))
    rows = rows.withColumn("key", key).join(marks, "key", "left").fillna(0, ["good", "toxic"])
    cells = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    if repeat is None:
        parted = cells.select("part", "good", "toxic", "mask", "n")
    else:
        least = F.min("first").over(Window.partitionBy("digest"))  # a cell per part and label, not a row per copy
        fresh = F.col("n_null") + F.when(F.col("first") == least, F.col("n_first")).otherwise(0)
        parted = (cells.withColumn("fresh", fresh)
                  .withColumn("cell", F.explode(F.array(
                      F.struct(F.col("mask").alias("mask"), F.col("fresh").alias("n")),
                      F.struct((F.col("mask") + F.lit(1 << len(filters))).alias("mask"),
                               (F.col("n") - F.col("fresh")).alias("n")))))
                  .select("part", "good", "toxic", "cell.mask", "cell.n").filter("n > 0"))
    return parted.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def removal_game(counts: dict[int, int], k: int) -> list[int]:
    """``v(S)`` for every coalition ``S``: documents failing a filter of it."""
    return [sum(n for mask, n in counts.items() if mask & s) for s in range(1 << k)]


def scaled_potentials(v: list[int], k: int) -> list[int]:
    """``|S|! P(S)`` of the Hart-Mas-Colell potential, in whole numbers."""
    q = [0] * (1 << k)
    for s in range(1, 1 << k):  # every proper subset is a smaller number
        size = s.bit_count()
        q[s] = factorial(size - 1) * v[s] + sum(q[s ^ (1 << i)] for i in range(k) if s >> i & 1)
    return q


def shapley_sums(v: list[int], k: int) -> list[int]:
    """Per player: k! times its Shapley value."""
    q, everyone = scaled_potentials(v, k), (1 << k) - 1
    return [q[everyone] - k * q[everyone ^ (1 << i)] for i in range(k)]


def order_steps(names: list[str], counts: dict[str, dict[int, int]]) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique fails, good lost, toxic
    lost, shapley) for every order of the filters; ``counts`` has documents by
    mask under ``n``, ``good`` and ``toxic``."""
    k = len(names)
    everyone, total = (1 << k) - 1, sum(counts["n"].values())
    v, good, toxic = (removal_game(counts[c], k) for c in ("n", "good", "toxic"))
    shares, out = shapley_sums(v, k), []
    for order in permutations(range(k)):
        label, before = "".join(names[i] for i in order), 0
        for step, i in enumerate(order, 1):
            now = before | 1 << i
            removed = v[now] - v[before]
            out.append((label, step, total - v[now], removed, v[1 << i] - removed, v[everyone] - v[everyone ^ (1 << i)],
                        good[now] - good[before], toxic[now] - toxic[before], shares[i]))
            before = now
    return out


def audit(cells: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, order of the filters and step.  A part's group holds
    at most 2^k counts, however many documents it has."""
    def play(table: pa.Table) -> pa.Table:
        masks = table["mask"].to_pylist()
        counts = {c: dict(zip(masks, table[c].to_pylist())) for c in ("n", "good", "toxic")}
        columns = list(zip(*order_steps(names, counts)))
        arrays = [pa.array([table["part"][0].as_py()] * len(columns[0])), pa.array(columns[0]), pa.array(columns[1], pa.int32())]
        return pa.table(arrays + [pa.array(c, pa.int64()) for c in columns[2:]], ["part", "filter_order", "step", *_COUNTS])

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in _COUNTS)
    return cells.groupBy("part").applyInArrow(play, schema)


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters A to E over ``docs``, by language."""
    return audit(failure_cells(docs, labels), [*text_filters(F.lit("")), REPEAT])
