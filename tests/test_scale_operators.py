"""Operators that must not gather a group: paged lists, drill totals over
cells, hot keys, numbering."""

import glob
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from gridloom.operators import diagnostics as diag
from gridloom.operators.joins import heavy_keys, measured_hot_join
from gridloom.operators.ranking import range_sequence


# ------------------------------------------------------------------ paged lists

def test_pages_join_to_the_sorted_list(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), f"m{rng.randrange(300):03d}") for _ in range(2000)] + [("a", None), ("c", "only")]
    df = spark.createDataFrame(rows, "g string, m string").repartition(5)
    got = {}
    for r in diag.collect_members(df, "g", "m", page=40).orderBy("page").collect():
        assert r["page"] == len(got.setdefault(r["g"], [])) and r["n_members"] == len(r["members"].split(",")) <= 40
        got[r["g"]].append(r["members"])
    want = {}
    for g, m in rows:
        if m is not None:
            want.setdefault(g, set()).add(m)
    assert {g: ",".join(p) for g, p in got.items()} == {g: ",".join(sorted(v)) for g, v in want.items()}
    assert all(p.count(",") == 39 for pages in got.values() for p in pages[:-1])
    assert diag.collect_members(df.limit(0), "g", "m").count() == 0


# ------------------------------------------------------------------ drill totals

def test_drill_totals_multiply_cells_not_rows(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["x", "y", None]), rng.choice(["p", "q"]), rng.choice([None, float("nan"), 1.25, 2.5, -3.75])) for _ in range(500)]
    df = spark.createDataFrame(rows, "a string, b string, v double")
    measures = {"n": diag.Measure("count"), "total": diag.Measure("sum", "v", 2), "mean": diag.Measure("mean", "v", 2),
                "least": diag.Measure("min", "v"), "most": diag.Measure("max", "v")}
    out = diag.drill_rollup(df, ["a", "b"], measures)
    plan = out._jdf.queryExecution().executedPlan().toString()
    got = {(r["a"], r["b"], r["g_a"], r["g_b"]): r for r in out.collect()}
    assert len(got) == 3 * 2 + 3 + 1
    for (a, b, ga, gb), r in got.items():
        part = [v for x, y, v in rows if (ga or x == a) and (gb or y == b)]
        real = [v for v in part if v is not None and v == v]
        held = [v for v in part if v is not None]
        assert r["n"] == len(part) and r["total"] == pytest.approx(sum(real)) and r["mean"] == pytest.approx(sum(real) / len(real))
        assert r["least"] == min(real) and str(r["most"]) == ("nan" if any(v != v for v in held) else str(max(real)))
    order = re.findall(r"\b(HashAggregate|Expand|Exchange)\b", plan)  # from the result down to the rows
    assert order.count("Expand") == 1 and order.index("Expand") > order.index("HashAggregate")
    assert order[order.index("Expand") + 1:].count("HashAggregate") == 2  # the cells are made below it
    none = diag.drill_rollup(df.where("v is null"), ["a"], {"mean": diag.Measure("mean", "v")})
    assert {r["mean"] for r in none.collect()} == {None}


# ----------------------------------------------------------------------- hot keys

def test_heavy_keys_are_exact(spark):
    rows = [(1,)] * 500 + [(2,)] * 101 + [(3,)] * 100 + [(None,)] * 900 + [(i,) for i in range(10, 309)]
    df = spark.createDataFrame(rows, "k long").repartition(6)
    assert heavy_keys(df, "k", 0.1) == [1, 2]
    assert heavy_keys(df, "k", 0.1, buckets=1) == [1, 2]  # every key in one cell
    assert heavy_keys(df, "k", 0.6) == [] and heavy_keys(df.limit(0), "k") == []


def test_a_hot_key_is_spread(spark):
    own = spark.newSession()
    for key, value in {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
                       "spark.sql.adaptive.enabled": "false"}.items():
        own.conf.set(key, value)
    big = own.range(60_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"))
    other = own.range(0, 5000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        plain, split = big.join(other, "k", how), measured_hot_join(big, other, "k", how, share=0.05)
        assert sorted(map(tuple, split.select("id", "k", "v").collect()), key=str) == sorted(
            map(tuple, plain.select("id", "k", "v").collect()), key=str)

    def tasks(joined):
        return [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]

    spread, gathered = tasks(measured_hot_join(big, other, "k", "left", share=0.05)), tasks(big.join(other, "k", "left"))
    assert max(spread) <= 2 * statistics.median(spread)
    assert max(gathered) > 4 * statistics.median(gathered)


# ---------------------------------------------------------------------- numbering

def test_numbers_by_ranges_without_a_checkpoint(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "b", "a", "é", "hot", "hot", "hot"]), rng.randrange(-50, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, n int, id long").repartition(7)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    stored = glob.glob(f"{folder}/**", recursive=True)
    out = range_sequence(df, ["k", "n", "id"], out="at", start=10, ranges=9)
    got = sorted((r["at"], r["id"]) for r in out.collect())
    want = sorted(rows, key=lambda t: (t[0] is not None, (t[0] or "").encode(), t[1], t[2]))
    assert got == [(10 + i, r[2]) for i, r in enumerate(want)]
    assert glob.glob(f"{folder}/**", recursive=True) == stored
    widest = max(r["n"] for r in range_sequence(df, ["k", "n", "id"], ranges=9, keep_range=True)
                 .groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect())
    assert widest < 3 * len(rows) / 9  # a hot key is cut too, by what follows it in the order
    assert range_sequence(df.limit(0), ["k"]).count() == 0
    assert [r["seq"] for r in range_sequence(df.limit(1), ["k"]).collect()] == [0]


def test_a_small_input_is_numbered_in_partitions(spark):
    df = spark.createDataFrame([(None if i % 5 == 0 else i % 3, i) for i in range(30)], "k int, id long").repartition(3)
    out = range_sequence(df, ["k", "id"])
    got = [r["id"] for r in sorted(out.collect(), key=lambda r: r["seq"])]
    assert got == [i for _, i in sorted((-1 if i % 5 == 0 else i % 3, i) for i in range(30))]
    specs = re.findall(r"windowspecdefinition\((\S+)", out._jdf.queryExecution().executedPlan().toString())
    assert specs and all(s.startswith("_range#") for s in specs)
