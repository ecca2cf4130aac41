"""Chunk ledger, replaced partitions, ordered parts, header index."""

import csv
import glob
import json
import os
import random
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from gridloom.operators.ledger import ChunkLedger, folder_below, folder_versions
from gridloom.plans import jobs
from gridloom.sinks import writers
from gridloom.sources import files, headers


def put(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        csv.writer(fh).writerows(rows)


def stamps(root):
    """Every data file below ``root`` with its time and size."""
    found = {}
    for p in glob.glob(f"{root}/**/*", recursive=True):
        if os.path.isfile(p):
            found[os.path.relpath(p, root)] = (os.stat(p).st_mtime_ns, os.path.getsize(p))
    return found


# ----------------------------------------------------------------- chunk ledger

PARTS = "chunk string, key string, s double, n long"
NAMED = "chunk string, version string"


def total(book):
    return {r["key"]: (r["s"], r["m"]) for r in book.merged(["key"], ["s", "n"], {"m": ("s", "n")}).collect()}


def test_a_chunk_replaces_itself(spark, tmp_dir):
    book = ChunkLedger(spark, f"{tmp_dir}/l")
    assert book.recorded().count() == 0
    with pytest.raises(FileNotFoundError):
        book.partials()
    one = spark.createDataFrame([("007", "a", 1.0, 2), ("7", "a", 5.0, 1), ("7", "b", 4.0, 2), ("x y/z", "b", 2.0, 1)], PARTS)
    named = spark.createDataFrame([("007", "v1"), ("7", "v1"), ("x y/z", "v1"), ("empty", "v1")], NAMED)
    book.record(one, named)
    assert total(book) == {"a": (6.0, 2.0), "b": (6.0, 2.0)}
    assert {tuple(r) for r in book.recorded().collect()} == {tuple(r) for r in named.collect()}
    before = stamps(tmp_dir)
    book.record(spark.createDataFrame([("7", "a", 10.0, 5)], PARTS), spark.createDataFrame([("7", "v2")], NAMED))
    assert total(book) == {"a": (11.0, 11 / 7), "b": (2.0, 2.0)}
    after = stamps(tmp_dir)
    assert all(after.get(p) == t for p, t in before.items() if "/chunk=" in p and "chunk=7/" not in p)
    # a rerun without partials empties the chunk
    book.record(one.limit(0), spark.createDataFrame([("7", "v3")], NAMED))
    assert total(book) == {"a": (1.0, 0.5), "b": (2.0, 2.0)}
    # the same again counts once
    book.record(one.where("chunk = '007'"), named.where("chunk = '007'"))
    assert total(book)["a"] == (1.0, 0.5)


def test_pending_vanished_withdrawn(spark, tmp_dir):
    book = ChunkLedger(spark, f"{tmp_dir}/l")
    named = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "a")], NAMED)
    assert book.pending(named).count() == 3
    book.withdraw(named)  # nothing is there yet
    book.record(spark.createDataFrame([(c, "k", 1.0, 1) for c in "123"], PARTS), named)
    now = spark.createDataFrame([("1", "a"), ("2", "b"), ("4", "a")], NAMED)
    assert {r["chunk"] for r in book.pending(now).collect()} == {"2", "4"}
    assert [r["chunk"] for r in book.vanished(now).collect()] == ["3"]
    book.withdraw(book.vanished(now).checkpoint())
    assert total(book)["k"][0] == 2.0
    assert {r["chunk"] for r in book.recorded().collect()} == {"1", "2"}
    assert book.pending(named).count() == 1  # a withdrawn chunk is wanted again


def test_a_ledger_refuses_stray_chunks(spark, tmp_dir):
    book = ChunkLedger(spark, f"{tmp_dir}/l")
    rows = spark.createDataFrame([("1", "k", 1.0, 1), ("2", "k", 1.0, 1)], PARTS)
    book.record(rows.where("chunk = '1'"), spark.createDataFrame([("1", "a")], NAMED))
    for bad, named in ((rows, [("1", "b")]), (rows.where("chunk = '1'"), [("1", "b"), ("1", "c")])):
        with pytest.raises(Exception, match="not recorded|named twice"):
            book.record(bad, spark.createDataFrame(named, NAMED))
        assert [tuple(r) for r in book.recorded().collect()] == [("1", "a")]
    # a measure that only later chunks have
    book.record(spark.createDataFrame([("2", "k", 1.0, 1, 3.0)], PARTS + ", late double"), spark.createDataFrame([("2", "a")], NAMED))
    assert [tuple(r) for r in book.merged(["key"], ["s", "late"]).collect()] == [("k", 2.0, 3.0)]


def test_chunks_are_folders(spark):
    rows = [("file:/a/b/u=1/s=AL/x.csv", 1, 5), ("file:///a/b/u=1/s=AL/y.csv", 1, 5), ("file:/a/b/z.csv", 1, 5)]
    listing = spark.createDataFrame(rows, "path string, length long, modificationTime long")
    got = {r["chunk"]: r["version"] for r in folder_versions(listing, "/a/b").collect()}
    assert set(got) == {"u=1/s=AL", "."}
    moved = {r["chunk"]: r["version"] for r in folder_versions(listing.withColumn("length", F.lit(2)), "file:/a/b/").collect()}
    assert set(moved) == set(got) and not set(moved.values()) & set(got.values())
    paths = spark.createDataFrame([("viewfs://store/a/b/c d/x.csv",)], "p string")
    assert paths.select(folder_below(F.col("p"), "viewfs://store/a/b")).first()[0] == "c d"


HDR = ["timestamp", "in.state", "in.geometry_building_type_recs", "upgrade", "units_represented",
       "out.electricity.cooling.energy_consumption.kwh", "out.electricity.fan.energy_consumption.kwh"]


def energy_rows(rng, state, n):
    # state and building type repeat over files and folders, so groups span chunks
    return [[f"2018-01-0{rng.randrange(1, 3)} 0{rng.randrange(0, 3)}:{rng.choice(['15', '30', '45'])}:00", state,
             rng.choice(["Office", "School"]), rng.randrange(2), rng.choice([10, 20, "NA"]), rng.randrange(50) / 4, rng.choice([1, "", 2])]
            for _ in range(n)]


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    key = lambda r: tuple(str(r[c]) for c in cols if c not in ("kWh", "units_represented"))
    x, y = ({key(r): (r["kWh"], r["units_represented"]) for r in f.collect()} for f in (a, b))
    assert x.keys() == y.keys() and x
    for k in x:
        assert x[k][0] == pytest.approx(y[k][0]) and x[k][1] == pytest.approx(y[k][1])


@pytest.mark.parametrize("by_building_type", [False, True])
def test_incremental_table_equals_one_pass(spark, tmp_dir, by_building_type):
    rng, root, book = random.Random(4), f"{tmp_dir}/in put", f"{tmp_dir}/book"
    for folder in ("u=0/s=AL", "u=1/s=AL", "u=0/s=AK"):
        for part in "ab":
            put(f"{root}/{folder}/{part}.csv", [HDR, *energy_rows(rng, folder[-2:], 25)])

    def check():
        got = jobs.long_end_use_incremental(spark, root, book, by_building_type=by_building_type)
        same(got, jobs.long_end_use_table(spark, root, by_building_type=by_building_type))

    check()
    kept = stamps(f"{book}/partials")
    check()  # nothing new: no partial is written
    assert stamps(f"{book}/partials") == kept
    put(f"{root}/u=0/s=AK/b.csv", [HDR, *energy_rows(rng, "AK", 7)])  # changed
    put(f"{root}/u=2/s=CA/a.csv", [[*HDR[:5], HDR[6], "out.electricity.new.energy_consumption.kwh"],  # other columns
                                   *[r[:5] + [r[5], 3] for r in energy_rows(rng, "CA", 9)]])
    check()
    now = stamps(f"{book}/partials")
    assert {p for p in kept if now.get(p) != kept[p] and p.endswith(".parquet")} == {
        p for p in kept if "s%3DAK" in p and p.endswith(".parquet")}
    os.remove(f"{root}/u=1/s=AL/a.csv")
    os.remove(f"{root}/u=1/s=AL/b.csv")
    check()


# ---------------------------------------------------------- replaced partitions

def test_other_partitions_keep_their_files(spark, tmp_dir):
    out = f"{tmp_dir}/x"
    rows = [(i, f"{i % 5:02d}", "a b" if i % 2 else "c/d", float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, nation string, kind string, v double")
    first = writers.replace_partitions(df, out, ["nation", "kind"])
    assert {(r["nation"], r["kind"]): r["n_rows"] for r in first.collect()} == {(f"{n:02d}", k): 10 for n in range(5) for k in ("a b", "c/d")}
    before = stamps(out)
    new = df.where("nation = '03' and kind = 'a b' and id > 20").withColumn("v", -F.col("v"))
    changed = writers.replace_partitions(new, out, ["nation", "kind"], covers=[("03", "a b"), ("04", "c/d"), ("99", "zz")])
    assert {(r["nation"], r["kind"], r["n_rows"]) for r in changed.collect()} == {("03", "a b", 8), ("04", "c/d", 0)}
    after = stamps(out)
    touched = {p.split("/part-")[0].split("/.part-")[0] for p in {*before, *after} if before.get(p) != after.get(p)
               and not p.startswith("_") and "part-" in p}
    assert touched == {"nation=03/kind=a b", "nation=04/kind=c%2Fd"}
    ledger = {(r["nation"], r["kind"]): r["n_rows"] for r in writers.row_ledger(spark, out, ["nation", "kind"]).collect()}
    assert ledger == {(f"{n:02d}", k): 10 for n in range(5) for k in ("a b", "c/d")} | {("03", "a b"): 8, ("04", "c/d"): 0}
    held = {r["id"]: r["v"] for r in files.read_parquet_tree(spark, out).collect()}
    want = {i: v for i, n, k, v in rows if (n, k) not in (("03", "a b"), ("04", "c/d"))}
    assert held == want | {i: -v for i, n, k, v in rows if (n, k) == ("03", "a b") and i > 20}


def test_extract_of_one_state_is_replaced(spark, tmp_dir):
    tree, out = f"{tmp_dir}/tree", f"{tmp_dir}/extract"
    df = spark.createDataFrame([(i, "AL" if i % 2 else "CA", f"{i % 3:03d}") for i in range(12)], "id long, state string, puma string")
    df.write.partitionBy("state").parquet(tree)
    jobs.annual_extract(spark, tree, out, partition_by=["state"], replace=True)
    before = {p: t for p, t in stamps(out).items() if p.startswith("state=CA")}
    shutil.rmtree(f"{tree}/state=AL")
    df.where("id = 1").drop("state").write.parquet(f"{tree}/state=AL")
    jobs.annual_extract(spark, tree, out, state="AL", partition_by=["state"], replace=True)
    assert {p: t for p, t in stamps(out).items() if p.startswith("state=CA")} == before
    assert sorted(r["id"] for r in files.read_parquet_tree(spark, out).collect()) == [0, 1, 2, 4, 6, 8, 10]
    shutil.rmtree(f"{tree}/state=AL")
    jobs.annual_extract(spark, tree, out, state="AL", partition_by=["state"], replace=True)  # none left
    assert sorted(r["id"] for r in files.read_parquet_tree(spark, out).collect()) == [0, 2, 4, 6, 8, 10]


# ------------------------------------------------------------------ ordered parts

def test_parts_are_in_order(spark, tmp_dir):
    rng = random.Random(3)
    # one key holds most rows, some are null, texts need quoting
    rows = [(rng.choice(["hot", "hot", "hot", None, "a", 'q"x', "zé,"]), rng.randrange(50) / 8, f"r{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v double, id string").repartition(7)
    index = writers.write_sorted_parts(df, f"{tmp_dir}/s", ["k", "v"], num_parts=6).orderBy("part").collect()
    assert len(index) >= 5 and sum(r["n_rows"] for r in index) == len(rows)
    names = sorted(os.path.basename(p) for p in glob.glob(f"{tmp_dir}/s/*.csv"))
    assert [r["name"] for r in index] == names
    found, start = [], 0
    for r in index:
        with open(f"{tmp_dir}/s/{r['name']}", newline="") as fh:
            part = list(csv.reader(fh, escapechar="\\"))
        assert part[0] == ["k", "v", "id"] and len(part) - 1 == r["n_rows"] and r["start"] == start
        start += r["n_rows"]
        found += [(k or None, float(v), i) for k, v, i in part[1:]]
    assert found == sorted(rows, key=lambda t: (t[0] is not None, (t[0] or "").encode(), t[1], t[2]))
    assert sum("hot" == (r["first"]["k"] or "") == (r["last"]["k"] or "") for r in index) >= 2  # a hot key over several parts
    typed = writers.read_sorted_parts(df.schema, spark, f"{tmp_dir}/s")
    assert sorted(map(str, typed.collect())) == sorted(map(str, df.collect()))


def test_no_rows_no_parts(spark, tmp_dir):
    df = spark.createDataFrame([], "k string, v double")
    assert writers.write_sorted_parts(df, f"{tmp_dir}/s", ["k"]).count() == 0


def test_lists_are_written_by_all_tasks(spark, tmp_dir):
    rows = spark.range(40).select(F.concat(F.lit("k"), "id").alias("key"), F.lit("error").alias("status")).repartition(4)
    writers.write_key_list(rows, f"{tmp_dir}/many")
    writers.write_key_list(rows, f"{tmp_dir}/one", single_file=True)
    assert len(glob.glob(f"{tmp_dir}/many/part-*")) == 4 and len(glob.glob(f"{tmp_dir}/one/part-*")) == 1
    writers.write_quoted_csv(rows, f"{tmp_dir}/quoted")
    assert len(glob.glob(f"{tmp_dir}/quoted/part-*")) == 4
    for out in ("many", "one"):
        assert sorted(r[0] for r in spark.read.text(f"{tmp_dir}/{out}").collect()) == sorted(f"k{i}" for i in range(40))


# -------------------------------------------------------------------- type lattice

VALUES = {"int": ["1", "-3", " 7 ", "+4"], "big": ["99999999999999999999", "1"], "num": ["1.5", "2", "1e3"], "bool": ["True", "false"],
          "text": ["1", "x"], "none": ["NA", "", None], "mixed": ["True", "1"], "inf": ["1", "Infinity"]}
TYPES = {"int": "bigint", "big": "double", "num": "double", "bool": "boolean", "text": "string", "none": "double", "mixed": "string",
         "inf": "double"}


def test_types_of_wide_rows_in_one_aggregate(spark):
    n = max(map(len, VALUES.values()))
    wide = {f"{k}.{i}": v for i in range(7) for k, v in VALUES.items()}  # four packs
    rows = [tuple(v[j] if j < len(v) else None for v in wide.values()) for j in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in wide)).repartition(3)
    assert headers.infer_text_types(df) == {f"{k}.{i}": t for i in range(7) for k, t in TYPES.items()}
    assert headers.infer_text_types(df, ["int.0", "text.3"]) == {"int.0": "bigint", "text.3": "string"}
    assert headers.infer_text_types(df.limit(0)) == dict.fromkeys(wide, "double")
    plan = df.agg(*headers.packed_flags(list(wide)))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan and plan.count("HashAggregate") + plan.count("SortAggregate") == 2


def test_heads_by_jobs_and_by_a_scan(spark, tmp_dir):
    for i, name in enumerate(["a b.csv", "x[1]{y}.csv", "deep/er/é+%20.csv", "quoted.csv"]):
        put(f"{tmp_dir}/t/{name}", [["id", f"c{i % 2}"]] + [[j, "v"] for j in range(50)])
    open(f"{tmp_dir}/t/none.csv", "w").close()  # no header
    with open(f"{tmp_dir}/t/bom.csv", "wb") as fh:
        fh.write("﻿id,c1\r\n1,2\r\n".encode())
    paths = [r["path"] for r in headers.list_files(spark, f"{tmp_dir}/t", "*.csv").collect()]
    heads = headers.read_heads(spark, paths)
    assert sorted(heads.values()) == ["id,c0"] * 2 + ["id,c1"] * 3
    assert {r["path"]: r["header"] for r in headers.scan_heads(spark, f"{tmp_dir}/t", "*.csv").collect()} == heads
    assert files.read_csv_tree(spark, f"{tmp_dir}/t").count() == 201


def test_flags_merge_over_files(spark, tmp_dir):
    root, index = f"{tmp_dir}/t", f"{tmp_dir}/i"
    put(f"{root}/a/x.csv", [["id", "v", "flag"], ["1", "2", "True"], ["2", "NA", ""]])
    put(f"{root}/b/x.csv", [["flag", "id", "extra"], ["False", "3", "9"]])
    first = files.read_csv_tree(spark, root, index=index)
    assert dict(first.dtypes) == {"id": "bigint", "v": "bigint", "flag": "boolean", "extra": "bigint"}
    assert dict(first.dtypes) == dict(files.read_csv_tree(spark, root).dtypes)
    kept = stamps(index)
    assert dict(files.read_csv_tree(spark, root, index=index).dtypes) == dict(first.dtypes)
    assert stamps(index) == kept
    put(f"{root}/c/new.csv", [["id", "v", "flag"], ["4", "2.5", "maybe"]])
    put(f"{root}/b/x.csv", [["flag", "id", "extra"], ["False", "3", "nine"], ["True", "5", "1"]])  # changed in place
    df = files.read_csv_tree(spark, root, index=index)
    assert dict(df.dtypes) == {"id": "bigint", "v": "double", "flag": "string", "extra": "string"}
    assert dict(df.dtypes) == dict(files.read_csv_tree(spark, root).dtypes)
    assert sorted(r["id"] for r in df.collect()) == [1, 2, 3, 4, 5]
    os.remove(f"{root}/c/new.csv")  # what a removed file said is forgotten
    assert dict(files.read_csv_tree(spark, root, index=index).dtypes)["v"] == "bigint"


SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", {log!r}).config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
         .config("spark.hadoop.fs.viewfs.mounttable.store.link./in", "file://" + {data!r}).getOrCreate())
from gridloom.sources.headers import HeaderIndex
n = spark.sparkContext
for i, root in enumerate([{data!r}, {data!r}, "viewfs://store/in"]):
    n.setJobGroup("run%d" % i, "run")
    rows = HeaderIndex(spark, root, "*.csv", {index!r} + ("" if i < 2 else "-view")).headers().collect()
    assert sorted(r["header"] for r in rows) == ["a,b", "a,c", "a,c"], rows
"""


def test_only_the_heads_of_files_are_read(tmp_dir):
    line = "1," + "x" * 90 + "\n"
    for name, head in (("one", "a,b"), ("two", "a,c"), ("deep/three", "a,c")):
        os.makedirs(os.path.dirname(f"{tmp_dir}/in/{name}"), exist_ok=True)
        with open(f"{tmp_dir}/in/{name}.csv", "w") as fh:
            fh.write(head + "\n" + line * 250_000)
    size = sum(os.path.getsize(p) for p in glob.glob(f"{tmp_dir}/in/**/*.csv", recursive=True))
    os.makedirs(f"{tmp_dir}/log")
    script = SCRIPT.format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), log=f"file://{tmp_dir}/log",
                           data=f"{tmp_dir}/in", index=f"{tmp_dir}/index")
    subprocess.run([sys.executable, "-c", script], check=True, timeout=240, capture_output=True)
    group, read = {}, {}
    with open(glob.glob(f"{tmp_dir}/log/*")[0]) as fh:
        for event in map(json.loads, fh):
            if event["Event"] == "SparkListenerJobStart":
                for s in event["Stage IDs"]:
                    group[s] = event["Properties"].get("spark.jobGroup.id")
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                run = group[event["Stage ID"]]
                read[run] = read.get(run, 0) + event["Task Metrics"]["Input Metrics"]["Bytes Read"]
    assert size > 60e6
    # heads, and small tables of the index itself
    assert 0 < read["run0"] < 12e6 and 0 < read["run2"] < 12e6
    assert read["run1"] < 100_000
