"""Mixing, WARC archives, the pipeline and the registered queries."""

import hashlib
import random
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from conftest import SF_SMALL
from llm_rules import base_secrets, components, contamination
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from gridloom.llm import mixing, queries, toxicity, warc
from gridloom.llm.common import store
from gridloom.sources.tables import table

DOCS = "doc_id long, text string, source string"


# --------------------------------------------------------------------- mixing

def shared_out(sizes, weights, share=1.5, most=2.0):
    """Targets by repeated resharing of what is above a source's limit."""
    targets, free, left = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while True:
        total = sum(weights[i] for i in free)
        for i in free:
            targets[i] = left * weights[i] / total
        over = {i for i in free if targets[i] > most * sizes[i]}
        if not over:
            return targets
        for i in over:
            targets[i] = most * sizes[i]
            left -= targets[i]
        free -= over


def test_water_fill():
    rng = random.Random(1)
    for n in (1, 2, 5, 20):
        sizes = [rng.randrange(1, 1000) for _ in range(n)]
        weights = [(3, 1, 2)[i % 3] for i in range(n)]
        assert mixing.water_fill(sizes, weights, 1.5, 2.0) == pytest.approx(shared_out(sizes, weights))
    assert mixing.water_fill([0, 10], [3, 1], 1.5, 2.0) == pytest.approx([0, 15])
    assert mixing.water_fill([], [], 1.5, 2.0) == []


def test_split_tree_keeps_quotas_and_evens_shards():
    quotas = [1000, 3, 0, 517]
    split = mixing.split_tree(quotas, 7, 5)
    assert split.sum(axis=1).tolist() == quotas
    assert split.sum(axis=0).max() - split.sum(axis=0).min() <= 3
    assert np.array_equal(split, mixing.split_tree(quotas, 7, 5))


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 60))),
             rng.choice(["b", "b", "b", "a", "Z", "é", None])) for i in range(900)]
    rows += [(2000, None, "empty"), (2001, "", "empty"), (2002, "  \t", "empty"), (None, "one two", "a"), (5, "x y z", "a"), (5, "x y z", "a")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("shard", F.lit("mine"))
    return rows, docs, mixing.plan_mix(docs).collect()


def test_mix_meets_targets(spark, mixed):
    rows, docs, plan = mixed
    assert len(plan) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    totals = defaultdict(int)
    for _, t, s in rows:
        totals[s] += size(t)
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    want = dict(zip(names, shared_out([totals[n] for n in names], [(3, 1, 2)[i % 3] for i in range(len(names))])))
    taken = Counter()
    for r in plan:
        assert r["source_size"] == totals[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["size"] * r["copies"] <= 2 * r["size"] and len(r["shards"]) == r["copies"]
        taken[r["source"]] += r["taken"]
    for s in names:
        assert abs(taken[s] - want[s]) <= 3
    again = mixing.plan_mix(docs.repartition(7)).collect()
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["taken"], r["shards"])
    assert sorted(map(key, again)) == sorted(map(key, plan))


def test_mix_of_any_number_of_sources(spark):
    n = 100_001
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', 1 + id % 7)").alias("text"),
                                 F.format_string("host%06d", "id").alias("source"))
    plan = mixing.plan_mix(docs, shards=8).select("source", "source_size", "target", "copies", "shards").toPandas()
    plan = plan.sort_values("source", ignore_index=True)
    sizes, weights = [1 + i % 7 for i in range(n)], [(3, 1, 2)[i % 3] for i in range(n)]
    assert plan["source_size"].tolist() == sizes
    assert plan["target"].to_numpy() == pytest.approx(np.array(mixing.water_fill(sizes, weights, 1.5, 2.0)))
    assert (plan["shards"].map(len) == plan["copies"]).all()
    dealt = Counter(x for shards in plan["shards"] for x in shards)
    assert sorted(dealt) == list(range(8)) and max(dealt.values()) - min(dealt.values()) <= 3


def test_split_by_runs_of_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BATCH", 3)
    quotas = [40, 0, 7, 1, 300, 2, 2, 9, 0, 0, 55]
    table = spark.createDataFrame(list(enumerate(quotas)), "number long, quota long")
    split = np.array([r["split"] for r in mixing.split_sources(table, len(quotas), 8, 5).orderBy("number").collect()])
    assert split.min() >= 0 and split.sum(axis=1).tolist() == quotas
    assert split.sum(axis=0).max() - split.sum(axis=0).min() <= 3


def test_draw_beyond_the_limit_of_numpy(monkeypatch):
    rng = np.random.default_rng(3)
    counts = np.array([3 * 10**9, 5, 0, 2 * 10**9])
    got = mixing.draw(rng, counts, 10**9)
    assert got.sum() == 10**9 and (got >= 0).all() and (got <= counts).all()
    monkeypatch.setattr(mixing, "MAX_DRAW", 0)
    counts, n = np.array([30, 2, 0, 18]), 20
    draws = np.array([mixing.draw(rng, counts, n) for _ in range(4000)])
    assert (draws.sum(axis=1) == n).all() and (draws <= counts).all() and draws.min() == 0
    p = counts / 50
    assert draws.mean(axis=0) == pytest.approx(n * p, abs=0.15)
    assert draws.var(axis=0) == pytest.approx(n * p * (1 - p) * 30 / 49, rel=0.1)


def test_mix_rows(spark, mixed):
    rows, docs, plan = mixed
    out = mixing.mix(docs, shards=8)
    assert out.columns == ["doc_id", "text", "source", "copy", "shard", "shard_order"]
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    want = Counter()
    for i, t, _ in rows:
        copies = next(r["copies"] for r in plan if r["doc_id"] == i and r["size"] == len((t or "").split()))
        if copies:
            want[(i, t)] += copies
    assert got == want
    empty = docs.limit(0)
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0


# ----------------------------------------------------------------------- WARC

PAGES = "page_id long, url string, html string"


def test_warc_round_trip(spark):
    rng = random.Random(3)
    body = "<p>" + "x" * 200 + "é</p>"
    rows = [(i, f"http://h/{i}", "<html>" + " ".join(rng.choice("abcdef") * 5 for _ in range(900)) + f"{i}</html>") for i in range(60)]
    rows += [(70, "u", body), (71, "u", body), (65, "u\r\nWARC-Type: x", body), (72, None, "short"), (73, None, "short"), (74, "u", None),
             (75, "u", ""), (None, "u", body), (65, "u", body), (76, "u", "y" * 100_000)]
    pages = spark.createDataFrame(rows, PAGES)
    archives = store(warc.write_archives(warc.plan_records(pages), archive_size=60_000), "test-warc")
    contents = [r["content"] for r in archives.collect()]
    assert any(struct.unpack_from("<I", c)[0] == warc.DICT_MAGIC for c in contents)
    got = warc.read_archives(archives).collect()
    assert len(got) == len(rows) and all(r["error"] is None for r in got)
    seen = Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got)
    want = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        revisit = html == body and i not in (65, None)
        want[(i, "revisit" if revisit else "response", 65 if revisit else None, len(raw), hashlib.sha256(raw).hexdigest())] += 1
    assert seen == want
    for r in got:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
    assert warc.read_archives(warc.write_archives(warc.plan_records(pages.limit(0)))).count() == 0


def test_warc_files_and_broken_archives(spark, tmp_path):
    record = warc._record(7, "http://x", 3, hashlib.sha256(b"abc").hexdigest(), None, b"abc")
    good = warc.archive_bytes([record] * 3)
    (tmp_path / "a.warc.zst").write_bytes(good)
    (tmp_path / "b.warc.zst").write_bytes(good[:-5])
    (tmp_path / "c.warc.zst").write_bytes(zstandard.compress(record.replace(b"abc", b"abd")) + good)
    (tmp_path / "d.warc.zst").write_bytes(zstandard.compress(b"nothing") + zstandard.compress(record[:-1]))
    (tmp_path / "e.warc.zst").write_bytes(b"")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    got = defaultdict(list)
    for r in warc.read_archives(files).collect():
        got[r["path"][-10]].append(r["error"])
    assert got["a"] == [None] * 3
    assert got["b"][:2] == [None] * 2 and got["b"][2] == "truncated frame"
    assert "digest" in got["c"][0] and got["c"][1:] == [None] * 3
    assert len(got["d"]) == 2 and all(got["d"])


def test_frame_end_agrees_with_the_library():
    rng = random.Random(4)
    for size in (0, 1, 200, 70_000, 400_000):
        raw = bytes(rng.randrange(256) for _ in range(size // 2)) + b"z" * (size - size // 2)
        for options in ({}, {"write_content_size": False}, {"write_checksum": True}):
            frame = zstandard.ZstdCompressor(**options).compress(raw)
            assert warc.frame_end(memoryview(frame + b"tail"), 0) == len(frame)


# ------------------------------------------------------------------- pipeline

def test_pipeline_stages_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF_SMALL, "labels").collect()}
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]
    stages = dict(corpus_pipeline.STAGES)

    def after(name, rows):
        out = store(stages[name](spark, rows, SF_SMALL), f"test-{name}")
        if name != "mixing":
            assert out.columns == docs.columns
        return out

    calm = after("toxicity", docs)
    kept = {r["doc_id"]: r["text"] for r in calm.collect()}
    model = toxicity.fit(docs, table(spark, SF_SMALL, "labels"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert set(kept) == {i for i, s in scores.items() if s < 0.5}
    assert sum((i in kept) == (y == 0) for i, y in labels.items() if y is not None) >= 0.9 * len(labels)

    unique = after("near_duplicates", calm)
    left = {r["doc_id"]: r["text"] for r in unique.collect()}
    assert left == {i: kept[i] for i, (_, c) in components(list(kept.items())).items() if i == c}

    clean = after("decontamination", unique)
    now = {r["doc_id"]: (r["text"], r["n_chars"]) for r in clean.collect()}
    for i, (n, hit, _) in contamination(list(left.items()), items).items():
        assert (i in now) == (len(hit) <= 0.5 * n)
        if i in now:
            assert len(now[i][0]) == now[i][1]
            assert (now[i][0] == left[i]) == (not hit)

    safe = after("secrets", clean)
    for r in safe.collect():
        before = now[r["doc_id"]][0]
        assert (r["text"] == before) == (not base_secrets(before))
        assert not base_secrets(r["text"]) and r["n_chars"] == len(r["text"])

    mix = after("mixing", safe)
    copies = Counter(r["doc_id"] for r in mix.collect())
    plan = {r["doc_id"]: r["copies"] for r in mixing.plan_mix(safe).collect()}
    assert copies == Counter({i: n for i, n in plan.items() if n})


def test_pipeline_of_odd_rows(spark):
    odd = table(spark, SF_SMALL, "documents").limit(3).withColumn("hits", F.lit(1)).withColumn("score", F.lit("s"))
    rows = odd.unionByName(odd.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"),
                                               "lang", F.lit(None).cast("string").alias("source"), "n_chars", "hits", "score"))
    long = odd.limit(1).withColumns({"doc_id": F.lit(10 ** 6), "text": F.concat(F.repeat(F.lit("abc déf "), 100_000), F.col("text"))})
    tied = rows.unionByName(rows.limit(2)).unionByName(long)
    for docs in (rows, rows.limit(0), tied):
        n, wordless = docs.count(), docs.filter("text is null or text = ''").count()
        for name, stage in corpus_pipeline.STAGES:
            out = store(stage(spark, docs, SF_SMALL), f"odd-{name}")
            if name != "mixing":
                assert out.columns == docs.columns
                assert out.filter("text is null or text = ''").count() == wordless  # such rows stay in every filtering stage
                docs = out
        assert docs.count() <= n


# -------------------------------------------------------------------- queries

def test_every_operator_is_registered():
    known = entry.queries()
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.QUERIES) | {"pipeline"} <= set(known)


COLUMNS = {
    "op1_fingerprint": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
                        "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op2_ngram_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op3_secret_scan": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint",
                        "base_sha256": "string", "spans": "string"},
    "op4_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op6_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op7_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op8_decontamination": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint",
                            "items_sha256": "string", "contaminated": "boolean"},
    "op9_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op10_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11_filter_audit": {"part": "string", "filter_order": "string", "step": "int", "kept": "bigint", "removed": "bigint",
                          "redundant": "bigint", "unique_fails": "bigint", "good_lost": "bigint", "toxic_lost": "bigint", "shapley": "bigint"},
    "op12_language_mixture": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op13_prefix_trie": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint",
                         "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_columns(spark, name):
    kinds = dict(entry.queries()[name](spark, SF_SMALL).dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]


def test_secret_scan_is_native(spark):
    plan = queries.op3_secret_scan(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
