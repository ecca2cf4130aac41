"""The n-gram join's work grows with its input, not with the square of a
common passage's documents nor with the number of fragments."""

import random

import pyarrow as pa
import pytest
from llm_rules import components
from pyspark.sql import functions as F

from gridloom.llm import ngram_join

DOCS = "doc_id long, text string, lang string"


def test_common_passages_stay_out_of_the_prefixes(spark, monkeypatch):
    rng = random.Random(11)
    notice, rows = " ".join(f"n{i}" for i in range(25)), []
    for i in range(60):
        own = [f"w{rng.randrange(10 ** 6)}" for _ in range(60)]
        for j in range(2):
            own[30 + j] = f"x{i}"
            rows.append((2 * i + j, " ".join([*own, notice]), "en"))
    seen, partners = [], ngram_join._partners
    monkeypatch.setattr(ngram_join, "_partners", lambda entries: seen.append(entries) or partners(entries))
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == components([r[:2] for r in rows])
    assert {r["component_id"] for r in found} == {2 * i for i in range(60)}
    groups = seen[0].groupBy("shingle").agg(F.count("*").alias("n"))
    assert groups.agg(F.max("n")).first()[0] == 2


def test_shipped_bytes_do_not_grow_with_the_fragments():
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(10 ** 5)}" for _ in range(400)) for _ in range(400)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(400), pa.int64()), "text": texts})

    def shipped(fragments):
        return sum(b.nbytes for b in ngram_join._ship(fragments, 5)(iter([batch])))

    assert shipped(2048) < 1.25 * shipped(64)


def test_batches_that_changed_in_a_second_run_are_refused():
    rows = pa.RecordBatch.from_pydict({
        "batch": pa.array([5, 5], pa.int64()), "stamp": pa.array([1, 2], pa.int64()),
        "rows": pa.array([2, 2], pa.int32()), "hashes": [b"", bytes(8)],
        "owners": [b"", bytes(2)], "ids": pa.array([[1], None], pa.list_(pa.int64())),
        "texts": pa.array([[7], None], pa.list_(pa.int64())), "copies": pa.array([[1], None], pa.list_(pa.int32())),
        "sizes": pa.array([[1], None], pa.list_(pa.int32()))})
    with pytest.raises(RuntimeError, match="another order"):
        list(ngram_join._sets(iter([rows])))
    same = rows.set_column(1, "stamp", pa.array([1, 1], pa.int64()))
    with pytest.raises(RuntimeError, match="another order"):
        list(ngram_join._sets(iter([same.slice(0, 1)])))
    (found,) = ngram_join._sets(iter([same]))
    assert found.column("held").to_pylist() == [[0]] and found.column("size").to_pylist() == [1]
