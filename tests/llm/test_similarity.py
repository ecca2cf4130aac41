"""Fingerprints, n-gram join and substring removal against brute force."""

import hashlib
import random

import numpy as np
import pytest
from llm_rules import components, repeated_bytes

from gridloom.llm import components as cc
from gridloom.llm import fingerprint as fp
from gridloom.llm import ngram_join, suffix_dedup
from gridloom.llm.suffix_sort import suffix_order

DOCS = "doc_id long, text string, lang string"


def words(rng, n, pool=4000):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


def mutated(rng, text, n):
    out = text.split(" ")
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10 ** 6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    base, passage = words(rng, 150), words(rng, 80)
    out = [words(rng, rng.randrange(1, 120)) for _ in range(40)]
    out += [mutated(rng, base, rng.randrange(0, 7)) for _ in range(60)]      # a large group of near copies
    out += [base] * 10                                                       # and of copies
    out += [words(rng, 30) + " " + passage + " " + words(rng, rng.randrange(1, 40)) for _ in range(30)]
    out += [passage + " " + words(rng, rng.randrange(1, 30)) for _ in range(20)]
    out += ["", "   \n", "One two", "one  TWO", "one two three four", None, None, "É é É é É é", words(rng, 9000)]
    out += [words(rng, 3, 2) for _ in range(8)]
    return out


# ----------------------------------------------------------------- n-gram join

def test_components_match_brute_force(spark, texts):
    rows = [(i * 3, t, "en") for i, t in enumerate(texts)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in ngram_join.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == components([(i, t) for i, t, _ in rows])
    assert len({c for _, c in got.values()}) < len(rows) - 60


def test_ngram_join_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (1, "z y x w v u", "x"), (None, "a b c d e f", None),
            (5, None, None), (None, None, None)]
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"])
                 for r in ngram_join.near_duplicates(spark.createDataFrame(rows, DOCS)).collect())
    assert got == sorted([("1", 2, "1", True), ("1", 2, "1", False), ("1", 2, "1", True), ("None", 2, "1", False),
                          ("5", 0, "5", True), ("None", 0, "None", True)])


def test_rows_without_words_are_no_copies(spark):
    rows = [(None, None, "a"), (None, None, "b"), (None, "", "a"), (7, "", "a"), (7, None, "a"), (7, " \t", "a"), (7, " \t", "b"),
            (8, "one two", "a"), (8, "one two", "a"), (None, "one three", "a"), (None, "one three", "a")]
    left = ngram_join.drop_near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, left)) == sorted(map(key, rows[:8] + rows[9:10]))


def test_drop_near_duplicates_keeps_columns_and_clean_rows(spark, texts):
    docs = spark.createDataFrame([(i, t, "en", i) for i, t in enumerate(texts)],
                                 "doc_id long, text string, kept string, node int")
    left = ngram_join.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    want = {i for i, (_, c) in components(list(enumerate(texts))).items() if i == c}
    got = {r["doc_id"]: r["node"] for r in left.collect()}
    assert set(got) == want and all(k == v for k, v in got.items())


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert ngram_join.near_duplicates(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert fp.edit_chain(empty, fp.fit_ranks(empty)).count() == 0


def test_connected_components_chain_and_hub(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in
           cc.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{100 + i: 100 for i in range(30)}}


# ------------------------------------------------------------------- suffixes

def test_suffix_order_is_lexicographic(spark):
    rng = random.Random(9)
    strings = [[rng.randint(1, 2) for _ in range(rng.randint(1, 30))] for _ in range(8)]
    strings += [strings[0][:], [1] * 20]
    rows = [(s, 0, i, x) for s, string in enumerate(strings) for i, x in enumerate(string)]
    got = {(r["sid"], r["off"]): r["rank"] for r in suffix_order(
        spark.createDataFrame(rows, "sid long, path long, off long, sym long"), 9).collect()}
    assert len(got) == len(rows)
    order = sorted(got, key=got.get)
    suffixes = [strings[s][i:] for s, i in order]
    assert all(a <= b for a, b in zip(suffixes, suffixes[1:]) if a != b)
    assert suffixes == sorted(suffixes)


def test_repeats_match_brute_force(spark):
    rng = random.Random(3)
    shared = [words(rng, 150) for _ in range(3)]
    out = [words(rng, rng.randrange(10, 300)) for _ in range(15)]
    for _ in range(15):  # passages cut anywhere, between text of their own
        p = rng.choice(shared)
        a, b = sorted(rng.sample(range(len(p)), 2))
        out.append(words(rng, 20) + p[a:b] + "é" * rng.randrange(3) + words(rng, 20) + p[:rng.randrange(len(p))])
    copy = words(rng, 200)
    out += [copy, copy, copy + " and more", "ab" * 450, "x" * 399, "x" * 401, "", None, "short", "short",
            shared[0] * 2, "1234567 " * 120]
    docs = spark.createDataFrame([(i, t, "l") for i, t in enumerate(out)], DOCS)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in suffix_dedup.remove_repeats(docs).collect()}
    want = repeated_bytes(out, 400)
    assert [got[i] for i in range(len(out))] == want
    assert sum(w[1] > 0 for w in want) > 15


# --------------------------------------------------------------- fingerprints

def test_entropy_classes_match_the_definition():
    data = np.random.default_rng(1).integers(97, 110, 400).astype(np.uint8)
    got = fp.entropy_classes(data)
    for i in range(0, len(data) - 63, 17):
        share = np.bincount(data[i:i + 64])
        share = share[share > 0] / 64
        assert abs(got[i] - 1000 * -(share * np.log2(share)).sum() / 6) <= 1


def test_digests_do_not_depend_on_the_batch():
    rng = random.Random(2)
    texts = [words(rng, rng.randrange(0, 900)).encode() for _ in range(12)] + [b"", b"tiny", b"y" * 64]
    ranks = np.arange(fp.CLASSES)
    together = fp.digests(texts, ranks)
    for text, found in zip(texts, together):
        alone = fp.digests([text], ranks)[0]
        assert np.array_equal(alone, found)
        assert fp.likeness(found, alone) == pytest.approx(1.0)
        assert np.array_equal(fp.from_text(fp.to_text(found)), found)
    assert fp.likeness(together[0], together[-3]) == 0.0 and fp.likeness(together[-3], together[-3]) == 1.0


def test_likeness_falls_with_edits():
    rng = random.Random(8)
    text = words(rng, 1500)
    ranks = np.arange(fp.CLASSES)
    near = [fp.likeness(*fp.digests([text.encode(), mutated(rng, text, n).encode()], ranks)) for n in (0, 5, 60, 1000)]
    assert near[0] == pytest.approx(1.0) and near[0] > near[1] > near[2] > near[3] and near[1] > 0.7 and near[3] < 0.2


def test_edit_chain_follows_the_falling_ids(spark, texts):
    rows = [(i * 7 % 997, t, "l") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    got = {r["doc_id"]: r for r in fp.edit_chain(docs, fp.fit_ranks(docs)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for (i, t, _), (_, following, _) in zip(order, order[1:] + order[:1]):
        t, following = t or "", following or ""
        edited = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    same = {}
    for i, t, _ in rows:
        assert same.setdefault(t or "", got[i]["fingerprint"]) == got[i]["fingerprint"]


def test_edit_chain_with_ties_and_null_ids(spark):
    rows = [(1, "abc" * 50, "l"), (1, "abc" * 50, "l"), (None, "q" * 100, "l"), (None, None, "l")]
    docs = spark.createDataFrame(rows, DOCS)
    assert fp.edit_chain(docs, fp.fit_ranks(docs)).count() == 4
    one = spark.createDataFrame(rows[:1], DOCS)
    assert fp.edit_chain(one, fp.fit_ranks(one)).first()["near_next"] == pytest.approx(1.0)
