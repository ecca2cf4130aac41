"""Filter interaction audit and conversation prefix trie."""

import random
from fractions import Fraction
from itertools import permutations

import pytest
from llm_rules import filter_steps, rebuilt, trie_nodes
from pyspark.sql import functions as F

from gridloom.llm import filter_audit, prefix_trie

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"
TURNS = "conv_id long, turn long, role string, text string"


# --------------------------------------------------------------- filter audit

def audited(spark, rows, labels):
    docs = spark.createDataFrame(rows, DOCS).withColumn("mask", F.lit("x")).withColumn("n", F.lit(-1)).repartition(5)
    found = filter_audit.audit_documents(docs, spark.createDataFrame(labels, LABELS).withColumn("key", F.lit(1))).collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in found}
    assert len(out) == len(found)
    return out


def test_audit_against_every_order(spark):
    rng = random.Random(11)
    words = ["Alpha", "beta", "gamma", "DELTA", "#x", "é", "a|b", "zeta eta"] + [f"w{i}" for i in range(300)]
    texts = [" \t".join(rng.choice(words[rng.randrange(0, 9):rng.randrange(10, 300)]) for _ in range(rng.randrange(1, 420)))
             for _ in range(60)] + [None, "", " \n ", "A", "word " * 100_000]
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(150)]
    rows += rows[:10] + [(None, texts[0], "en"), (None, texts[0], "en"), (None, None, None), (-5, texts[1], "fr"), (-5, texts[1], "de")]
    labels = [(rng.randrange(-5, 150), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(120)]
    labels += [(None, 1, 1), (3, 0, 0), (3, 1, None), (9999, 1, 1)]
    assert audited(spark, rows, labels) == filter_steps(rows, labels)


def test_audit_of_little(spark):
    assert audited(spark, [], []) == {}
    one = audited(spark, [(1, None, None)], [])
    assert len(one) == 600 and one == filter_steps([(1, None, None)], [])
    copies = [(i, "same text", "en") for i in range(500)]  # all but the smallest id fail E
    got = audited(spark, copies, [(0, 1, 0), (1, 1, 1)])
    assert got["en", "EABCD", 1] == (1, 499, 0, 0, 1, 1, sum(499 for o in permutations("ABCDE") if o.index("E") < o.index("A")))


def test_potential_gives_the_shapley_value():
    rng = random.Random(2)
    for k in (1, 2, 3, 5):
        v = filter_audit.removal_game({m: rng.randrange(50) for m in range(1 << k)}, k)
        want = [Fraction(0)] * k
        for order in permutations(range(k)):
            before = 0
            for i in order:
                want[i] += v[before | 1 << i] - v[before]
                before |= 1 << i
        assert filter_audit.shapley_sums(v, k) == want
        # the potential's gradient adds up to the grand coalition's worth
        assert sum(want) == v[-1] * len(list(permutations(range(k))))


# ---------------------------------------------------------------- prefix trie

def nodes_of(frame):
    found = frame.collect()
    out = {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in found}
    assert len(out) == len(found)
    return out


def conversations(rng, n, most):
    """Conversations of few texts, so that many share prefixes and some are equal."""
    rows = []
    for c in rng.sample([*range(-150, 450), 10_000, 10_007, 2 ** 40], n):
        role = ["user", "assistant"]
        for t in range(rng.randrange(1, most)):
            rows.append((c, None if t == 0 and c % 7 == 0 else t * 3, rng.choice([None, role[t % 2]]), rng.choice(["a", "bb", "", None, "éé€"])))
    return rows


@pytest.mark.parametrize("width,span,page,heavy", [(4, 4096, 4096, 1000), (2, 2, 3, 5), (1, 3, 1, 2), (3, 1, 2, 10 ** 9)])
def test_trie_against_brute_force(spark, width, span, page, heavy):
    rng = random.Random(width)
    rows = conversations(rng, 120, 14)
    frame = spark.createDataFrame(rows, TURNS).withColumn("block", F.lit("b")).withColumn("depth", F.lit(0)).repartition(6)
    got = prefix_trie.rebuilt_trie(frame, width=width, span=span, page=page, heavy=heavy)
    assert nodes_of(got) == trie_nodes(rebuilt(rows))


def test_trie_of_odd_tables(spark):
    empty = spark.createDataFrame([], TURNS)
    assert nodes_of(prefix_trie.rebuilt_trie(empty)) == {}
    # no head conversation and fewer own turns than h: a turnless conversation, a member of the root
    lone = next(c for c in range(1, 100) if prefix_trie_head(c) >= 2)
    rows = [(lone, 0, "user", "x"), (None, 0, "user", "nobody"), (None, None, None, None)]
    assert nodes_of(prefix_trie.rebuilt_trie(spark.createDataFrame(rows, TURNS))) == trie_nodes({lone: []})
    # equal rows are turns of their own
    rows = [(0, 1, "user", "same")] * 9 + [(0, None, None, None)] * 2
    assert nodes_of(prefix_trie.rebuilt_trie(spark.createDataFrame(rows, TURNS))) == trie_nodes(
        {0: [("", "")] * 2 + [("user", "same")] * 9})
    # role and text are not run together
    rows = [(100, 0, "ab", "c"), (200, 0, "a", "bc"), (300, 0, "ab", "c")]
    assert nodes_of(prefix_trie.rebuilt_trie(spark.createDataFrame(rows, TURNS))) == trie_nodes(rebuilt(rows))


def prefix_trie_head(conv):
    import zlib

    return zlib.crc32(str(conv).encode()) % 6


def test_long_conversation_and_long_text(spark):
    rows = [(100, t, "user", str(t % 7)) for t in range(400)] + [(300, t, "user", str(t % 7) if t < 350 else "z") for t in range(380)]
    rows += [(500, 0, "user", "long " * 200_000)]
    got = prefix_trie.rebuilt_trie(spark.createDataFrame(rows, TURNS), width=3, span=4)
    assert nodes_of(got) == trie_nodes(rebuilt(rows))


def test_one_opening_for_all(spark):
    rows = [(c * 100, 0, "system", "same") for c in range(300)] + [(c * 100, 1, "user", f"q{c % 250}") for c in range(300)]
    got = prefix_trie.rebuilt_trie(spark.createDataFrame(rows, TURNS), page=16, heavy=10)
    assert nodes_of(got) == trie_nodes(rebuilt(rows))
