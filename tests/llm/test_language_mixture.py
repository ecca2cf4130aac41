"""Language identification by multilingual mixtures."""

import math
import random
import zlib

import numpy as np
import pytest
from conftest import SF_MID
from pyspark.sql import functions as F

from gridloom.llm import language_mixture as lm
from gridloom.sources.tables import table

DOCS = "doc_id long, text string, lang string"
SYLLABLES = {"aa": ["tho", "ing", "wer", "sha", "ble"], "bb": ["kei", "ung", "sch", "zu", "pf"], "cc": ["ção", "lho", "não", "qui", "és"]}


def speak(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def taught(spark):
    rng = random.Random(1)
    rows = [(i, speak(rng, lang, 60), lang) for i, lang in enumerate(sorted(SYLLABLES) * 40)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("n", F.lit("x")).repartition(4)
    return rows, docs, lm.learn(docs)


def test_learning_counts_every_row_that_is_not_held_out(spark, taught):
    rows, _, model = taught
    assert model.languages == sorted(SYLLABLES)
    for lang, held in zip(model.languages, model.counts):
        texts = [t for i, t, g in rows if g == lang and zlib.crc32(str(i).encode()) % 4 != 2]
        # one character entry per letter and word end
        letters = sum(len(w) + 1 for t in texts for w in t.split())
        assert held[lm.OFFSETS[4]:].sum() == letters == held[:lm.OFFSETS[1]].sum()
    odd = [(None, "unseen", "zz"), (1, None, "zz"), (1, "12 34 ½", "zz"), (1, "word", None),
           (next(i for i in range(99) if zlib.crc32(str(i).encode()) % 4 == 2), "held", "zz")]
    assert lm.learn(spark.createDataFrame(odd, DOCS)).languages == []


def test_word_likelihood_against_a_plain_model(taught):
    rows, _, model = taught
    # tables are hashed: with this few entries no two keys meet, so counts by text are the same
    for k, lang in enumerate(model.languages):
        text = [f"\2\2{w}\3" for i, t, g in rows if g == lang and zlib.crc32(str(i).encode()) % 4 != 2 for w in t.lower().split()]
        grams = {}
        for w in text:
            for j in range(2, len(w)):
                for g in ((3, w[j - 2:j + 1]), (2, w[j - 1:j + 1]), ("c2", w[j - 2:j]), ("c1", w[j - 1]), (1, w[j])):
                    grams[g] = grams.get(g, 0) + 1
        total = sum(n for g, n in grams.items() if g[0] == 1)
        for word in ("thoing", "schung", "çãoqui", "zzz"):
            want, w = 0.0, f"\2\2{word}\3"
            for j in range(2, len(w)):
                p = (grams.get((1, w[j]), 0) + 1) / (total + lm.TABLES[4])
                p = (grams.get((2, w[j - 1:j + 1]), 0) + lm.BACKOFF * p) / (grams.get(("c1", w[j - 1]), 0) + lm.BACKOFF)
                p = (grams.get((3, w[j - 2:j + 1]), 0) + lm.BACKOFF * p) / (grams.get(("c2", w[j - 2:j]), 0) + lm.BACKOFF)
                want += math.log(p)
            assert model.log_likelihoods([word])[0][0, k] == pytest.approx(want, rel=0.02)


def test_mixtures_against_a_plain_search():
    """Every language subset of every size, fitted by many plain steps."""
    from itertools import combinations

    rng = np.random.default_rng(3)
    for trial in range(12):
        k, n = 3, 40
        truth = [(1, 0, 0), (0.6, 0.4, 0), (0.4, 0.3, 0.3)][trial % 3]
        of = rng.choice(k, n, p=truth)
        logs = rng.normal(-12, 1, (n, k))
        logs[np.arange(n), of] += 8
        count = rng.integers(1, 4, n).astype(float)
        chosen, _ = lm.mixtures(logs, count, np.zeros(n, np.int64))

        def fit(members):
            like = np.exp(logs[:, members])
            share = np.full(len(members), 1 / len(members))
            for _ in range(300):
                share = ((like * share / (like @ share)[:, None]) * count[:, None]).sum(axis=0) / count.sum()
            return share, (count * np.log(like @ share)).sum() - 0.5 * math.log(count.sum()) * (len(members) - 1)

        best = max((list(m) for size in (1, 2, 3) for m in combinations(range(k), size)), key=lambda m: fit(m)[1])
        assert sorted(np.flatnonzero(chosen[0])) == best
        assert chosen[0, best] == pytest.approx(fit(best)[0], abs=1e-3)


def test_documents_do_not_touch_each_other():
    rng = np.random.default_rng(5)
    sizes = [3, 1, 20, 7]
    logs, count = rng.normal(-9, 3, (sum(sizes), 4)), rng.integers(1, 5, sum(sizes)).astype(float)
    doc = np.repeat(np.arange(4), sizes)
    together, posterior = lm.mixtures(logs, count, doc)
    for d in range(4):
        alone, own = lm.mixtures(logs[doc == d], count[doc == d], np.zeros(sizes[d], np.int64))
        assert together[d] == pytest.approx(alone[0]) and posterior[d] == pytest.approx(own[0])


def test_predictions_and_edge_cases(spark, taught):
    _, _, model = taught
    rng = random.Random(9)
    rows = [(i, speak(rng, lang, n), lang) for i, (lang, n) in enumerate([(g, n) for g in sorted(SYLLABLES) for n in (3, 30, 300)])]
    mixed = speak(rng, "aa", 70) + " " + speak(rng, "bb", 30)
    extra = [(100, mixed, "aa"), (101, None, "und"), (102, "", "und"), (103, "12 ½ ... _ 四" [:10], "und"), (104, " \t\n", "und"),
             (105, speak(rng, "bb", 60_000), "bb"), (106, "UNGSCH UNG", "bb"), (None, mixed, "aa"), (100, mixed, "aa")]
    docs = spark.createDataFrame(rows + extra, DOCS).withColumn("score", F.lit("mine")).withColumn("lang_pred", F.lit(1))
    found = lm.predict(docs, model).collect()
    assert len(found) == len(rows + extra)
    for r in found:
        assert r["lang_pred"] == r["lang"], r["text"][:50]
        assert 0 <= r["score"] <= 1 and (r["score"] == 0) == (r["lang"] == "und")
        if r["text"] == mixed:
            assert r["score"] == pytest.approx(0.7, abs=0.03)  # seven words of ten
    assert lm.predict(docs.limit(0), model).count() == 0
    nothing = lm.learn(docs.limit(0))
    assert {(r["lang_pred"], r["score"]) for r in lm.predict(docs, nothing).collect()} == {("und", 0.0)}


def test_other_number_characters_are_no_letters():
    assert lm.letter_runs("ab1Cd½e_f²") == ["ab", "cd", "e", "f"]
    assert lm.letter_runs("½ⅷ12") == [] and lm.letter_runs("四") == ["四"]


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(lm, "MAX_MODEL_BYTES", 4 * lm.SIZE * 2)
    docs = spark.createDataFrame([(i, "word", f"l{i % 5}") for i in range(40)], DOCS)
    with pytest.raises(ValueError, match="more than 2 languages"):
        lm.learn(docs)


def test_held_out_accuracy(spark):
    docs = table(spark, SF_MID, "documents")
    found = lm.predict(docs, lm.learn(docs)).filter(lm.held_out(F.col("doc_id"))).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.99 * len(found)
