"""Toxicity scores from subword-bag embeddings.

A word is the bag of its hashed character n-grams (with boundary marks) and
of the word itself; a text is the average of its subword vectors; a linear
softmax over that average gives the class.  Embeddings and softmax are
trained jointly in numpy, so an unseen misspelling shares the vectors of the
character n-grams it keeps.

Training uses at most ``max_rows`` labelled rows (the documented bound of the
sample, drawn by a hash of the id).  The map tasks count their words; one task
trains on those counts and hands back one number per embedding bucket, which
is all that scoring needs.  The average and the softmax are linear up to the
last step, so one pass needs only a scalar per subword, word and document:
forward ``logit(d) = mean over subwords of (E w)``, backward the same sums
transposed.

Scoring maps over all rows without a shuffle: each batch dictionary-encodes
its tokens, scores the distinct ones and sums per text.

Edge cases: a null or empty text has no subwords and is scored by the bias
alone, as is a text of punctuation only; ``reject`` keeps such rows, as there
is nothing in them to reject; an empty table gives no rows; equal texts have equal scores;
labels that are null are not used, and of several labels of one id the
largest counts; without labelled rows, or with one class only, the model is
the smoothed prior.  Texts of any length are scored whole.  Input columns
that clash with ``score`` are replaced.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.common import isolated, null_safe, release_memory, text_slices

BUCKETS = 1 << 18
DIM = 8
NGRAMS = (3, 4, 5)
MAX_ROWS = 12_000
STEPS = 100
SCALE = 60.0
CACHE_WORDS = 60_000
PART_WORDS, PART_TEXTS = 20_000, 500
BAG_BYTES = 4 << 20
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def subwords(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket ids of all words one after another, how many each word has)."""
    marked = [f"<{w}>" for w in words]
    sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = ends[owner] - np.arange(len(points))  # characters from here to the word's end
    found_ids, found_owner = [], []
    for n in NGRAMS:
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), n, dtype=np.uint64)
        for k in range(n):
            h = _mixed(h * _MIX + points[at + k])
        found_ids.append(h % np.uint64(buckets))
        found_owner.append(owner[at])
    if len(words):  # the word itself
        place = (np.arange(len(points)) - (ends - sizes)[owner]).astype(np.uint64)
        h = np.add.reduceat(_mixed(points * _MIX + place + np.uint64(1 << 40)), ends - sizes)
        found_ids.append(_mixed(h) % np.uint64(buckets))
        found_owner.append(np.arange(len(words)))
    ids, owners = np.concatenate(found_ids).astype(np.int32), np.concatenate(found_owner).astype(np.int32)
    return ids[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(words))


def normalise(token: str) -> str:
    return token.lower().strip(PUNCTUATION)


def encode_tokens(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct tokens, token index per token, text index per token)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten().dictionary_encode()
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    return flat.dictionary.to_pylist(), flat.indices.to_numpy(), owner


class Model(NamedTuple):
    embeddings: np.ndarray  # buckets x DIM
    softmax: np.ndarray     # DIM x 2
    bias: np.ndarray        # 2
    scale: float

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, e=self.embeddings, w=self.softmax, b=self.bias, s=self.scale)
        return out.getvalue()

    @staticmethod
    def from_bytes(raw: bytes) -> "Model":
        z = np.load(io.BytesIO(raw))
        return Model(z["e"], z["w"], z["b"], float(z["s"]))

    def subword_logits(self) -> np.ndarray:
        """Per bucket: what it adds to the log-odds of class 1, times n."""
        return (self.embeddings @ (self.softmax[:, 1] - self.softmax[:, 0])) * np.float32(self.scale)

    def weights(self) -> "Weights":
        return Weights(self.subword_logits(), float(self.bias[1] - self.bias[0]))

    def scorer(self) -> "Scorer":
        return Scorer(*self.weights())


class Weights(NamedTuple):
    """What scoring needs of a model: 4 bytes a bucket."""

    logits: np.ndarray
    bias: float


def word_bags(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Per text: its distinct words, and how often each occurs."""
    words, counts = [], []
    for at in range(0, len(texts), PART_TEXTS):
        part = texts.slice(at, PART_TEXTS)
        tokens, token, owner = encode_tokens(part)
        place: dict[str, int] = {}
        # punctuation alone is no word
        known = np.array([place.setdefault(w, len(place)) if w else -1 for w in map(normalise, tokens)], dtype=np.int64)
        real = known[token] >= 0
        pair, count = np.unique((owner[real] << 32) + known[token[real]], return_counts=True)
        ends = pa.array(np.searchsorted(pair >> 32, np.arange(len(part) + 1)), pa.int32())
        listed = pa.array(list(place), pa.string())
        words.append(pa.ListArray.from_arrays(ends, listed.take(pa.array(pair & 0xFFFFFFFF))))
        counts.append(pa.ListArray.from_arrays(ends, pa.array(count, pa.int32())))
    if not words:
        return pa.array([], pa.list_(pa.string())), pa.array([], pa.list_(pa.int32()))
    return pa.concat_arrays(words), pa.concat_arrays(counts)


def train(texts: pa.Array, labels: np.ndarray, steps: int = STEPS, **options) -> Model:
    """``train_bags`` of the words of ``texts``."""
    return train_bags(*word_bags(texts), labels, steps, **options)


def train_bags(words: pa.Array, counts: pa.Array, labels: np.ndarray, steps: int = STEPS, seed: int = 7,
               rate: float = 0.1, decay: float = 1e-6, balance: float = 0.4) -> Model:
    """Embeddings and softmax by full-batch Adam on log loss; ``balance`` is
    the power of the inverse class frequency that weighs a class."""
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.3, (DIM, 2)).astype(np.float32)
    labels = np.asarray(labels, dtype=np.int64)
    n_pos, n_all = int(labels.sum()), len(labels)
    prior = (n_pos + 1) / (n_all + 2)
    bias = np.log(np.array([1 - prior, prior], dtype=np.float32))
    if n_pos in (0, n_all):
        return Model(emb * 0, soft, bias, SCALE)
    coded = words.flatten().dictionary_encode()
    if not len(coded):
        return Model(emb * 0, soft, bias, SCALE)
    listed, word = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    doc = np.repeat(np.arange(len(words), dtype=np.int32), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    count = counts.flatten().to_numpy().astype(np.float32)
    parts = [subwords(listed[at:at + PART_WORDS]) for at in range(0, len(listed), PART_WORDS)]
    n_words = sum(len(n) for _, n in parts)
    n_subs = np.concatenate([n for _, n in parts])
    total = np.maximum(np.bincount(doc, weights=count * n_subs[word], minlength=n_all), 1)
    weight = (count / total[doc]).astype(np.float32)
    share = np.where(labels == 1, (n_all / n_pos) ** balance, (n_all / (n_all - n_pos)) ** balance)
    share /= share.sum()
    params = {"e": emb, "w": soft, "b": np.zeros(2, np.float32)}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    for step in range(1, steps + 1):
        diff = params["w"][:, 1] - params["w"][:, 0]
        per_bucket = (params["e"] @ diff) * SCALE
        per_word = np.concatenate([np.add.reduceat(per_bucket[ids], np.cumsum(n) - n) for ids, n in parts])
        logit = np.bincount(doc, weights=weight * per_word[word], minlength=n_all)
        logit += params["b"][1] - params["b"][0]
        delta = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - labels) * share
        back, at, by_bucket = np.bincount(word, weights=weight * delta[doc], minlength=n_words), 0, np.zeros(BUCKETS)
        for ids, n in parts:
            by_bucket += np.bincount(ids, weights=np.repeat(back[at:at + len(n)], n), minlength=BUCKETS)
            at += len(n)
        by_bucket = by_bucket.astype(np.float32) * SCALE
        toward = by_bucket @ params["e"]
        grads = {"e": by_bucket[:, None] * diff[None, :] + decay * params["e"],
                 "w": np.stack([-toward, toward], axis=1) + decay * params["w"],
                 "b": np.array([-delta.sum(), delta.sum()], np.float32)}
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            params[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return Model(params["e"], params["w"], params["b"], SCALE)


class Scorer:
    """Scores batches of texts; keeps the sums of words seen, within bounds."""

    def __init__(self, logits: np.ndarray, bias: float):
        self.logits, self.bias = logits, bias
        self.seen: dict[str, tuple[float, int]] = {}

    def _learn(self, tokens: list[str]) -> None:
        if len(self.seen) > CACHE_WORDS:
            self.seen.clear()
        new = [t for t in tokens if t not in self.seen]
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            words = [normalise(t) for t in part]
            ids, n = subwords(words)
            owner = np.repeat(np.arange(len(words)), n)
            sums = np.bincount(owner, weights=self.logits[ids], minlength=len(words))
            for t, w, s, k in zip(part, words, sums.tolist(), n.tolist()):
                self.seen[t] = (s, k) if w else (0.0, 0)

    def score(self, texts: pa.Array) -> np.ndarray:
        tokens, token, owner = encode_tokens(texts)
        self._learn(tokens)
        table = np.array([self.seen[t] for t in tokens], dtype=np.float64).reshape(-1, 2)
        sums = np.bincount(owner, weights=table[token, 0], minlength=len(texts))
        counts = np.bincount(owner, weights=table[token, 1], minlength=len(texts))
        logit = sums / np.maximum(counts, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def held_out(id_col: Column) -> Column:
    """True for ids kept out of training: crc32(id as text) mod 5 is 0."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, steps: int = STEPS) -> Weights:
    """Train on at most ``max_rows`` labelled rows that are not held out.
    Only the ids of the sample (bounded by ``max_rows``) are broadcast."""
    usable = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", BAG_BYTES):
            bags = word_bags(part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *bags], ["doc_id", "toxic", "words", "counts"])
        release_memory()

    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", F.col("toxic").cast("int"))
    bags = rows.mapInArrow(count_words, "doc_id long, toxic int, words array<string>, counts array<int>")
    # one row an id, whatever repeats: the bag that comes first in order
    bags = (bags.groupBy("doc_id", "toxic").agg(F.min(F.struct("words", "counts")).alias("bag"))
            .select(F.lit(0).alias("model"), F.xxhash64("doc_id").alias("at"), "doc_id", "toxic", "bag.words", "bag.counts"))

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("at", "ascending"), ("doc_id", "ascending")])
        found = train_bags(table["words"].combine_chunks(), table["counts"].combine_chunks(), table["toxic"].to_numpy(), steps).weights()
        release_memory()
        return pa.table({"logits": pa.array([found.logits.astype(np.float32).tobytes()], pa.binary()), "bias": pa.array([found.bias])})

    found = bags.groupBy("model").applyInArrow(learn, "logits binary, bias double").collect()
    if not found:
        return train(pa.array([], pa.string()), np.zeros(0)).weights()
    return Weights(np.frombuffer(found[0]["logits"], np.float32), found[0]["bias"])


#: A character that is in some word: no ASCII blank, no punctuation mark.
_WORDLY = r"[^\x09-\x0D\x20!-/:-@\[-`{-~]"


def reject(docs: DataFrame, weights: Weights, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` (same columns) without the rows that score ``threshold`` or
    more; rows without a word stay."""
    def keep(rows: DataFrame) -> DataFrame:
        wordless = ~null_safe(F.col(text_col)).rlike(_WORDLY)
        return score(rows, weights, text_col).filter((F.col("score") < threshold) | wordless)

    return isolated(docs, (text_col,), keep)


def score(docs: DataFrame, weights: Weights, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``score``, the probability of class 1."""
    # fixed size: one number per bucket
    shared = docs.sparkSession.sparkContext.broadcast(tuple(weights))
    docs = docs.drop("score")
    at, schema = docs.columns.index(text_col), T.StructType(docs.schema.fields + [T.StructField("score", T.DoubleType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                scores = pa.array(scorer.score(part.column(at)), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, scores], [*part.schema.names, "score"])
        del scorer
        release_memory()

    return docs.mapInArrow(add, schema)
