"""Language identification by multilingual mixture inference.

Per language a character model gives the likelihood of a word: trigrams that
back off to pairs and single characters, between word marks, counted in hashed
tables over all labelled texts.  A document is a mixture: each of its words
comes from one language, chosen by the document's proportions.
Expectation-maximisation estimates the proportions; the language set grows, in
the order of the proportions under all languages, as long as the likelihood
less half a log of the word count per further language rises.  The prediction
is the language with the largest proportion in that set.

Learning is one pass in which each task sums counts per language and table
entry, a partial aggregate and one row of fixed size per language.  Those rows
are broadcast; more than ``MAX_MODEL_BYTES`` of them (about 600 languages) are
refused.  Prediction maps over all rows without a shuffle.

Edge cases: a null text, or one without a letter, is ``und`` with score 0, and
so is every text when nothing was learned; rows without an id, language or
letters teach nothing; equal texts get equal answers; ties go to the smaller
language name; very short texts are scored like others.  Texts of any length
are read whole; a task holds the distinct words of one text, or of
``SLICE_BYTES`` of shorter ones, times the languages.  Repeated rows count and
are answered each.  Input columns that clash with ``lang_pred`` or ``score``
are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.common import mix64, release_memory, text_slices
from gridloom.llm.toxicity import encode_tokens

#: Entries of the tables: trigrams, pairs, contexts of trigrams, contexts of pairs, characters.
TABLES = (1 << 16, 1 << 14, 1 << 14, 1 << 12, 1 << 12)
OFFSETS = np.concatenate([[0], np.cumsum(TABLES)])
SIZE = int(OFFSETS[-1])
BACKOFF = 4.0
ROUNDS = 15
MAX_MODEL_BYTES = 256 << 20
SLICE_BYTES = 2 << 20
HELD_LANGUAGES = 64
CACHE_TOKENS = 50_000
PART_TOKENS = 10_000
UND = "und"

_RUN = re.compile(r"[^\W\d_]+")
_START, _END = 2, 3


def held_out(id_col: Column) -> Column:
    """True for ids kept out of learning: crc32(id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letter_runs(token: str) -> list[str]:
    """Maximal runs of letters, lower-cased."""
    runs = _RUN.findall(token.lower())
    if all(r.isalpha() for r in runs):
        return runs
    # other number characters (fractions, numerals) are no letters
    return "".join(c if c.isalpha() else " " for r in runs for c in (*r, " ")).split()


def entries(runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(entry of each table, one row a table, for every character and end of
    the runs; the run that it belongs to)."""
    marked = [f"{chr(_START) * 2}{r}{chr(_END)}" for r in runs]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(runs)), sizes)
    inner = np.arange(len(points)) - (np.cumsum(sizes) - sizes)[owner] >= 2  # not the start marks
    c, owner = np.flatnonzero(inner), owner[inner]
    one, two, three = points[c], points[c - 1], points[c - 2]
    shift = np.uint64(21)
    keys = ((three << (shift + shift)) | (two << shift) | one, (two << shift) | one, (three << shift) | two, two, one)
    out = np.empty((len(TABLES), len(c)), np.int32)
    for row, (key, size, at) in enumerate(zip(keys, TABLES, OFFSETS)):
        out[row] = (mix64(key + np.uint64(row + 1)) % np.uint64(size)).astype(np.int64) + at
    return out, owner


def token_entries(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``entries`` of all letter runs, with the token that each belongs to."""
    runs, of = [], []
    for i, token in enumerate(tokens):
        for run in letter_runs(token):
            runs.append(run)
            of.append(i)
    if not runs:
        return np.zeros((len(TABLES), 0), np.int32), np.zeros(0, np.int64)
    ids, owner = entries(runs)
    return ids, np.asarray(of)[owner]


class Model(NamedTuple):
    languages: list[str]
    counts: np.ndarray  # languages x SIZE

    def log_likelihoods(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens x languages; whether the token has a letter)."""
        ids, owner = token_entries(tokens)
        total = self.counts[:, OFFSETS[4]:].sum(axis=1, dtype=np.float64)
        out = np.zeros((len(tokens), len(self.languages)))
        for k, held in enumerate(self.counts):
            three, two, ctx2, ctx1, one = (held[i].astype(np.float64) for i in ids)
            p = (one + 1) / (total[k] + TABLES[4])
            p = (two + BACKOFF * p) / (ctx1 + BACKOFF)
            # hashed contexts may meet; never less than what they led to
            p = (three + BACKOFF * p) / (np.maximum(ctx2, three) + BACKOFF)
            out[:, k] = np.bincount(owner, weights=np.log(p), minlength=len(tokens))
        return out, np.bincount(owner, minlength=len(tokens)) > 0


def count_entries(batch: pa.RecordBatch, sums: dict[str, np.ndarray]) -> None:
    """Add the table entries of (lang, text) rows to ``sums`` per language."""
    tokens, token, owner = encode_tokens(batch.column(1))
    langs = batch.column(0).dictionary_encode()
    lang = langs.indices.to_numpy()[owner].astype(np.int64)
    pair, n = np.unique(lang * max(len(tokens), 1) + token, return_counts=True)
    for at in range(0, len(tokens), PART_TOKENS):
        part = tokens[at:at + PART_TOKENS]
        ids, of = token_entries(part)
        for k, name in enumerate(langs.dictionary.to_pylist()):
            here = (pair >= k * len(tokens) + at) & (pair < k * len(tokens) + at + len(part))
            weight = np.zeros(len(part))
            weight[pair[here] - k * len(tokens) - at] = n[here]
            seen = weight[of]
            if seen.any():
                held = sums.setdefault(name, np.zeros(SIZE, np.int64))
                for row in ids:
                    held += np.bincount(row, weights=seen, minlength=SIZE).astype(np.int64)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """The character models of all languages, from all rows that are not held
    out and name a language."""
    rows = docs.filter(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
                       & ~held_out(F.col(id_col))).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def given() -> Iterator[pa.RecordBatch]:
            for name, held in sums.items():
                at = np.flatnonzero(held)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(held[at])],
                                                 ["lang", "entry", "n"])
            sums.clear()

        for part in text_slices(batches, "text", SLICE_BYTES):
            count_entries(part, sums)
            if len(sums) > HELD_LANGUAGES:
                yield from given()
        yield from given()
        release_memory()

    def pack(table: pa.Table) -> pa.Table:
        held = np.zeros(SIZE, np.float32)
        held[table["entry"].to_numpy()] = table["n"].to_numpy()
        return pa.table({"lang": table["lang"].slice(0, 1), "counts": pa.array([held.tobytes()], pa.binary())})

    entries_of = rows.mapInArrow(count, "lang string, entry int, n long").groupBy("lang", "entry").agg(F.sum("n").alias("n"))
    most = MAX_MODEL_BYTES // (4 * SIZE)
    packed = entries_of.groupBy("lang").applyInArrow(pack, "lang string, counts binary").limit(most + 1).collect()
    if len(packed) > most:
        raise ValueError(f"more than {most} languages: their models exceed {MAX_MODEL_BYTES} bytes")
    held = sorted((r["lang"], np.frombuffer(r["counts"], np.float32)) for r in packed)
    return Model([name for name, _ in held], np.stack([c for _, c in held]) if held else np.zeros((0, SIZE), np.float32))


def _fit(likely: np.ndarray, count: np.ndarray, doc: np.ndarray, first: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation of all documents at once: (proportions per
    document, log-likelihood).  ``likely`` is words x languages; ``first`` is
    the first word of each document, ``start`` the proportions to begin with."""
    share = start
    total = np.add.reduceat(count, first)
    for _ in range(ROUNDS):
        joint = likely * share[doc]
        share = np.add.reduceat(joint * (count / joint.sum(axis=1))[:, None], first, axis=0) / total[:, None]
    return share, np.add.reduceat(count * np.log((likely * share[doc]).sum(axis=1)), first)


def mixtures(logs: np.ndarray, count: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document (numbered from 0 without gaps, ``doc`` ascending): the
    proportions of its selected language set, and the posterior of its best
    single language.  ``logs`` is words x languages, ``count`` how often each
    word occurs."""
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    n, k = len(first), logs.shape[1]
    alone = np.add.reduceat(logs * count[:, None], first, axis=0)
    best = alone.argmax(axis=1)
    posterior = 1 / np.exp(alone - alone.max(axis=1, keepdims=True)).sum(axis=1)
    chosen = np.zeros((n, k))
    chosen[np.arange(n), best] = 1.0
    if k == 1:
        return chosen, posterior
    top = logs.max(axis=1, keepdims=True)
    likely = np.maximum(np.exp(logs - top), 1e-30)
    peak = np.add.reduceat(count * top[:, 0], first)
    value = alone[np.arange(n), best] - peak
    cost = 0.5 * np.log(np.maximum(np.add.reduceat(count, first), 1))
    live = np.arange(n)
    share, bound = _fit(likely, count, doc, first, np.full((n, k), 1 / k))
    order = np.argsort(-share, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    # no set of two or more can gain more than what all languages reach together
    live = live[bound[live] + 1e-9 - cost[live] > value[live]]
    for size in range(2, k + 1):
        if not len(live):
            break
        place = np.full(n, -1)
        place[live] = np.arange(len(live))
        words = place[doc] >= 0
        part = place[doc[words]]
        start = np.where(rank[live] < size, np.maximum(share[live], 1e-6), 0)
        start /= start.sum(axis=1, keepdims=True)
        fitted, reached = _fit(likely[words], count[words], part, np.flatnonzero(np.diff(part, prepend=-1)), start)
        gained = reached - (size - 1) * cost[live]
        # the first pair is weighed against the best single language, each larger set against the one before
        better = gained > value[live]
        chosen[live[better]], value[live[better]] = fitted[better], gained[better]
        live = live[better]
    return chosen, posterior


class Predictor:
    """Predicts batches of texts; keeps the likelihoods of words seen, within bounds."""

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        self.logs = np.zeros((0, len(model.languages)))
        self.known = np.zeros(0, bool)

    def _places(self, tokens: list[str]) -> np.ndarray:
        if len(self.place) > CACHE_TOKENS:
            self.__init__(self.model)
        new = [t for t in tokens if t not in self.place]
        logs, known = [self.logs], [self.known]
        for at in range(0, len(new), PART_TOKENS):
            part = new[at:at + PART_TOKENS]
            found, letters = self.model.log_likelihoods(part)
            for t in part:
                self.place[t] = len(self.place)
            logs.append(found)
            known.append(letters)
        self.logs, self.known = np.concatenate(logs), np.concatenate(known)
        return np.fromiter((self.place[t] for t in tokens), np.int64, len(tokens))

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        names, scores = [UND] * len(texts), np.zeros(len(texts))
        if not self.model.languages:
            return names, scores
        tokens, token, owner = encode_tokens(texts)
        place = self._places(tokens)
        spelt = self.known[place][token] if len(tokens) else np.zeros(0, bool)
        pair, count = np.unique(owner[spelt].astype(np.int64) * max(len(tokens), 1) + token[spelt], return_counts=True)
        if not len(pair):
            return names, scores
        row = pair // len(tokens)
        rows, doc = np.unique(row, return_inverse=True)
        share, posterior = mixtures(self.logs[place[pair % len(tokens)]], count.astype(np.float64), doc)
        top = share.argmax(axis=1)
        amount = share[np.arange(len(rows)), top]
        scores[rows] = np.clip(np.where(amount == 1.0, posterior, amount), 0, 1)
        for at, k in zip(rows.tolist(), top.tolist()):
            names[at] = self.model.languages[k]
        return names, scores


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``: the share of that language,
    or its posterior probability where it is the only one selected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_MODEL_BYTES
    docs = docs.drop("lang_pred", "score")
    at, names = docs.columns.index(text_col), docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(shared.value)
        for part in text_slices(batches, text_col, SLICE_BYTES):
            found, scores = predictor.predict(pc.fill_null(part.column(at).cast(pa.large_string()), ""))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                                             [*names, "lang_pred", "score"])
        del predictor
        release_memory()

    return docs.mapInArrow(add, schema)
