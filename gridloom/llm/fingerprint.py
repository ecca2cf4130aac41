"""Improbable-feature digests of documents.

A feature is a window of ``FEATURE`` bytes of the UTF-8 text.  Its Shannon
entropy, quantised to 0..1000, is a class; ``fit_ranks`` counts the classes
over all documents and ranks them by rarity (rarest first; classes below
``WEAK`` come last).  In each run of ``POPULARITY_WINDOW`` features the one
of least rank (leftmost on ties) gets a vote, and features with enough votes
are selected.  Their hashes go into a chain of Bloom filters, a new one after
every ``FILTER_FEATURES`` distinct features.

Two digests are compared by the bits that their filters share, normalised
between what chance explains and the most that is possible: each filter of
the digest with fewer filters takes its best partner, weighted by its bits.

The entropy needs no sort: with ``a`` the repeats of a byte in the 63 bytes
after it and ``c`` those in the 63 before it, sliding the window by one byte
changes the sum of count * log(count) by a table lookup of each.

Edge cases: a null text is empty; an empty text has no filter, and is like
another empty one (1) and unlike any other (0); texts of fewer than
``FEATURE`` bytes are padded with zero bytes to one feature; texts of any
length are read whole; repeated ids are ordered by a hash of the text, then
the text, rows without an id come last; the next document of a single one is
itself; an empty table gives no rows.  Only the id and the text are read, so
other columns may clash with anything.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import mix64, null_safe, shuffle_partitions, text_slices

FEATURE = 64
POPULARITY_WINDOW = 64
MIN_VOTES = 16
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
CLASSES = 1001
WEAK = 100
CUTOFF = 0.1
SLICE_BYTES = 1 << 19

_SCALE = 1 << 16
_COUNT_LOG = np.array([0] + [round(c * np.log2(c) * _SCALE) for c in range(1, FEATURE + 2)], dtype=np.int64)


def padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(all texts in one buffer, offset of each): short ones are padded."""
    parts = [t.ljust(FEATURE, b"\0") if t else t for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
    return np.frombuffer(b"".join(parts), dtype=np.uint8), offsets


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """Entropy class of the window at each byte but the last 63."""
    n = len(data)
    if n < FEATURE:
        return np.zeros(0, dtype=np.int64)
    after, before = np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.uint8)
    for k in range(1, FEATURE):
        same = (data[:-k] == data[k:]).view(np.uint8)
        after[:-k] += same
        before[k:] += same
    out_, in_ = after[:n - FEATURE], before[FEATURE:]
    change = (_COUNT_LOG[:-1] - _COUNT_LOG[1:])[out_] + (_COUNT_LOG[1:] - _COUNT_LOG[:-1])[in_]
    first = _COUNT_LOG[np.bincount(data[:FEATURE])].sum()
    sums = np.concatenate([[first], first + np.cumsum(change)])
    bits = np.log2(FEATURE)
    return np.clip(((bits * FEATURE * _SCALE - sums) * ((CLASSES - 1) / (bits * FEATURE * _SCALE))).astype(np.int64),
                   0, CLASSES - 1)


def _valid(offsets: np.ndarray, size: int) -> np.ndarray:
    """Feature starts that lie within one text."""
    edge = np.zeros(size + 1, dtype=np.int8)
    lo, hi = offsets[:-1], offsets[1:] - FEATURE + 1
    some = offsets[1:] > offsets[:-1]
    np.add.at(edge, lo[some], 1)
    np.add.at(edge, hi[some], -1)
    return np.cumsum(edge[:-1], dtype=np.int8).astype(bool)


def fit_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Rank of each entropy class by its rarity over all documents; at most
    1001 counts a task, and 1001 in all, leave the executors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES, dtype=np.int64)
        for batch in text_slices(batches, "text", SLICE_BYTES):
            data, offsets = padded([(t.as_py() or "").encode("utf-8", "surrogatepass") for t in batch.column("text")])
            classes = entropy_classes(data)
            total += np.bincount(classes[_valid(offsets, len(data))[:len(classes)]], minlength=CLASSES)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"entropy": pa.array(held, pa.int32()), "n": pa.array(total[held], pa.int64())})

    rows = (docs.select(F.col(text_col).alias("text")).mapInArrow(count, "entropy int, n long")
            .groupBy("entropy").agg(F.sum("n").alias("n")).collect())
    total = np.zeros(CLASSES, dtype=np.int64)
    for r in rows:
        total[r["entropy"]] = r["n"]
    order = np.lexsort((np.arange(CLASSES), total, np.arange(CLASSES) < WEAK))
    ranks = np.empty(CLASSES, dtype=np.int64)
    ranks[order] = np.arange(CLASSES)
    return ranks


def digests(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """The Bloom filters of each text, one row of bytes per filter."""
    data, offsets = padded(texts)
    none = np.zeros((0, FILTER_BITS // 8), dtype=np.uint8)
    if not len(data):
        return [none] * len(texts)
    n = len(data)
    valid = _valid(offsets, n)
    classes = entropy_classes(data)
    kind, shift = (np.int32, 21) if n < 1 << 21 else (np.int64, 40)
    last = np.iinfo(kind).max
    key = np.full(n + POPULARITY_WINDOW - 1, last, dtype=kind)
    key[:len(classes)] = (ranks[classes].astype(kind) << kind(shift)) | np.arange(len(classes), dtype=kind)
    key[:n][~valid] = last
    least, step = key, 1
    while step < POPULARITY_WINDOW:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    sizes = np.diff(offsets)
    features = np.maximum(sizes - FEATURE + 1, 0)
    windows = np.where(features > 0, np.maximum(features - POPULARITY_WINDOW + 1, 1), 0)
    place = np.arange(n) - np.repeat(offsets[:-1], sizes)
    starts = least[:n][place < np.repeat(windows, sizes)]
    votes = np.bincount(starts & kind((1 << shift) - 1), minlength=n)
    needed = np.clip(windows // 4, 1, MIN_VOTES)
    chosen = np.flatnonzero(votes >= np.repeat(needed, sizes))
    views = np.lib.stride_tricks.sliding_window_view(data, FEATURE)[chosen].view(np.uint64)
    h = np.full(len(chosen), FEATURE, dtype=np.uint64)
    for j in range(views.shape[1]):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + views[:, j])
    owner = np.searchsorted(offsets, chosen, "right") - 1
    # a feature counts once in a text
    by = np.lexsort((chosen, h, owner))
    new = np.ones(len(by), dtype=bool)
    new[1:] = (h[by][1:] != h[by][:-1]) | (owner[by][1:] != owner[by][:-1])
    keep = np.sort(by[new])
    h, owner = h[keep], owner[keep]
    per_text = np.bincount(owner, minlength=len(texts))
    filters = -(-per_text // FILTER_FEATURES)
    base = np.concatenate([[0], np.cumsum(filters)])
    ordinal = np.arange(len(h)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    where = (base[owner] + ordinal // FILTER_FEATURES) * FILTER_BITS
    bits = np.zeros(base[-1] * FILTER_BITS, dtype=bool)
    for j in range(HASHES):
        bits[where + (h >> np.uint64(11 * j) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits).reshape(-1, FILTER_BITS // 8)
    return [packed[base[i]:base[i + 1]] for i in range(len(texts))]


def to_text(filters: np.ndarray) -> str:
    return f"{len(filters)}:" + base64.b64encode(filters.tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text.partition(":")[2]), dtype=np.uint8).reshape(-1, FILTER_BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Normalised bit overlap of two digests, 0 to 1, symmetric."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    n_a, n_b = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (a, b))
    if (len(b), n_b.sum(), b.tobytes()) < (len(a), n_a.sum(), a.tobytes()):
        a, b, n_a, n_b = b, a, n_b, n_a
    total = 0.0
    for row, n in zip(a, n_a):
        shared = np.bitwise_count(row & b).sum(axis=1, dtype=np.int64)
        most = np.minimum(n, n_b)
        chance = n * n_b / FILTER_BITS
        cut = chance + CUTOFF * (most - chance)
        total += n * float(np.clip((shared - cut) / np.maximum(most - cut, 1e-9), 0, 1).max())
    return total / float(n_a.sum())


def fingerprint(docs: DataFrame, ranks: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``fingerprint``: the digest as text."""

    @F.pandas_udf("string")
    def digest(texts):
        import pandas as pd

        out, held, size = [], [], 0
        for t in texts:
            held.append((t or "").encode("utf-8", "surrogatepass"))
            size += len(held[-1])
            if size >= SLICE_BYTES:
                out += map(to_text, digests(held, ranks))
                held, size = [], 0
        return pd.Series(out + [to_text(d) for d in digests(held, ranks)], dtype=object)

    return docs.withColumn("fingerprint", digest(F.col(text_col)))


def edited_text(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many (or
    all) of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_CHAIN = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _bucket(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the falling ``bounds`` are at least the id, by bisection;
    rows without an id come last."""
    if not bounds:
        return F.lit(0)
    table, n, steps = F.array(*[F.lit(b) for b in bounds]), len(bounds), []
    while sum(steps) < n:
        steps.append(1 << len(steps))
    found = F.aggregate(F.array(*[F.lit(s) for s in reversed(steps)]), F.lit(0), lambda pos, s: F.when(
        (pos + s <= n) & (F.element_at(table, F.least(pos + s, F.lit(n))) >= doc_id), pos + s).otherwise(pos))
    return F.when(doc_id.isNull(), n).otherwise(found)


def edit_chain(docs: DataFrame, ranks: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near the
    edited text and the next document (falling id) are.

    One shuffle of the texts: ids are cut into ranges by approximate
    quantiles (one number per shuffle partition), each range is sorted in its
    partition, and the row that opens a range is also sent to the range
    before it, as the next of that range's last row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), null_safe(F.col(text_col)).alias("text"))
    parts = shuffle_partitions(docs)
    cuts = [i / parts for i in range(1, parts)] or [0.5]
    top, bounds = rows.agg(F.max("doc_id"), F.percentile_approx("doc_id", cuts, 10_000)).first()
    bounds = sorted({int(b) for b in bounds or []}, reverse=True)
    bucket, n = _bucket(F.col("doc_id"), bounds), len(bounds)
    opens = F.lit(False) if not bounds else (F.col("doc_id") == F.element_at(
        F.array(*[F.lit(b) for b in bounds]), F.greatest(F.col("bucket"), F.lit(1)))) & (F.col("bucket") > 0)
    places = F.array_compact(F.array(
        F.struct(F.col("bucket").alias("at"), F.lit(False).alias("ahead")),
        F.when(opens, F.struct((F.col("bucket") - 1).alias("at"), F.lit(True).alias("ahead"))),
        F.when(F.col("doc_id").eqNullSafe(F.lit(top)), F.struct(F.lit(n).alias("at"), F.lit(True).alias("ahead")))))
    placed = (rows.withColumn("bucket", bucket).withColumn("place", F.explode(places))
              .select(F.col("place.at").alias("bucket"), F.col("place.ahead").alias("ahead"), "doc_id", "text")
              .repartitionById(n + 1, F.col("bucket"))
              .sortWithinPartitions("bucket", "ahead", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text"))
    names = [c.split()[0] for c in _CHAIN.split(", ")]

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # (bucket, id, text, digest) of the row that waits for its next
        for batch in text_slices(batches, "text", SLICE_BYTES):
            texts = batch.column("text").to_pylist()
            found = digests([t.encode("utf-8", "surrogatepass") for t in texts], ranks)
            pairs = []
            for row in zip(batch.column("bucket").to_pylist(), batch.column("doc_id").to_pylist(), texts, found,
                           batch.column("ahead").to_pylist()):
                if before is not None and before[0] == row[0]:
                    pairs.append((before, row))
                before = None if row[4] else row
            if not pairs:
                continue
            edited = [edited_text(a[2], b[2]).encode("utf-8", "surrogatepass") for a, b in pairs]
            changed = digests(edited, ranks)
            yield pa.RecordBatch.from_arrays([
                pa.array([a[1] for a, _ in pairs], pa.int64()),
                pa.array([len(a[2]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
                pa.array([to_text(a[3]) for a, _ in pairs]),
                pa.array([to_text(c) for c in changed]),
                pa.array([likeness(a[3], c) for (a, _), c in zip(pairs, changed)], pa.float64()),
                pa.array([likeness(a[3], b[3]) for a, b in pairs], pa.float64())], names)

    return placed.select("bucket", "ahead", "doc_id", "text").mapInArrow(chain, _CHAIN)
