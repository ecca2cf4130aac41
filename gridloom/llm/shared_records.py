"""Which records of all texts share a key, by one packed shuffle.

A record is a fixed-size struct whose field ``h`` is a 64-bit key.  Tasks ship
the records of their texts packed, fragment by fragment of the key space; a
key that several records of a batch hold is known to be shared at once: its
records bypass the fragments, which only get a mark.  So a key held by a third
of all texts reaches its fragment once per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHIPPED = ("key int, hi array<long>, lo array<long>, copies array<int>, sizes array<int>, "
           "counts array<int>, records binary, marks binary, extras array<binary>")
SEGMENT = "hi long, lo long, copies int, size int, held binary, extra binary"

#: records of a text that come back -> (what is kept of them, its texts)
Shrink = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _repeats(h: np.ndarray) -> np.ndarray:
    """True where a key occurs more than once."""
    order, same = np.argsort(h, kind="stable"), np.zeros(len(h), dtype=bool)
    if len(h):
        equal = h[order][1:] == h[order][:-1]
        same[order[1:]] |= equal
        same[order[:-1]] |= equal
    return same


def _fragment_of(h: np.ndarray, fragments: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int32)


def pack(fragments: int, hi: np.ndarray, lo: np.ndarray, copies: np.ndarray, sizes: np.ndarray,
         records: np.ndarray, owner: np.ndarray, extras: list[bytes] | None = None,
         shrink: Shrink | None = None) -> pa.RecordBatch:
    """One batch of texts (128-bit keys hi, lo) with their records, in the
    order of ``owner``, the text of each record.  ``extras`` go along with the
    texts; ``shrink`` says what is kept of shared records."""
    h = np.ascontiguousarray(records["h"])
    same = _repeats(h)
    marks = np.unique(h[same])
    mark_at = np.searchsorted(_fragment_of(marks, fragments), np.arange(fragments + 1))
    alone, alone_owner = records[~same], owner[~same]
    part = _fragment_of(np.ascontiguousarray(alone["h"]), fragments)
    by = np.argsort(part, kind="stable")  # texts stay in order
    alone, alone_owner, part = alone[by], alone_owner[by], part[by]
    at = np.searchsorted(part, np.arange(fragments + 1))
    rows: list[tuple] = []
    for f in range(fragments):
        held, part_marks = slice(at[f], at[f + 1]), marks[mark_at[f]:mark_at[f + 1]]
        if held.start < held.stop or len(part_marks):
            texts, counts = np.unique(alone_owner[held], return_counts=True)
            rows.append((f, hi[texts], lo[texts], None, None, counts, alone[held].tobytes(), part_marks.tobytes(), None))
    if len(lo):  # every text, with the records known to be shared
        known, known_owner = records[same], owner[same]
        if shrink:
            known, known_owner = shrink(known, known_owner)
        rows.append((int(lo[0] % fragments), hi, lo, copies, sizes,
                     np.bincount(known_owner, minlength=len(lo)), known.tobytes(), b"", extras))
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    kinds = [pa.int32(), longs, longs, ints, ints, ints, pa.binary(), pa.binary(), pa.list_(pa.binary())]
    names = [c.split()[0] for c in SHIPPED.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds], names)


def _segments(dtype: np.dtype, kept_dtype: np.dtype, shrink: Shrink | None):
    def emit(hi, lo, copies, sizes, counts, records: np.ndarray, extras=None) -> pa.RecordBatch:
        offsets = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]) * kept_dtype.itemsize
        held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [
            None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(records.tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), copies, sizes,
                                           held.cast(pa.binary()),
                                           pa.array(extras, pa.binary()) if extras else pa.nulls(len(counts), pa.binary())], [c.split()[0] for c in SEGMENT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["sizes"] is not None:
                    yield emit(row["hi"], row["lo"], pa.array(row["copies"], pa.int32()),
                               pa.array(row["sizes"], pa.int32()), row["counts"],
                               np.frombuffer(row["records"], dtype=kept_dtype), row["extras"])
                else:
                    records = np.frombuffer(row["records"], dtype=dtype)
                    parts.append((np.array(row["hi"], dtype=np.int64), np.array(row["lo"], dtype=np.int64),
                                  np.array(row["counts"], dtype=np.int64), records,
                                  np.frombuffer(row["marks"], dtype=np.uint64)))
        if not parts:
            return
        h = np.concatenate([p[3]["h"] for p in parts])
        marks = np.unique(np.concatenate([p[4] for p in parts]))
        same = _repeats(h)
        if len(marks):
            same |= marks[np.minimum(np.searchsorted(marks, h), len(marks) - 1)] == h
        lo_at = 0
        for hi, lo, counts, records, _ in parts:
            kept = same[lo_at:lo_at + len(records)]
            lo_at += len(records)
            found, owner = records[kept], np.repeat(np.arange(len(counts)), counts)[kept]
            if shrink:
                found, owner = shrink(found, owner)
            left = np.bincount(owner, minlength=len(counts))
            some = np.flatnonzero(left)
            if len(some):
                none = pa.nulls(len(some), pa.int32())
                yield emit(hi[some], lo[some], none, none, left[some], found)

    return run


def shared_records(shipped: DataFrame, fragments: int, dtype: np.dtype, kept_dtype: np.dtype | None = None,
                   shrink: Shrink | None = None) -> DataFrame:
    """Rows of ``pack`` -> (hi, lo, copies, size, held, extra): one row per
    text with its copies, size and extra, and rows with those of its records
    whose key others share, as bytes (of ``kept_dtype`` after ``shrink``)."""
    return (shipped.repartitionById(fragments, F.col("key"))
            .mapInArrow(_segments(dtype, kept_dtype or dtype, shrink), SEGMENT))
