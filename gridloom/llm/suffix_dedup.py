"""Exact substring removal: every byte covered by a string of ``LENGTH`` bytes
that also starts elsewhere goes, matches never cross documents.

The suffixes are sorted by the distributed difference-cover algorithm
(``suffix_sort``), on phrases rather than on single bytes:

1. A position is a boundary when the hash of its next ``Q`` bytes says so
   (one in ``EVERY``), so equal texts have equal boundaries.  Between two
   boundaries lies a phrase.  Phrases that occur once in all texts cannot lie
   inside a repeated string; one packed shuffle finds the others, and runs of
   them are the strings of symbols.
2. The strings' suffixes are sorted (sampled triples, names, merge), and each
   suffix is compared with its neighbours in the order: the longest common
   prefix is the longest run of phrases that also starts elsewhere.
3. A window of ``LENGTH`` bytes can only be repeated if the phrases inside it
   are: the common prefixes leave a range of candidate starts at each
   boundary (and all starts of windows without a whole phrase inside).
4. An exact check follows: the candidate windows are hashed (64 bits, from
   prefix sums) and a packed shuffle finds those that occur again.

Equal texts are one text with a number of copies; if it has several and
``LENGTH`` bytes, all of it is covered.

Edge cases: a null text is empty; texts shorter than ``LENGTH`` bytes lose
nothing; repeated rows are copies of each other, whatever their ids; a text
may repeat itself; texts of any length are judged whole, as they came in;
an empty table gives no rows.  Only the id and the text are read, so other
columns may clash with anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import mix64, null_safe, shuffle_partitions, store, text_slices
from gridloom.llm.shared_records import SHIPPED, pack, shared_records
from gridloom.llm.suffix_sort import suffix_order

LENGTH = 400
Q = 8
EVERY = 64
DEPTH = 2                 # levels of triples: 9 phrases in order
BATCH_BYTES = 4 << 20
FRAGMENTS = 64            # at least
FAR = 1 << 40

#: a phrase: its hash, start, length, the distance of its start from the
#: boundary before, and the length of the phrase after it
PHRASE = np.dtype([("h", "<u8"), ("start", "<u4"), ("size", "<u4"), ("gap", "<u4"), ("after", "<u4")])
WINDOW = np.dtype([("h", "<u8"), ("start", "<u4")])
#: consecutive window starts, and a range of candidate starts [first, end)
RUN = np.dtype([("start", "<u4"), ("n", "<u4")])
RANGE = np.dtype([("first", "<i8"), ("end", "<i8")])
AHEAD = np.dtype([("h", "<u8"), ("size", "<u4")])
LAST = (1 << 32) - 1      # no phrase after: the text ends

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix sums of the weighted bytes, inverse powers)."""
    power = np.full(len(data), _BASE, dtype=np.uint64)
    back = np.full(len(data) + 1, _INVERSE, dtype=np.uint64)
    back[0] = 1
    if len(data):
        power[0] = 1
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * np.cumprod(power), out=sums[1:])
    return sums, np.cumprod(back)


def _range_hash(sums: np.ndarray, back: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return mix64((sums[hi] - sums[lo]) * back[lo] + (hi - lo).astype(np.uint64))


def boundaries(data: np.ndarray, every: int = EVERY) -> np.ndarray:
    """Positions whose next ``Q`` bytes hash to 0 mod ``every``."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    words = np.empty(n, dtype=np.uint64)
    for k in range(Q):
        part = np.frombuffer(data[k:].tobytes()[: (len(data) - k) // Q * Q], dtype="<u8")
        words[k::Q] = part[:len(words[k::Q])]
    return np.flatnonzero(mix64(words * _BASE + np.uint64(1)) % np.uint64(every) == 0)


def _ranges(at: np.ndarray, before: np.ndarray, reach: np.ndarray, size: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidate starts [lo, hi) at boundaries ``at``: after the boundary
    ``before``, and such that the boundary ``reach`` is not known to lie
    (with its ``Q`` bytes) inside the window."""
    hi = np.minimum(np.minimum(at, reach - length + Q - 1), size - length) + 1
    return before + 1, hi


def _local(cut: np.ndarray, size: int, length: int) -> np.ndarray:
    """Candidate starts of windows without a whole phrase inside."""
    at = np.append(cut, FAR)
    first, end = _ranges(at, np.append(-1, cut), np.append(at[1:], FAR), size, length)
    out = np.empty(int((first < end).sum()), dtype=RANGE)
    out["first"], out["end"] = first[first < end], end[first < end]
    return out


def _runs(records: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window starts, in order by text -> runs of consecutive ones."""
    start = records["start"].astype(np.int64)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1] + 1) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    out = np.empty(len(at), dtype=RUN)
    out["start"], out["n"] = start[at], np.diff(np.append(at, len(start)))
    return out, owner[at]


def _phrases(fragments: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", BATCH_BYTES):
            texts = [t.as_py().encode("utf-8", "surrogatepass") for t in batch.column("text")]
            place: dict = {}
            keys = list(zip(batch.column("hi").to_pylist(), batch.column("lo").to_pylist()))
            number = np.array([place.setdefault(k, len(place)) for k in keys], dtype=np.int64)
            first = np.unique(number, return_index=True)[1]
            sizes = np.array([len(texts[i]) for i in first], dtype=np.int64)
            found, owner, local = [], [], [b""] * len(first)
            for i, at in enumerate(first):
                if sizes[i] < length:
                    continue
                data = np.frombuffer(texts[at], dtype=np.uint8)
                cut = boundaries(data)
                local[i] = _local(cut, len(data), length).tobytes()
                if len(cut) < 2:
                    continue
                sums, back = _prefix_sums(data)
                rows = np.empty(len(cut) - 1, dtype=PHRASE)
                rows["h"] = _range_hash(sums, back, cut[:-1], cut[1:])
                rows["start"], rows["size"] = cut[:-1], np.diff(cut)
                rows["gap"] = np.diff(cut[:-1], prepend=-1)
                rows["after"] = np.append(np.diff(cut[1:]), LAST)
                found.append(rows)
                owner.append(np.full(len(rows), i))
            yield pack(fragments, np.array([keys[i][0] for i in first], dtype=np.int64),
                       np.array([keys[i][1] for i in first], dtype=np.int64),
                       np.bincount(number).astype(np.int32), sizes.astype(np.int32),
                       np.concatenate(found) if found else np.zeros(0, PHRASE),
                       np.concatenate(owner) if owner else np.zeros(0, np.int64), local)

    return run


_SYMBOLS = "hi long, lo long, bytes long, run int, off long, sym long, start long, gap long, ahead binary, reach long"


def _strings(length: int):
    """Runs of shared phrases of each text that can hold a repeated window;
    one row per phrase with the phrases ahead of it, as far as a window goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 3 + [pa.int32()] + [pa.int64()] * 4 + [pa.binary(), pa.int64()]
        names = [c.split()[0] for c in _SYMBOLS.split(", ")]
        for batch in batches:
            for row in batch.to_pylist():
                rows = np.unique(np.frombuffer(b"".join(row["parts"]), dtype=PHRASE))
                rows = rows[np.argsort(rows["start"], kind="stable")]
                start, size = rows["start"].astype(np.int64), rows["size"].astype(np.int64)
                breaks = np.flatnonzero(start[1:] != start[:-1] + size[:-1]) + 1
                out: list[list] = [[] for _ in kinds]
                for r, part in enumerate(np.split(np.arange(len(rows)), breaks)):
                    lo, hi = part[0], part[-1] + 1
                    ends = start[lo:hi] + size[lo:hi]
                    after = FAR if rows["after"][hi - 1] == LAST else int(rows["after"][hi - 1])
                    if int(rows["gap"][lo]) + int(ends[-1] - start[lo]) + after <= length - Q:
                        continue  # too short for a window
                    at = np.arange(lo, hi)
                    stop = lo + np.minimum(np.searchsorted(ends, start[lo:hi] + length) + 1, hi - lo)
                    inside = np.minimum(stop, hi - 1)
                    reach = np.where(stop < hi, start[inside] + size[inside], ends[-1] + after)
                    ahead = np.empty(hi - lo, dtype=AHEAD)
                    ahead["h"], ahead["size"] = rows["h"][lo:hi], size[lo:hi]
                    raw = ahead.tobytes()
                    n = hi - lo
                    for column, values in zip(out, (
                            [row["hi"]] * n, [row["lo"]] * n, [row["size"]] * n, [r] * n, at - lo,
                            (rows["h"][lo:hi] >> np.uint64(2)).astype(np.int64) + 1, start[lo:hi],
                            rows["gap"][lo:hi].astype(np.int64),
                            [raw[12 * (k - lo):12 * (e - lo)] for k, e in zip(at, stop)], reach)):
                        column.extend(values)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)

    return run


def _compare(length: int):
    """Neighbours in the suffix order: the candidate starts that their common
    prefix leaves at each boundary.  The first and last row of a partition
    lack a neighbour and are taken as fully common (a wider range)."""

    names = ("hi", "lo", "bytes", "start", "gap", "reach", "sym")

    def common(ahead: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Phrases that each row shares with the next, at the front."""
        most = np.minimum(n[:-1], n[1:])
        shared, active, depth = np.zeros(len(most), dtype=np.int64), np.flatnonzero(most > 0), 0
        while len(active):
            active = active[ahead[at[active] + depth] == ahead[at[active + 1] + depth]]
            depth += 1
            shared[active] = depth
            active = active[most[active] > depth]
        return shared

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row and what it shares with the one before it (-1: none)
        for batch in batches:
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names}
            aheads = batch.column("ahead").to_pylist()
            if held is not None:
                rows = {c: np.append(held[0][c], v) for c, v in rows.items()}
                aheads = [held[1], *aheads]
            n = np.array([len(a) for a in aheads], dtype=np.int64) // 12
            records = np.frombuffer(b"".join(aheads), dtype=AHEAD)
            at = np.cumsum(n) - n
            with_next = common(records["h"], at, n)
            with_before = np.append(held[2] if held is not None else -1, with_next)
            out, shared = slice(0, len(n) - 1), np.maximum(with_before[:-1], with_next)
            shared[with_before[:-1] < 0] = -1
            if len(n) > 1:
                yield ranges({c: v[out] for c, v in rows.items()}, records, at[out], n[out], shared)
            held = ({c: v[-1:] for c, v in rows.items()}, aheads[-1], with_before[-1])
        if held is not None:
            records = np.frombuffer(held[1], dtype=AHEAD)
            yield ranges(held[0], records, np.zeros(1, np.int64), np.array([len(records)]), np.array([-1]))

    def ranges(rows: dict, records: np.ndarray, at: np.ndarray, n: np.ndarray, shared: np.ndarray) -> pa.RecordBatch:
        sums = np.concatenate([[0], np.cumsum(records["size"], dtype=np.int64)])
        shared = np.minimum(shared, n)
        # equal as far as the order goes, and that is no whole window: all may be common
        unsure = (shared < 0) | ((shared >= 3 ** DEPTH) & (sums[at + np.maximum(shared, 0)] - sums[at] < length))
        shared = np.where(unsure, n, shared)
        # the boundary after the phrase that follows the common ones
        follow = np.minimum(at + shared + 1, len(sums) - 1)
        reach = np.where(shared < n, rows["start"] + sums[follow] - sums[at], rows["reach"])
        first, end = _ranges(rows["start"], rows["start"] - rows["gap"], reach, rows["bytes"], length)
        first = np.maximum(first, 0)
        some = first < end
        return pa.RecordBatch.from_arrays([pa.array(c[some], pa.int64()) for c in (
            rows["hi"], rows["lo"], first, end, rows["sym"])], ["hi", "lo", "first", "end", "sym"])

    return run


_RANGES = "hi long, lo long, least long, ranges binary"


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All candidate ranges of a text, packed."""
    for batch in batches:
        packed = []
        for found, local in zip(batch.column("found").to_pylist(), batch.column("local").to_pylist()):
            own = np.array([(r["first"], r["end"]) for r in found or ()], dtype=RANGE)
            packed.append(own.tobytes() + (local or b""))
        yield pa.RecordBatch.from_arrays([batch.column("hi"), batch.column("lo"), batch.column("least"),
                                          pa.array(packed, pa.binary())], ["hi", "lo", "least", "ranges"])


def _windows(fragments: int, length: int):
    """The hashes of the candidate windows of each text, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", BATCH_BYTES // 2):
            found, owner = [], []
            for i, (text, ranges) in enumerate(zip(batch.column("text"), batch.column("ranges").to_pylist())):
                data = np.frombuffer(text.as_py().encode("utf-8", "surrogatepass"), dtype=np.uint8)
                wanted = np.zeros(len(data) + 2, dtype=np.int32)
                ranges = np.frombuffer(ranges, dtype=RANGE)
                np.add.at(wanted, ranges["first"], 1)
                np.add.at(wanted, ranges["end"], -1)
                at = np.flatnonzero(np.cumsum(wanted) > 0)
                sums, back = _prefix_sums(data)
                rows = np.empty(len(at), dtype=WINDOW)
                rows["h"], rows["start"] = _range_hash(sums, back, at, at + length), at
                found.append(rows)
                owner.append(np.full(len(rows), i))
            keys = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("hi", "lo")]
            ones = np.ones(batch.num_rows, dtype=np.int32)
            yield pack(fragments, *keys, ones, ones, np.concatenate(found) if found else np.zeros(0, WINDOW),
                       np.concatenate(owner) if owner else np.zeros(0, np.int64), shrink=_runs)

    return run


_SPANS = "hi long, lo long, spans array<struct<start:int,end:int>>"


def _spans(length: int):
    """Repeated window starts of a text -> maximal covered runs of bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for row in batch.to_pylist():
                runs = np.sort(np.frombuffer(b"".join(row["parts"]), dtype=RUN), order="start")
                lo = runs["start"].astype(np.int64)
                hi = np.maximum.accumulate(lo + runs["n"] - 1 + length)  # end of the bytes that a run covers
                cut = np.flatnonzero(lo[1:] > hi[:-1]) + 1
                out[0].append(row["hi"])
                out[1].append(row["lo"])
                out[2].append([{"start": int(a), "end": int(b)} for a, b in zip(
                    lo[np.append(0, cut)], hi[np.append(cut, len(lo)) - 1])])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(
                out[2], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], ["hi", "lo", "spans"])

    return run


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(texts: hi, lo, copies, size; spans: hi, lo, text, covered runs of
    bytes) of the distinct texts, keyed by 128 bits of hash."""
    fragments = max(FRAGMENTS, shuffle_partitions(docs))
    rows = docs.select(null_safe(F.col(text_col)).alias("text")).select(
        F.xxhash64(F.lit(1), "text").alias("hi"), F.xxhash64("text").alias("lo"), "text")
    shared = shared_records(rows.mapInArrow(_phrases(fragments, length), SHIPPED), fragments, PHRASE)
    texts = store(shared.groupBy("hi", "lo").agg(
        F.sum("copies").alias("copies"), F.max("size").alias("size"), F.max("extra").alias("local"),
        F.when(F.sum(F.octet_length("held")) > 0, F.collect_list("held")).alias("parts")), "phrases")

    symbols = store(texts.filter("parts is not null").select("hi", "lo", "size", "parts")
                    .mapInArrow(_strings(length), _SYMBOLS)
                    .withColumn("sid", F.xxhash64("hi", "lo", "run")), "symbols")
    order = suffix_order(symbols.select("sid", F.lit(0).cast("long").alias("path"), "off", "sym"), DEPTH)
    placed = (symbols.join(order.select("sid", "off", "rank"), ["sid", "off"])
              .repartitionByRange("rank", "sid", "off").sortWithinPartitions("rank", "sid", "off"))
    ranges = (placed.select("hi", "lo", "bytes", "start", "gap", "reach", "sym", "ahead")
              .mapInArrow(_compare(length), "hi long, lo long, first long, end long, sym long"))
    listed = ranges.groupBy("hi", "lo").agg(F.collect_list(F.struct("first", "end")).alias("found"), F.min("sym").alias("least"))
    local = texts.filter(F.octet_length("local") > 0).select("hi", "lo", "local")
    by_text = store(listed.join(local, ["hi", "lo"], "full_outer").mapInArrow(_joined, _RANGES), "ranges")

    # one copy of each text with candidates; texts with the same least phrase
    # next to each other, so that most repeats meet in one task's batch
    candidates = store(rows.join(by_text, ["hi", "lo"]).groupBy("hi", "lo")
                       .agg(F.first("text").alias("text"), F.first("ranges").alias("ranges"), F.first("least").alias("least"))
                       .repartitionByRange("least", "hi").sortWithinPartitions("least", "hi"), "candidates")
    found = shared_records(candidates.select("hi", "lo", "text", "ranges").mapInArrow(_windows(fragments, length), SHIPPED),
                           fragments, WINDOW, RUN, _runs)
    spans = (found.groupBy("hi", "lo").agg(F.collect_list("held").alias("parts"), F.sum(F.octet_length("held")).alias("n"))
             .filter("n > 0").select("hi", "lo", "parts").mapInArrow(_spans(length), _SPANS))
    return (texts.select("hi", "lo", "copies", "size"),
            store(store(spans, "runs").join(candidates.select("hi", "lo", "text"), ["hi", "lo"]), "spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document row: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256 and kept (the remaining bytes; null if nothing was removed)."""
    texts, spans = repeated_spans(docs, text_col, length)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), null_safe(F.col(text_col)).alias("text")).select(
        "doc_id", F.xxhash64(F.lit(1), "text").alias("hi"), F.xxhash64("text").alias("lo"),
        F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"))

    @F.pandas_udf("n_removed long, kept binary")
    def cut(text, runs):
        import pandas as pd

        removed, kept = [], []
        for t, rs in zip(text, runs):
            raw, at, out = t.encode("utf-8", "surrogatepass"), 0, []
            for r in rs:
                out.append(raw[at:r["start"]])
                at = r["end"]
            out.append(raw[at:])
            kept.append(b"".join(out))
            removed.append(len(raw) - len(kept[-1]))
        return pd.DataFrame({"n_removed": removed, "kept": pd.Series(kept, dtype=object)})

    changed = (spans.withColumn("cut", cut("text", "spans"))
               .select("hi", "lo", F.col("cut.n_removed").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.col("cut.kept").alias("kept")))
    copied = texts.filter(f"copies > 1 and size >= {length}").select("hi", "lo", F.lit(True).alias("copied"))
    out = rows.join(copied, ["hi", "lo"], "left").join(changed, ["hi", "lo"], "left")
    whole = F.col("copied").isNotNull()
    return out.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).when(F.col("kept").isNotNull(), F.sha2("kept", 256))
        .otherwise(F.col("text_sha256")).alias("kept_sha256"),
        F.when(whole, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"))
