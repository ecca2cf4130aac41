"""N-gram Jaccard join by vertical partitioning.

A document's set is its distinct ``k``-word shingles.  The global n-gram
order is cut into fragments:

1. Map: each task hashes the shingles of its documents (64 bits), and ships
   them packed, fragment by fragment, each with its document's place in the
   batch (two bytes).  A shingle that several documents of a batch hold is
   shipped once as a mark, not once per document, so a shingle of a third of
   all documents reaches its fragment once per batch.  There are as many
   fragments as the text needs, whatever the session's partitions.
2. Each fragment tells which of its shingles occur in several documents; these
   meet again batch by batch.  A set of n shingles can only link
   if three quarters of it are shared with others, so documents below that
   have no link and are done: most documents, whatever passages they share.
3. Equal sets are one class.  A second pass over the fragments counts the
   classes of each shingle.  In the order "shingles of one document first, then
   those of fewest classes, then by hash" two linked sets share a shingle of
   their prefixes (n - ceil(0.75 n) + 1 shingles), and what either holds from
   there on in shared shingles must still be enough for a link.  So a passage
   of very many documents is in the prefix of those only that hold little
   else, and does not bring the others together in pairs.  Each class is first
   paired with neighbours in a random order of its prefix shingles' classes; at
   most ``PARTNERS`` of these pairs a class are verified, and the links joined
   into components.
4. What is left are pairs of one prefix shingle in different components.  All
   of these are verified, each class outside the shingle's largest component
   against the others.  So a group of thousands of near copies is not expanded
   into all its pairs, yet no link between components is lost: the first
   pairs only decide how much is left for this step, never the result.

Verification is vertical as well: the sets' fragments are intersected
separately and the partial overlaps summed per pair.  Before that a bound
drops pairs that cannot link: a bitmap of 1024 cells per class shows at least
how many shingles of one set the other lacks.

Edge cases: null or empty texts and texts without words have an empty set
and link with nothing; a text of fewer than ``k`` words is one shingle (it
never equals a full one); repeated rows (same id, same text) are one document
in the join and come back as often as they came; rows that share an id with
another text are documents of their own; a null id is never the smallest of
a component unless it has no other.  Texts of any length are taken whole: a
task holds the shingles of one.  An empty table gives no rows.  The join reads
only the id and the text, so other columns may clash with anything.  Batches
are numbered, so a task that runs again must read the same rows in the same
order, as it does from files; if it does not, the join ends with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import isolated, mix64, null_safe, release_memory, store, stored_rows, text_slices
from gridloom.llm.components import connected_components

K = 5
BATCH_BYTES = 2 << 20
FRAGMENTS = 64  # at least
FRAGMENT_BYTES = 16 << 20  # of text, or of hashes
OWNERS = 1 << 16
SEGMENTS = 256
VERIFY_FRAGMENTS = 4
CELLS = 1024
PARTNERS = 8

_SHIPPED = ("key int, batch long, stamp long, rows int, hashes binary, owners binary, marks binary, "
            "ids array<long>, texts array<long>, copies array<int>, sizes array<int>")
_SEGMENT = ("batch long, stamp long, rows int, hashes binary, owners binary, "
            "ids array<long>, texts array<long>, copies array<int>, sizes array<int>")
_SETS = "doc_id long, text_key long, copies int, size int, node binary, held array<long>, cells array<long>"
_COUNTED = "key int, batch long, part int, hashes binary, counts binary, nodes array<binary>, sizes array<int>, held array<int>"
_RANKED = "batch long, part int, hashes binary, ranks binary, nodes array<binary>, sizes array<int>, held array<int>"
_PREFIXES = "shingle long, node binary, size int, room int"


def shingle_hashes(texts: pa.Array, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all shingles of all texts, text index of each), with
    repeats; ``texts`` without nulls."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    coded = flat.dictionary_encode()
    table = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()),
                        dtype=np.uint64, count=len(coded.dictionary))
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    codes, owner = coded.indices.to_numpy()[real], owner[real]
    words = mix64(table[codes])
    n_words = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(n_words)
    left = ends[owner] - np.arange(len(words))  # words from here to the text's end
    at = np.flatnonzero(left >= k)
    h = np.full(len(at), k, dtype=np.uint64)
    for j in range(k):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + words[at + j])
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    whole = np.empty(len(short), dtype=np.uint64)
    for i, t in enumerate(short):
        whole[i] = xxhash.xxh64_intdigest(words[ends[t] - n_words[t]:ends[t]].tobytes(), seed=int(n_words[t]))
    return np.concatenate([h, whole]), np.concatenate([owner[at], short])


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary for the ``values`` between each two ``bounds``."""
    values = np.ascontiguousarray(values)
    offsets = np.ascontiguousarray(bounds, dtype=np.int64) * values.itemsize
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)]).cast(pa.binary())


def _lists(values: pa.Array | np.ndarray, kind: pa.DataType) -> pa.Array:
    """One list of all ``values``."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(the values of all binaries, the bounds of each)."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    size = np.dtype(kind).itemsize
    values = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]].view(kind) if at[-1] > at[0] else np.zeros(0, kind)
    return values, (at - at[0]) // size


def _joined(columns: list[pa.Array], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """``_flat`` of several columns, one after the other."""
    flat = [_flat(c, kind) for c in columns]
    counts = [np.diff(bounds) for _, bounds in flat]
    return (np.concatenate([v for v, _ in flat] or [np.zeros(0, kind)]),
            np.concatenate([[0], np.cumsum(np.concatenate(counts or [np.zeros(0, np.int64)]))]).astype(np.int64))


def _part_of(h: np.ndarray, fragments: int) -> np.ndarray:
    part = (h >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)
    return part.astype(np.uint16 if fragments <= 1 << 16 else np.int64)


def _neighbours(h: np.ndarray) -> np.ndarray:
    """True in a sorted array where a value occurs more than once."""
    same, equal = np.zeros(len(h), dtype=bool), h[1:] == h[:-1]
    same[1:] |= equal
    same[:-1] |= equal
    return same


def _distinct(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of each text: (hashes, owners, whether another
    text of the batch holds it)."""
    order = np.argsort(h)
    met = order[_neighbours(h[order])]
    met = met[np.lexsort((owner[met], h[met]))]
    new = np.ones(len(met), dtype=bool)
    new[1:] = (h[met][1:] != h[met][:-1]) | (owner[met][1:] != owner[met][:-1])
    kept, shared = np.ones(len(h), dtype=bool), np.zeros(len(h), dtype=bool)
    kept[met[~new]] = False
    met = met[new]
    shared[met[_neighbours(h[met])]] = True
    return h[kept], owner[kept], shared[kept]


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches of at most 2 ** 16 rows, so that two bytes name a row, with a
    number that no other batch of the stage has."""
    task = TaskContext.get()
    first, n = (task.partitionId() if task else 0) << 32, 0
    for batch in batches:
        for lo in range(0, batch.num_rows, OWNERS):
            yield first + n, batch.slice(lo, OWNERS)
            n += 1


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each batch number, of batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        number = batch.column("batch").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if held and hi > lo and held[0].column("batch")[0].as_py() != number[lo]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            if hi > lo:
                held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _changed() -> RuntimeError:
    return RuntimeError("a task that was run again read its rows in another order: store the documents first")


def _ship(fragments: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in _numbers(text_slices(batches, "text", BATCH_BYTES)):
            texts = pc.fill_null(batch.column("text"), "")
            keys = np.fromiter((xxhash.xxh64_intdigest(t, seed=42) for t in texts.to_pylist()), np.uint64,
                               len(texts)).view(np.int64)  # as xxhash64() of SQL
            # repeated rows of the batch are one document with copies
            ids = batch.column("doc_id").to_pylist()
            place: dict = {}
            first = [place.setdefault(x, len(place)) for x in zip(ids, keys.tolist())]
            firsts = np.unique(np.array(first, dtype=np.int64), return_index=True)[1]
            copies = np.bincount(first, minlength=len(firsts))
            ids = pa.array(batch.column("doc_id").take(pa.array(firsts)), pa.int64())
            keys, texts = keys[firsts], texts.take(pa.array(firsts))
            stamp = xxhash.xxh64_intdigest(pc.fill_null(ids, 0).to_numpy().tobytes() + keys.tobytes()) >> 1

            h, owner, shared = _distinct(*shingle_hashes(texts, k))
            sizes, owner = np.bincount(owner, minlength=len(firsts)), owner.astype(np.uint16)
            marks, alone = np.unique(h[shared]), h[~shared]
            part = _part_of(alone, fragments)
            by = np.argsort(part, kind="stable")  # documents stay in order
            every = np.arange(fragments + 1)
            at, mark_at = np.searchsorted(part[by], every), np.searchsorted(_part_of(marks, fragments), every)
            some = np.flatnonzero((np.diff(at) > 0) | (np.diff(mark_at) > 0))
            none = [pa.nulls(fragments, pa.list_(t)) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32())]
            rows = pa.RecordBatch.from_arrays(
                [pa.array(every[:-1], pa.int32()), pa.array(np.full(fragments, number), pa.int64()),
                 pa.array(np.full(fragments, stamp), pa.int64()),
                 pa.array(np.full(fragments, len(some) + 1), pa.int32()), _binaries(alone[by], at),
                 _binaries(owner[~shared][by], at), _binaries(marks, mark_at), *none], _names(_SHIPPED))
            yield rows.take(pa.array(some))
            # every document, with what is known to be shared already
            ends = np.array([0, int(shared.sum())])
            yield pa.RecordBatch.from_arrays(
                [pa.array([stamp % fragments], pa.int32()), pa.array([number], pa.int64()), pa.array([stamp], pa.int64()),
                 pa.array([len(some) + 1], pa.int32()), _binaries(h[shared], ends), _binaries(owner[shared], ends), pa.array([b""]),
                 _lists(ids, pa.int64()), _lists(keys, pa.int64()), _lists(copies, pa.int32()), _lists(sizes, pa.int32())],
                _names(_SHIPPED))
        release_memory()

    return run


def _fragment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One fragment of the order: which of its shingles several documents
    hold; one row per row of a batch, with those of its shingles."""
    names, parts = _names(_SEGMENT), []
    for batch in batches:
        whole = pc.is_valid(batch.column("sizes"))
        yield batch.filter(whole).select(names)
        parts.append(batch.filter(pc.invert(whole)))
    h, bounds = _joined([p.column("hashes") for p in parts], np.uint64)
    owner, _ = _joined([p.column("owners") for p in parts], np.uint16)
    marks = np.unique(_joined([p.column("marks") for p in parts], np.uint64)[0])
    rows = [p.select([n for n in names if n not in ("hashes", "owners")]) for p in parts]
    del parts
    order = np.argsort(h)
    same = np.zeros(len(h), dtype=bool)
    same[order[_neighbours(h[order])]] = True
    del order
    if len(marks):
        same |= marks[np.minimum(np.searchsorted(marks, h), len(marks) - 1)] == h
    ends = np.concatenate([[0], np.cumsum(same)])[bounds]
    h, owner, lo = h[same], owner[same], 0
    for batch in rows:
        for at in range(0, batch.num_rows, SEGMENTS):
            part = batch.slice(at, SEGMENTS)
            cut = ends[lo:lo + part.num_rows + 1]
            lo += part.num_rows
            held = {n: _binaries(v[cut[0]:cut[-1]], cut - cut[0]) for n, v in (("hashes", h), ("owners", owner))}
            yield pa.RecordBatch.from_arrays([held[n] if n in held else part.column(n) for n in names], names)
    release_memory()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of a batch with their shared shingles, if these are at
    least three quarters of the set: the class of a set that is shared as a
    whole is its digest, any other set holds a shingle of its own and is a
    class alone."""
    for rows in _runs(batches):
        whole = rows.filter(pc.is_valid(rows.column("sizes")))
        if whole.num_rows != 1 or len(pc.unique(rows.column("stamp"))) != 1 or whole.column("rows")[0].as_py() != rows.num_rows:
            raise _changed()
        ids, keys, copies, sizes = (whole.column(n).combine_chunks().flatten() for n in ("ids", "texts", "copies", "sizes"))
        h, _ = _joined(rows.column("hashes").chunks, np.int64)
        owner, _ = _joined(rows.column("owners").chunks, np.uint16)
        size = sizes.to_numpy()
        n = np.bincount(owner, minlength=len(size))
        enough = (4 * n >= 3 * size) & (size > 0)
        some = enough[owner]
        h, owner = h[some], owner[some]
        h = h[np.lexsort((h, owner))]
        ends = np.concatenate([[0], np.cumsum(np.where(enough, n, 0))])
        digest, cells = [None] * len(size), np.zeros((len(size), CELLS), dtype=bool)
        for i in np.flatnonzero(enough):
            held = h[ends[i]:ends[i + 1]]
            own = b"" if n[i] == size[i] else f"{ids[i].as_py()}:{keys[i].as_py()}".encode()
            digest[i] = hashlib.blake2b(held.tobytes() + own, digest_size=16).digest()
            cells[i, held & (CELLS - 1)] = True
        words, wide = np.packbits(cells[enough], axis=1).view(np.int64).ravel(), CELLS // 64
        absent = pa.array(~enough)
        yield pa.RecordBatch.from_arrays(
            [ids, keys, copies, sizes, pa.array(digest, pa.binary()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h, pa.int64()), mask=absent),
             pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(enough * wide)]), pa.int32()),
                                      pa.array(words, pa.int64()), mask=absent)], _names(_SETS))
    release_memory()


def _by_batch(rows: DataFrame, tasks: int, *then: str) -> DataFrame:
    return rows.repartitionById(tasks, F.pmod(F.xxhash64("batch"), F.lit(tasks)).cast("int")).sortWithinPartitions("batch", *then)


def shingle_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """One row per distinct (doc_id, text) of a batch: copies, size (distinct
    shingles) and, if its shared shingles are at least three quarters of the
    set, ``held``, these, and the class ``node`` with its bitmap ``cells``.
    Rows of one document in several batches agree but for the copies."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # fragments follow the text, not the session: each costs a row per batch, and is held by its task
    text_bytes = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    fragments = max(FRAGMENTS, -(-text_bytes // FRAGMENT_BYTES))
    segments = (rows.mapInArrow(_ship(fragments, k), _SHIPPED).repartitionById(fragments, F.col("key"))
                .mapInArrow(_fragment, _SEGMENT))
    return _by_batch(segments, fragments).mapInArrow(_sets, _SETS)


def _count(fragments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in _numbers(_set_slices(batches)):
            held = batch.column("held")
            h = held.flatten().to_numpy().view(np.uint64)
            found, counts = np.unique(h, return_counts=True)
            every = np.arange(fragments + 1)
            at = np.searchsorted(_part_of(found, fragments), every)
            kinds = (pa.binary(), pa.int32(), pa.int32())
            rows = pa.RecordBatch.from_arrays(
                [pa.array(every[:-1], pa.int32()), pa.array(np.full(fragments, number), pa.int64()),
                 pa.array(every[:-1], pa.int32()), _binaries(found, at), _binaries(counts.astype(np.uint32), at),
                 *[pa.nulls(fragments, pa.list_(t)) for t in kinds]], _names(_COUNTED))
            yield rows.filter(pa.array(np.diff(at) > 0))
            # the sets, which come first of their batch
            yield pa.RecordBatch.from_arrays(
                [pa.array([number % fragments], pa.int32()), pa.array([number], pa.int64()), pa.array([-1], pa.int32()),
                 _binaries(h, np.array([0, len(h)])), pa.array([b""]), _lists(batch.column("node"), kinds[0]),
                 _lists(batch.column("size"), kinds[1]), _lists(pc.list_value_length(held), kinds[2])], _names(_COUNTED))
        release_memory()

    return run


def _set_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts like those of ``text_slices``, by the shingles of the sets."""
    for batch in batches:
        before = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("held")).to_numpy(), dtype=np.int64)]) * 8
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(before, before[at] + BATCH_BYTES, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One fragment of the order: by how many classes each of its shingles is
    held, as a byte: 0 for a single one, then eight steps per doubling."""
    names, parts = _names(_RANKED), []
    for batch in batches:
        whole = pc.is_valid(batch.column("sizes"))
        sets = batch.filter(whole)
        yield pa.RecordBatch.from_arrays([sets.column("counts" if n == "ranks" else n) for n in names], names)
        parts.append(batch.filter(pc.invert(whole)))
    h, bounds = _joined([p.column("hashes") for p in parts], np.uint64)
    counts, _ = _joined([p.column("counts") for p in parts], np.uint32)
    found, place = np.unique(h, return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(found))
    ranks = np.minimum(8 * np.log2(np.maximum(total, 1)), 255).astype(np.uint8)[place]
    lo = 0
    for batch in parts:
        cut = bounds[lo:lo + batch.num_rows + 1]
        lo += batch.num_rows
        column = {"hashes": pa.array([b""] * batch.num_rows, pa.binary()), "ranks": _binaries(ranks[cut[0]:cut[-1]], cut - cut[0])}
        yield pa.RecordBatch.from_arrays([column[n] if n in column else batch.column(n) for n in names], names)
    release_memory()


def _first_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prefixes of the sets of a batch, whose ranks follow them by
    fragment and so by hash."""
    for rows in _runs(batches):
        whole = rows.filter(pc.equal(rows.column("part"), -1))
        if whole.num_rows != 1:
            raise _changed()
        nodes, sizes, n = (whole.column(c).combine_chunks().flatten() for c in ("nodes", "sizes", "held"))
        h, _ = _joined(whole.column("hashes").chunks, np.uint64)
        ranks, _ = _joined(rows.column("ranks").chunks, np.uint8)
        found, place = np.unique(h, return_inverse=True)
        if len(found) != len(ranks):
            raise _changed()
        rank, owner, size = ranks[place], np.repeat(np.arange(len(n)), n.to_numpy()), sizes.to_numpy()
        shared = rank > 0
        h, rank, owner = h[shared], rank[shared], owner[shared]
        order = np.lexsort((h, rank, owner))
        h = h[order]
        held = np.bincount(owner, minlength=len(size))
        room = np.repeat(np.cumsum(held), held) - np.arange(len(h))
        # what either set holds from a shared shingle on must suffice for three quarters of it
        first = 4 * room >= 3 * size[owner]
        owner = owner[first]
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[first].view(np.int64)), nodes.take(pa.array(owner)), sizes.take(pa.array(owner)),
             pa.array(room[first], pa.int32())], _names(_PREFIXES))
    release_memory()


def prefixes(nodes: DataFrame) -> DataFrame:
    """(shingle, node, size, room): the prefix of each class in the order
    "shingles of fewest classes first, then by hash", without the shingles of
    a single class, and how many shared shingles it holds from there on."""
    fragments = max(VERIFY_FRAGMENTS * 4, -(-(nodes.agg(F.sum("n_held").alias("n")).first()["n"] or 0) * 8 // FRAGMENT_BYTES))
    counted = nodes.select("node", "size", "held").mapInArrow(_count(fragments), _COUNTED)
    ranked = counted.repartitionById(fragments, F.col("key")).mapInArrow(_rank, _RANKED)
    return _by_batch(ranked, fragments, "part").mapInArrow(_first_shingles, _PREFIXES)


def _lacking(one: str, other: str) -> Column:
    """How many cells of one bitmap the other lacks."""
    # (as array functions: spelled out, the join's code grows past what the JVM compiles)
    bits = F.zip_with(one, other, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
    return F.aggregate(bits, F.lit(0), lambda a, b: a + b)


def _overlap_bound(held: str, cells: str, o_held: str, o_cells: str) -> Column:
    """At most how many shingles two sets share."""
    return F.least(F.col(held) - _lacking(cells, o_cells), F.col(o_held) - _lacking(o_cells, cells))


def _possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose bitmaps leave room for a link."""
    left = nodes.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("n_held").alias("n_a"), F.col("cells").alias("cells_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("n_held").alias("n_b"), F.col("cells").alias("cells_b"))
    most = _overlap_bound("n_a", "cells_a", "n_b", "cells_b")
    return (pairs.join(left, "a").join(right, "b")
            .filter(7 * most >= 3 * (F.col("size_a") + F.col("size_b"))).select("a", "b"))


def _links(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) of ``pairs`` that link: partial overlaps per fragment of the order
    are counted separately and summed per pair."""
    parts = nodes.select("node", "size", F.explode(F.sequence(F.lit(0), F.lit(VERIFY_FRAGMENTS - 1))).alias("fragment"),
                         "held").withColumn("held", F.expr(f"filter(held, x -> pmod(x, {VERIFY_FRAGMENTS}) = fragment)"))
    left = parts.select(F.col("node").alias("a"), F.col("size").alias("size_a"), "fragment", F.col("held").alias("held_a"))
    right = parts.select(F.col("node").alias("b"), F.col("size").alias("size_b"), "fragment", F.col("held").alias("held_b"))
    return (pairs.join(left, "a").join(right, ["b", "fragment"])
            .groupBy("a", "b").agg(F.sum(F.size(F.array_intersect("held_a", "held_b"))).alias("overlap"),
                                   F.max(F.col("size_a") + F.col("size_b")).alias("both"))
            .filter("7 * overlap >= 3 * both").select("a", "b"))


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _near(one: str, one_room: str, other: str, other_room: str) -> Column:
    """Sets that share this prefix shingle first can link: the shared shingles
    from there on suffice for both sizes."""
    return 7 * F.least(one_room, other_room) >= 3 * (F.col(one) + F.col(other))


def _partners(entries: DataFrame) -> DataFrame:
    """Pairs of classes to verify first."""
    order = Window.partitionBy("shingle").orderBy(F.xxhash64("node", "shingle"), "node")
    row = F.struct("node", "size", "room")
    met = (entries.withColumns({"head": F.first(row).over(order), "prev": F.lag(row).over(order)})
           .select("node", "size", "room", F.explode(F.array("head", "prev")).alias("other"))
           .filter("other is not null")
           .select("node", "size", "room", F.col("other.node").alias("other"), F.col("other.size").alias("o_size"),
                   F.col("other.room").alias("o_room"))
           .filter((F.col("node") != F.col("other")) & _near("size", "room", "o_size", "o_room"))
           .groupBy("node", "other").agg(F.count("*").alias("n")))
    best = Window.partitionBy("node").orderBy(F.col("n").desc(), F.xxhash64("node", "other"), "other")
    return (met.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= PARTNERS)
            .select(*_ordered(F.col("node"), F.col("other"))).distinct())


def _place(entries: DataFrame, found: DataFrame) -> DataFrame:
    """The prefix entries with their components, of shingles whose classes
    are in several."""
    placed = store(entries.join(found, "node", "left")
                   .withColumn("component", F.coalesce("component", "node")), "placed")
    sides = placed.groupBy("shingle", "component").agg(F.count("*").alias("n"))
    largest = (sides.groupBy("shingle").agg(F.max_by("component", F.struct("n", "component")).alias("largest"),
                                            F.count("*").alias("parts"))
               .filter("parts > 1").select("shingle", "largest"))
    return placed.join(largest, "shingle")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """One row per document row: doc_id, text_key (xxhash64 of the text),
    n_shingles, component_id (the smallest doc_id reachable by links, itself
    included), copy (1, 2 .. for repeated rows) and kept: true for one row of
    each component, that with the smallest doc_id."""
    shingled = store(shingle_documents(docs, id_col, text_col, k), "shingled")
    documents = shingled.groupBy("doc_id", "text_key").agg(
        F.sum("copies").alias("copies"), F.max("size").alias("size"), F.max("node").alias("node"))
    nodes = store(shingled.filter("node is not null").groupBy("node").agg(
        F.first("size").alias("size"), F.first("held").alias("held"), F.first("cells").alias("cells"))
        .withColumn("n_held", F.size("held")), "nodes")
    entries = store(prefixes(nodes), "prefixes")
    links = store(_links(_possible(_partners(entries), nodes), nodes), "links")
    found = connected_components(links)

    # all pairs of one prefix shingle whose components still differ
    left = _place(entries, found).join(nodes.select("node", "cells", "n_held"), "node")
    columns = ("node", "size", "room", "component", "n_held", "cells")
    one = left.filter("component <> largest").select("shingle", *[F.col(c).alias(f"l_{c}") for c in columns])
    two = left.select("shingle", *[F.col(c).alias(f"r_{c}") for c in columns])
    most = _overlap_bound("l_n_held", "l_cells", "r_n_held", "r_cells")
    rest = (one.join(two, "shingle").filter((F.col("l_component") != F.col("r_component"))
                                            & _near("l_size", "l_room", "r_size", "r_room")
                                            & (7 * most >= 3 * (F.col("l_size") + F.col("r_size"))))
            .select(*_ordered(F.col("l_node"), F.col("r_node"))).distinct())
    more, n_more, _ = stored_rows(_links(rest, nodes), "links")
    if n_more:
        found = connected_components(links.unionByName(more))

    grouped = (documents.filter("node is not null").select("doc_id", "text_key", "node").join(found, "node", "left")
               .withColumn("component", F.coalesce("component", "node")))
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    smallest = (grouped.groupBy("component").agg(F.min(own).alias("least"), F.count("*").alias("n")).filter("n > 1"))
    ids = grouped.join(smallest, "component").select(
        F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key"), F.col("least.doc_id").alias("component_id"),
        (own == F.col("least")).alias("m_kept"))
    out = documents.join(ids, documents.doc_id.eqNullSafe(ids.m_id) & (documents.text_key == ids.m_key), "left")
    return out.select("doc_id", "text_key", F.col("size").cast("long").alias("n_shingles"),
                      F.coalesce("component_id", "doc_id").alias("component_id"),
                      F.coalesce("m_kept", F.lit(True)).alias("m_kept"),
                      F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
                      ).withColumn("kept", F.col("m_kept") & (F.col("copy") == 1)).drop("m_kept")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """``docs`` (same columns) with one document of each component, that with
    the smallest id; of repeated rows one stays.  Rows without words are
    copies of nothing and all stay, repeated ids or not."""
    found = near_duplicates(docs, id_col, text_col, k)
    gone = found.filter(~F.col("kept") & (F.col("copy") == 1)).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))

    def drop(rows: DataFrame) -> DataFrame:
        worded = null_safe(F.col(text_col)).rlike(r"[^\x20\x09-\x0D]")
        keyed = rows.filter(worded).withColumn("_text_key", F.xxhash64(null_safe(F.col(text_col))))
        left = keyed.join(gone, F.col(id_col).cast("long").eqNullSafe(F.col("_id"))
                          & (F.col("_text_key") == F.col("_key")), "left_anti")
        return left.dropDuplicates([id_col, "_text_key"]).drop("_text_key").unionByName(rows.filter(~worded))

    return isolated(docs, (id_col, text_col), drop)
