"""Benchmark decontamination by a generalised suffix automaton.

The words of the normalised test items go into one suffix automaton.  A
document's words are streamed through it; at each word the automaton knows
the longest run of words, ending there, that occurs in an item.  A window is
``window`` consecutive item words (a shorter item is one window); every
document word inside an occurrence of a window is hit.

The automaton is held as dictionaries over word numbers.  Words of no item
lead back to the root, so most of a clean document costs one lookup a word.

Items are cut into groups of at most ``MAX_GROUP_WORDS`` words (by a hash of
the item, at least one item each); each group's automaton is broadcast in
turn and the hits are joined by a chain of maps, so the broadcast is bounded
whatever the benchmark's size, and documents are never shuffled.

Edge cases: a null text has no words and is not contaminated, nor is a text
without words; items that are null or have no words are no windows; repeated
items count each under its own id (a null id is not listed); repeated
document rows are each treated alike; an empty benchmark hits nothing, an
empty table of documents gives no rows; items that tie for a window all count.
Documents of any length are streamed whole.  Input columns that clash with
the operator's are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.common import isolated, null_safe, release_memory

WINDOW = 10
MAX_GROUP_WORDS = 2_000_000
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

_HITS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def words_of(text: str | None) -> list[bytes]:
    """Words of the text with A-Z lower-cased, as UTF-8."""
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences.

    ``step[s]`` maps a word number to the next state, ``link[s]`` is the
    suffix link and ``longest[s]`` the length of the longest run in ``s``."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        coded = [(i, [self.words.setdefault(w, len(self.words)) for w in ws]) for i, ws in items if ws]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        #: windows ending in a state: the full ones, and short items by length
        self.items_at: dict[int, set] = {}
        self.short_at: dict[int, tuple[int, set]] = {}
        for item, codes in coded:
            if len(codes) < window:
                state = 0
                for c in codes:
                    state = self.step[state][c]
                self.short_at.setdefault(state, (len(codes), set()))[1].add(item)
            else:
                for _, state in self._windows(codes):
                    self.items_at.setdefault(state, set()).add(item)
        # the short items that end wherever a state ends: along its suffix links
        self.shorts: list[tuple] = [()] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.longest.__getitem__):
            own = ((self.short_at[state]),) if state in self.short_at else ()
            self.shorts[state] = own + self.shorts[self.link[state]]

    def _extend(self, last: int, c: int) -> int:
        step, link, longest = self.step, self.link, self.longest
        held = step[last].get(c)
        if held is not None:  # the run is known from an earlier item
            return held if longest[held] == longest[last] + 1 else self._clone(last, c, held)
        state = len(link)
        step.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = state
            p = link[p]
        if p >= 0:
            q = step[p][c]
            link[state] = q if longest[q] == longest[p] + 1 else self._clone(p, c, q)
        return state

    def _clone(self, p: int, c: int, q: int) -> int:
        copy = len(self.link)
        self.step.append(dict(self.step[q]))
        self.link.append(self.link[q])
        self.longest.append(self.longest[p] + 1)
        while p >= 0 and self.step[p].get(c) == q:
            self.step[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _matches(self, codes: list) -> Iterator[tuple[int, int, int]]:
        """(position, state, longest matching length) where it is not 0."""
        step, link, longest = self.step, self.link, self.longest
        state, length = 0, 0
        for at, c in enumerate(codes):
            if c is None:
                state, length = 0, 0
                continue
            to = step[state].get(c)
            while to is None and state:
                state = link[state]
                length = longest[state]
                to = step[state].get(c)
            if to is None:
                state, length = 0, 0
                continue
            state, length = to, length + 1
            yield at, state, length

    def _windows(self, codes: list) -> Iterator[tuple[int, int]]:
        """(position, state of the window that ends there)."""
        for at, state, length in self._matches(codes):
            if length >= self.window:
                while self.longest[self.link[state]] >= self.window:
                    state = self.link[state]
                yield at, state

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """(hit runs as [start, end) word positions, the items found)."""
        get = self.words.get
        codes = [get(w) for w in words]
        runs: list[list[int]] = []
        found: set = set()
        link, longest, window, shorts = self.link, self.longest, self.window, self.shorts

        def hit(start: int, end: int) -> None:
            while runs and start <= runs[-1][1]:
                last = runs.pop()
                start, end = min(start, last[0]), max(end, last[1])
            runs.append([start, end])

        for at, state, length in self._matches(codes):
            if length >= window:
                top = state
                while longest[link[top]] >= window:
                    top = link[top]
                found |= self.items_at[top]
                hit(at + 1 - window, at + 1)
            for size, items in shorts[state]:
                if size <= length:
                    found |= items
                    hit(at + 1 - size, at + 1)
        return [tuple(r) for r in runs], found


def _merged(a: list, b: list) -> list:
    out: list[list[int]] = []
    for start, end in sorted([*a, *b]):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text",
                       group_words: int = MAX_GROUP_WORDS) -> DataFrame:
    """``docs`` plus n_words, hits (runs of hit words, [start, end)), n_hit
    and items (the ids with occurring windows, sorted as text)."""
    spark = docs.sparkSession
    table = items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("words"))
    total = table.agg(F.sum(F.length(null_safe(F.col("words"))))).first()[0] or 0
    groups = max(1, -(-total // (4 * group_words)))
    table = table.withColumn("part", F.pmod(F.xxhash64("item", "words"), F.lit(groups)))
    added = [T.StructField("n_words", T.IntegerType()), T.StructField("hits", _HITS),
             T.StructField("items", T.ArrayType(T.StringType()))]
    docs = docs.drop("n_words", "hits", "items", "n_hit")
    names, at = docs.columns, docs.columns.index(text_col)
    out = docs
    for part in range(groups):
        held = [(r["item"], words_of(r["words"])) for r in
                table.filter(F.col("part") == part).select("item", "words").toLocalIterator()]
        shared = spark.sparkContext.broadcast(SuffixAutomaton(held, window))

        def stream(batches: Iterator[pa.RecordBatch], first: bool = part == 0, shared=shared) -> Iterator[pa.RecordBatch]:
            automaton = shared.value
            runs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            for batch in batches:
                for lo in range(0, batch.num_rows, 500):
                    part_rows = batch.slice(lo, 500)
                    n, hits, found = [], [], []
                    for text in part_rows.column(at):
                        words = words_of(text.as_py())
                        hit, ids = automaton.find(words)
                        n.append(len(words))
                        hits.append(hit)
                        found.append({i for i in ids if i is not None})
                    if not first:
                        earlier = part_rows.column(len(names) + 1).to_pylist()
                        hits = [_merged([(r["start"], r["end"]) for r in e], h) for e, h in zip(earlier, hits)]
                        found = [set(e) | f for e, f in zip(part_rows.column(len(names) + 2).to_pylist(), found)]
                    yield pa.RecordBatch.from_arrays(
                        [*part_rows.columns[:len(names)], pa.array(n, pa.int32()),
                         pa.array([[{"start": s, "end": e} for s, e in h] for h in hits], runs),
                         pa.array([sorted(f) for f in found], pa.list_(pa.string()))],
                        [*names, "n_words", "hits", "items"])
            release_memory()

        out = out.mapInArrow(stream, T.StructType(docs.schema.fields + added))
    return out.withColumn("n_hit", F.aggregate("hits", F.lit(0), lambda a, r: a + r["end"] - r["start"]))


def _spans(text: str) -> np.ndarray:
    """(start, end) code points of the words."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    spans = np.array([m.span() for m in WORD.finditer(raw)], dtype=np.int64).reshape(-1, 2)
    starts = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # code points up to and with a byte
    before = np.concatenate([[0], starts])
    return before[spans]


def remove_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                         max_coverage: float = 0.5, text_col: str = "text", **options) -> DataFrame:
    """``docs`` (same columns) without the hit spans: each run of hit words is
    cut from its first to its last character.  Documents of which more than
    ``max_coverage`` of the words are hit are dropped; clean ones stay as they
    are."""
    @F.pandas_udf("string")
    def cut(text, hits):
        import pandas as pd

        def one(t, runs):
            if not len(runs):
                return t
            spans, out, last = _spans(t), [], 0
            for r in runs:
                out.append(t[last:spans[r["start"], 0]])
                last = spans[r["end"] - 1, 1]
            return "".join([*out, t[last:]])

        return pd.Series([one(t, r) for t, r in zip(text, hits)], dtype=object)

    def clean(rows: DataFrame) -> DataFrame:
        found = find_contamination(rows, items, window, text_col, **options)
        found = found.filter(F.col("n_hit") <= max_coverage * F.col("n_words"))
        dirty, text = F.size("hits") > 0, F.col(text_col)
        # of clean rows only nulls pass through Python
        shortened = cut(F.when(dirty, text), F.when(dirty, F.col("hits")).otherwise(F.array().cast(_HITS)))
        return found.withColumn(text_col, F.when(dirty, shortened).otherwise(text))

    return isolated(docs, (text_col,), clean)
