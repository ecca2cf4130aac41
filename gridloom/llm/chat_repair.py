"""Chat formatting with minimum-cost role repair.

A legal conversation is: at most one system turn, first; then user and
assistant in turn, starting with the user and ending with the assistant.  The
automaton's states are the role that was last (``start`` before any).  Each
input turn is consumed by one of

* keep: it follows as it is;
* merge: it continues the turn before, which has its role;
* relabel: its role is changed (then kept or merged);

each with empty turns inserted before it where the automaton needs them, and
at the end empty turns may complete the sequence.  Dynamic programming over
the states finds the cheapest way; ties go to the first action in the order
above, then the earlier role, so results are defined.

A turn is a small matrix of costs from state to state (its role decides
which), so a conversation is a (min, +) product of matrices, and a long one
is cut into blocks of ``BLOCK`` turns: 1. each block's product, streamed with
constant memory; 2. per conversation the cheapest states at the block
borders, from one matrix per block; 3. each block finds its own path between
its border states and renders.  No task holds a whole conversation.

The result has one piece per input turn and inserted turn; the pieces of a
conversation, joined in the order of ``piece``, are its rendered text.

Edge cases: a null or unknown role must be relabelled (cost ``unknown``); a
null or empty text is an empty turn; turns are ordered by ``turn`` (null
last), ties by role, then a hash of the text, so repeated rows stay
adjacent; rows with a null conv_id form one conversation; control marks
inside texts are broken up, so a text cannot open or close a turn; an empty
table gives no rows.  Texts of any length are rendered whole.  Only the four
named columns are read, so others may clash with anything.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import product
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import null_safe, shuffle_partitions

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
BLOCK = 4096
FAR = float("inf")
BEGIN, END = "<|im_start|>", "<|im_end|>"
#: next states of the legal-turn automaton
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = (START, ASSISTANT)


class Costs(NamedTuple):
    merge: float = 1.0
    insert: float = 2.0
    relabel: float = 3.0
    unknown: float = 1.0  # giving a role to a turn that has none of the three


class Step(NamedTuple):
    cost: float
    action: str          # keep, merge, relabel, relabel+merge
    inserted: tuple      # states of empty turns before it
    state: int           # the turn's role, as a state


@lru_cache(maxsize=None)
def _fills(state: int, to: tuple) -> tuple:
    """Ways to reach a state of ``to`` by at most two inserted turns."""
    found = []
    for n in range(3):
        for way in product(range(1, STATES), repeat=n):
            at, legal = state, True
            for s in way:
                legal, at = legal and s in NEXT[at], s
            if legal and at in to:
                found.append(way)
    return tuple(found)


@lru_cache(maxsize=None)
def transitions(role: int, costs: Costs) -> dict[tuple[int, int], Step]:
    """Cheapest step for a turn of this role (0: unknown) between states."""
    best: dict[tuple[int, int], Step] = {}
    for state in range(STATES):
        options = []
        for label in sorted(range(1, STATES), key=lambda x: (x != role, x)):
            changed = 0.0 if label == role else costs.relabel if role else costs.unknown
            name = "keep" if label == role else "relabel"
            for way in _fills(state, tuple(range(STATES))):
                at = way[-1] if way else state
                if label in NEXT[at]:
                    options.append(Step(changed + costs.insert * len(way), name, way, label))
            if label == state:
                options.append(Step(changed + costs.merge, "merge" if label == role else "relabel+merge", (), label))
        order = {"keep": 0, "merge": 1, "relabel": 2, "relabel+merge": 3}
        for step in sorted(options, key=lambda s: (s.cost, order[s.action], len(s.inserted), s.inserted)):
            best.setdefault((state, step.state), step)
    return best


@lru_cache(maxsize=None)
def ending(state: int, costs: Costs) -> tuple[float, tuple]:
    """Cost and empty turns that complete a conversation."""
    way = min(_fills(state, FINAL), key=lambda w: (len(w), w))
    return costs.insert * len(way), way


def _advance(row: list[float], role: int, costs: Costs) -> list[float]:
    out = [FAR] * STATES
    for (a, b), step in transitions(role, costs).items():
        out[b] = min(out[b], row[a] + step.cost)
    return out


def best_path(roles: list[int], first: int, last: int, costs: Costs) -> list[Step]:
    """The cheapest steps from state ``first`` to state ``last``."""
    rows = [[0.0 if s == first else FAR for s in range(STATES)]]
    for r in roles:
        rows.append(_advance(rows[-1], r, costs))
    path, state = [], last
    for at in range(len(roles) - 1, -1, -1):
        moves = transitions(roles[at], costs)
        came = next(a for a in range(STATES) if (a, state) in moves
                    and rows[at][a] + moves[a, state].cost == rows[at + 1][state])
        path.append(moves[came, state])
        state = came
    return path[::-1]


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows with their block (range of turn numbers, cut again if many rows
    share a range) and place in it."""
    spread = F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(1 << 60))
    order = Window.partitionBy("conv_id", "span").orderBy(F.col("turn").asc_nulls_last(), "role", "text_key")
    return (rows.withColumns({"span": spread, "text_key": F.xxhash64("text")})
            .withColumn("place", F.row_number().over(order) - 1)
            .withColumn("cut", F.floor(F.col("place") / BLOCK)))


def _codes(role) -> "F.Column":
    return sum((F.when(role == name, i + 1).otherwise(0) for i, name in enumerate(ROLES)), F.lit(0))


def repair(conversations: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, piece, turn (null for inserted
    turns), given_role, role, action, cost, rendered."""
    parts = shuffle_partitions(conversations)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                "role", null_safe(F.col("text")).alias("text"))
    blocks = _blocks(rows).withColumn("code", _codes(F.coalesce("role", F.lit(""))))
    key = ["conv_id", "span", "cut"]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One (min, +) product per block; the rows come sorted."""
        at, costs_of = None, None

        def close() -> pa.RecordBatch:
            flat = [c for row in costs_of for c in row]
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int64()),
                                               pa.array([at[2]], pa.int64()), pa.array([flat], pa.list_(pa.float64()))],
                                              [*key, "costs"])

        for batch in batches:
            for *block, code in zip(*(batch.column(c).to_pylist() for c in (*key, "code"))):
                if block != at:
                    if at is not None:
                        yield close()
                    at = block
                    costs_of = [[0.0 if a == b else FAR for b in range(STATES)] for a in range(STATES)]
                costs_of = [_advance(row, code, costs) for row in costs_of]
        if at is not None:
            yield close()

    matrices = (blocks.select(*key, "place", "code").repartition(parts, *key).sortWithinPartitions(*key, "place")
                .select(*key, "code").mapInArrow(products, "conv_id long, span long, cut long, costs array<double>"))

    def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The cheapest states at the borders of each conversation's blocks."""
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            rows_, came = [[0.0, FAR, FAR, FAR]], []
            for *_, flat in held:
                step = [[rows_[-1][a] + flat[a * STATES + b] for a in range(STATES)] for b in range(STATES)]
                came.append([min(range(STATES), key=s.__getitem__) for s in step])
                rows_.append([min(s) for s in step])
            state = min(range(STATES), key=lambda s: rows_[-1][s] + ending(s, costs)[0])
            out = []
            for i in range(len(held) - 1, -1, -1):
                out.append((*held[i][:3], i, came[i][state], state, i == len(held) - 1))
                state = came[i][state]
            names = [*key, "block", "first", "last", "closes"]
            kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in (*key, "costs"))):
                if held and held[0][0] != row[0]:
                    yield close()
                    held = []
                held.append(row)
        if held:
            yield close()

    found = (matrices.repartition(parts, "conv_id").sortWithinPartitions(*key)
             .mapInArrow(borders, "conv_id long, span long, cut long, block long, first int, last int, closes boolean"))
    same = (F.col("b.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("b.span") == F.col("f.span"))
            & (F.col("b.cut") == F.col("f.cut")))
    joined = blocks.alias("b").join(found.alias("f"), same).select(
        "b.conv_id", "block", "place", "turn", "role", "code", "first", "last", "closes", "text")

    out_kinds = {"conv_id": pa.int64(), "piece": pa.int64(), "turn": pa.int64(), "given_role": pa.string(),
                 "role": pa.string(), "action": pa.string(), "cost": pa.float64(), "rendered": pa.string()}

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block's own path between its border states, rendered."""
        held: list[dict] = []

        def close() -> pa.RecordBatch:
            head = held[0]
            out: list[tuple] = []

            def add(turn, given, state, action, cost, text, opens):
                begin = "" if not opens else (END + "\n" if out or head["block"] else "") + f"{BEGIN}{ROLES[state - 1]}\n"
                safe = text.replace("<|", "< |")
                body = safe if opens else "\n\n" + safe
                out.append((head["conv_id"], head["block"] * 4 * BLOCK + len(out), turn, given, ROLES[state - 1],
                            action, cost, begin + body))

            for row, step in zip(held, best_path([r["code"] for r in held], head["first"], head["last"], costs)):
                for state in step.inserted:
                    add(None, None, state, "insert", costs.insert, "", True)
                add(row["turn"], row["role"], step.state, step.action, step.cost - costs.insert * len(step.inserted),
                    row["text"], "merge" not in step.action)
            if head["closes"]:
                for state in ending(head["last"], costs)[1]:
                    add(None, None, state, "insert", costs.insert, "", True)
                out[-1] = (*out[-1][:-1], out[-1][-1] + END + "\n")
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), out_kinds.values())], list(out_kinds))

        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                for row in batch.slice(lo, 1000).to_pylist():
                    if held and (held[0]["conv_id"], held[0]["block"]) != (row["conv_id"], row["block"]):
                        yield close()
                        held = []
                    held.append(row)
        if held:
            yield close()

    return (joined.repartition(parts, "conv_id", "block").sortWithinPartitions("conv_id", "block", "place")
            .mapInArrow(paths, "conv_id long, piece long, turn long, given_role string, role string, action string, "
                               "cost double, rendered string"))
