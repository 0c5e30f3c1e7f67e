"""Chat formatting with minimum-cost role repair.

Legal conversations are: an optional system turn, then user and assistant in alternation from a user turn on, ending with
the assistant. Each given turn is kept, relabelled, or merged into the turn before it, and empty turns may be inserted before it;
dynamic programming over the automaton picks the cheapest way. States are the role of the last turn written. One turn is a small
matrix of costs between states, and matrices of consecutive turns multiply (minimum and sum), so a conversation
is cut into segments wherever its rows fell, each segment gives one matrix, a chain over a conversation's segments gives the state at each
seam, and every segment is then solved by itself. So no task needs a whole conversation.

Turns are ordered by turn, role and text (nulls first); equal rows follow each other. Role names are matched without case, with the synonyms in
``NAMES``; other and null roles can take any role at ``COST_UNKNOWN``. A null or empty text is an empty turn. A null conversation id
is a conversation of its own. Of equally cheap repairs the one whose states come first in ``ROLES`` order from the end wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..runtime import staged

ROLES = ("system", "user", "assistant")
# Other names in use for the roles.
NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}
START = 3  # state before any turn; states 0 to 2 are the roles
NEXT = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}  # legal successors
FINAL = (2,)
COST_RELABEL, COST_UNKNOWN, COST_MERGE, COST_INSERT = 2, 1, 1, 3
ROWS_A_PART = 20_000
INF = 1 << 30
STATES = 4
HEAD, TAIL = "<|{role}|>\n", "\n<|end|>\n"


def role_code(role: str | None) -> int:
    name = (role or "").strip().lower()
    name = NAMES.get(name, name)
    return ROLES.index(name) if name in ROLES else -1


def _label_cost(given: int, taken: int) -> int:
    return 0 if given == taken else COST_UNKNOWN if given < 0 else COST_RELABEL


def _fill(start: int, role: int) -> list[int] | None:
    """Roles to insert so that ``role`` may follow ``start``: the shortest way, found breadth first."""
    ways, seen = [(start, [])], {start}
    for state, way in ways:
        if role in NEXT[state]:
            return way
        for step in NEXT[state]:
            if step not in seen:
                seen.add(step)
                ways.append((step, [*way, step]))
    return None


FILL = {(s, r): _fill(s, r) for s in range(STATES) for r in range(len(ROLES))}
# What to insert at the end, by state; nothing is written for a conversation without turns.
CLOSE = {s: min((FILL[s, f] + [f] if s != f else [] for f in FINAL if s == f or FILL[s, f] is not None), key=len) for s in range(3)}


def actions(given: int) -> list[tuple[int, int, int, str]]:
    """(from state, to state, cost, action) for a turn."""
    out = []
    for state in range(STATES):
        for role in range(len(ROLES)):
            fill = FILL[state, role]
            label = _label_cost(given, role)
            if fill is not None:
                out.append((state, role, len(fill) * COST_INSERT + label, "keep" if given == role else "relabel"))
            if state == role:
                out.append((state, role, COST_MERGE + label, "merge"))
    return out


ACTIONS = {given: actions(given) for given in range(-1, len(ROLES))}


def _step_matrix(given: int) -> np.ndarray:
    m = np.full((STATES, STATES), INF, np.int64)
    for a, b, cost, _ in ACTIONS[given]:
        m[a, b] = min(m[a, b], cost)
    return m


MATRIX = {given: _step_matrix(given) for given in range(-1, len(ROLES))}


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None]).min(1), INF)


def segment_matrix(roles: list[int]) -> np.ndarray:
    m = np.where(np.eye(STATES, dtype=bool), 0, INF).astype(np.int64)
    for given in roles:
        m = times(m, MATRIX[given])
    return m


def solve(roles: list[int], entry: int, leave: int) -> list[tuple[int, str, list[int]]]:
    """Role, action and inserted roles for each turn of a segment between two known states."""
    cost = [np.full(STATES, INF, np.int64)]
    cost[0][entry] = 0
    for given in roles:
        cost.append(np.minimum((cost[-1][:, None] + MATRIX[given]).min(0), INF))
    out, state = [], leave
    for k in range(len(roles) - 1, -1, -1):
        best = min((x for x in ACTIONS[roles[k]] if x[1] == state), key=lambda x: (cost[k][x[0]] + x[2], x[0], x[3] == "merge"))
        inserted = [] if best[3] == "merge" else FILL[best[0], state]
        out.append((state, best[3], inserted))
        state = best[0]
    return out[::-1]


def _ends(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """State at the start and end of each segment on a cheapest way."""
    cost = [np.full(STATES, INF, np.int64)]
    cost[0][START] = 0
    for m in matrices:
        cost.append(np.minimum((cost[-1][:, None] + m).min(0), INF))
    state = min(range(3), key=lambda s: (cost[-1][s] + len(CLOSE[s]) * COST_INSERT, s))
    out = []
    for k in range(len(matrices) - 1, -1, -1):
        before = min(range(STATES), key=lambda s: (cost[k][s] + matrices[k][s, state], s))
        out.append((before, state))
        state = before
    return out[::-1]


def repair(turns: DataFrame) -> DataFrame:
    """One row for each given turn of ``turns(conv_id, turn, role, text)``, in the order of ``part, place``.

    ``fixed_role`` and ``action`` (keep, relabel, merge) say what became of it, ``inserted`` names empty turns put before it,
    and ``piece`` is its part of the rendered conversation: joining the pieces of a conversation in order renders it. The last piece also holds
    the empty turns that close it.
    """
    turns = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    parts = 1 + turns.count() // ROWS_A_PART
    # Equal rows may be dealt anywhere among themselves; the salt spreads a conversation of nothing else.
    salted = turns.withColumn("salt", F.spark_partition_id())
    ordered = salted.repartitionByRange(parts, "conv_id", "turn", "role", "text", "salt").sortWithinPartitions("conv_id", "turn", "role", "text", "salt")
    dealt = staged(
        ordered.select("conv_id", "turn", "role", "text", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "chat-turns"
    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Matrices of runs of turns within a task; runs of one segment multiply later in order of place."""
        for batch in batches:
            conv, part, place, roles = (c.to_pylist() for c in batch.columns)
            out, i = [], 0
            while i < len(conv):
                j = i
                while j < len(conv) and conv[j] == conv[i] and part[j] == part[i]:
                    j += 1
                out.append((conv[i], part[i], place[i], segment_matrix([role_code(r) for r in roles[i:j]]).ravel().tolist()))
                i = j
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["conv_id", "part", "place", "matrix"])

    matrices = (
        dealt.select("conv_id", "part", "place", "role").repartition("part").sortWithinPartitions("part", "place").mapInArrow(segments, "conv_id bigint, part int, place bigint, matrix array<bigint>")
    )

    def chain(group: pa.Table) -> pa.Table:
        """A conversation's few segments: their number follows the number of tasks, not of turns."""
        rows = sorted(zip(group["part"].to_pylist(), group["place"].to_pylist(), group["matrix"].to_pylist()))
        byp: dict[int, np.ndarray] = {}
        for part, _, m in rows:
            m = np.array(m, np.int64).reshape(STATES, STATES)
            byp[part] = times(byp[part], m) if part in byp else m
        ends = _ends(list(byp.values()))
        n = len(byp)
        return pa.table(
            {
                "of_conv": pa.array([group["conv_id"][0].as_py()] * n, pa.int64()), "of_part": pa.array(list(byp), pa.int32()),
                "entry": pa.array([a for a, _ in ends], pa.int32()), "leave": pa.array([b for _, b in ends], pa.int32()),
                "ends": pa.array([k == n - 1 for k in range(n)]), "begins": pa.array([k == 0 for k in range(n)]),
            }
        )

    seams = matrices.groupBy("conv_id").applyInArrow(chain, "of_conv bigint, of_part int, entry int, leave int, ends boolean, begins boolean")
    joined = dealt.join(seams, F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("part") == F.col("of_part"))).drop("of_conv", "of_part")

    def write(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        rows = group.to_pylist()
        out, i = [], 0
        while i < len(rows):
            j = i
            while j < len(rows) and rows[j]["conv_id"] == rows[i]["conv_id"]:
                j += 1
            run = rows[i:j]
            solved = solve([role_code(r["role"]) for r in run], run[0]["entry"], run[0]["leave"])
            for k, (row, (state, action, inserted)) in enumerate(zip(run, solved)):
                text = row["text"] or ""
                if action == "merge":
                    piece = f"\n{text}" if text else ""
                else:
                    piece = "" if k == 0 and row["begins"] else TAIL
                    piece += "".join(HEAD.format(role=ROLES[r]) + TAIL for r in inserted) + HEAD.format(role=ROLES[state]) + text
                if row["ends"] and k == len(run) - 1:
                    piece += TAIL + "".join(HEAD.format(role=ROLES[r]) + TAIL for r in CLOSE[state])
                out.append((row["conv_id"], row["turn"], row["part"], row["place"], row["role"], ROLES[state], action, ",".join(ROLES[r] for r in inserted), piece))
            i = j
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.string()] * 5)
        names = ["conv_id", "turn", "part", "place", "role", "fixed_role", "action", "inserted", "piece"]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, zip(*out), kinds)})

    schema = "conv_id bigint, turn bigint, part int, place bigint, role string, fixed_role string, action string, inserted string, piece string"
    # A part holds about ROWS_A_PART turns.
    return joined.groupBy("part").applyInArrow(write, schema)


def render(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, rendered`` for conversations that fit a cell; longer ones are read as pieces from ``repair``."""
    pieces = repair(turns).groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.array_sort(F.collect_list(F.struct("part", "place", "piece"))).alias("pieces"))
    return pieces.select("conv_id", "n_turns", F.expr("array_join(transform(pieces, p -> p.piece), '')").alias("rendered"))
