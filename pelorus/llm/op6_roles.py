"""Chat formatting: minimum-cost role repair, then rendering.

A legal chat is an optional system turn, then user and assistant turns by turns, starting with user. Dynamic programming over this automaton
chooses per input turn: keep its role (0), merge it into the turn before (1), relabel it (2), merge it under the other
turn's role (3); empty turns may be inserted anywhere (3 each). The cheapest sequence of actions is rendered.

Rows are sorted by (conversation, turn, role, text) over range partitions and packed into bundles, so a conversation of any length
spreads over many. A bundle summarises its pieces of cut conversations as 4 x 4 matrices of least costs between states;
(min, +) products of these matrices, added up per conversation and, for very long ones, per stretch of pieces first, fix the states at the
cuts, and every bundle then traces its own rows.

The result has one row per input row, with the piece of rendered text it contributes; in order, the pieces of a conversation
are its rendering. Of equally cheap repairs any one is chosen.

Edge cases: null and unknown roles must be relabelled or merged; null texts are empty; null turns come first; rows equal
in all columns are turns of their own; a null conversation id is a conversation. A conversation of system turns only gets an
empty user turn. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import global_index
from ..session import durable
from .bundles import bundle_files, tasks_for, unpack_rows
from .common import arrow_schema

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
# States that may follow a state, named by the role of the last turn.
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
_ENDS = (USER, ASSISTANT)
MERGE, RELABEL, INSERT = 1, 2, 3
_FAR = 1 << 40
# Pieces of one conversation that a task holds at once.
SPAN = 4096


def _insertions() -> list[list[tuple[int, tuple[int, ...]] | None]]:
    """Cheapest run of empty turns from state to state."""
    best: list[list] = [[None] * 4 for _ in range(4)]
    for s in range(4):
        best[s][s] = (0, ())
        edge = [(s, ())]
        while edge:
            edge = [(t, (*path, t)) for u, path in edge for t in _NEXT[u] if best[s][t] is None]
            for t, path in edge:
                if best[s][t] is None:
                    best[s][t] = (INSERT * len(path), path)
    return best


def _steps(role: int | None) -> list[list[tuple[int, tuple[int, ...], str] | None]]:
    """Cheapest way to take one turn of ``role`` from state to state: cost, inserted turns, action."""
    inserts = _insertions()
    best: list[list] = [[None] * 4 for _ in range(4)]
    for s in range(4):
        for u in range(4):
            if inserts[s][u] is None:
                continue
            cost, path = inserts[s][u]
            options = [(0 if t == role else RELABEL, t, "keep" if t == role else "relabel") for t in _NEXT[u]]
            if u != START:
                options.append((MERGE, u, "merge") if u == role else (MERGE + RELABEL, u, "merge_relabel"))
            for more, t, action in options:
                if best[s][t] is None or cost + more < best[s][t][0]:
                    best[s][t] = (cost + more, path, action)
    return best


_STEPS = {r: _steps(r) for r in (None, SYSTEM, USER, ASSISTANT)}
_COST = {r: np.array([[x[0] if x else _FAR for x in row] for row in m]) for r, m in _STEPS.items()}
_INSERTS = _insertions()


def state_of(role: str | None) -> int | None:
    return ROLES.index(role) + 1 if role in ROLES else None


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) product."""
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def summary(roles: list[int | None]) -> np.ndarray:
    total = np.where(np.eye(4, dtype=bool), 0, _FAR)
    for r in roles:
        total = product(total, _COST[r])
    return total


def closing(state: int) -> tuple[int, tuple[int, ...]]:
    """Cheapest empty turns that end a chat in ``state``."""
    return min(_INSERTS[state][e] for e in _ENDS if _INSERTS[state][e] is not None)


def trace(roles: list[int | None], entry: int, leave: int | None) -> list[tuple[int, int, tuple[int, ...], str, int]]:
    """Per turn ``(state before, state after, inserted turns, action, cost)`` of the cheapest way from ``entry`` to ``leave``
    (None: the cheapest legal end)."""
    costs = [np.where(np.arange(4) == entry, 0, _FAR)]
    for r in roles:
        costs.append((costs[-1][:, None] + _COST[r]).min(axis=0))
    state = leave if leave is not None else min(range(4), key=lambda s: costs[-1][s] + closing(s)[0])
    out = []
    for k in range(len(roles) - 1, -1, -1):
        before = int(np.argmin(costs[k] + _COST[roles[k]][:, state]))
        cost, path, action = _STEPS[roles[k]][before][state]
        out.append((before, state, path, action, cost))
        state = before
    return out[::-1]


def _runs(ids: list) -> list[tuple[int, int]]:
    """Stretches of equal conversation ids."""
    cuts = [k for k in range(len(ids)) if k == 0 or ids[k] != ids[k - 1]]
    return list(zip(cuts, [*cuts[1:], len(ids)], strict=True))


def _summaries(kind: str):
    """The first and the last conversation of every bundle, with the cost matrix of its turns there."""
    schema = arrow_schema(_pieces_ddl(kind))

    def run(batches):
        for b in batches:
            for bundle, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = unpack_rows(blob)
                ids, roles = rows.column(0).to_pylist(), [state_of(r) for r in rows.column(2).to_pylist()]
                runs = _runs(ids)
                ends = [runs[0]] + ([runs[-1]] if len(runs) > 1 else [])
                columns = [rows.column(0).take(pa.array([a for a, _ in ends])), pa.array([bundle] * len(ends)), pa.array([summary(roles[a:z]).ravel().tolist() for a, z in ends])]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _pieces_ddl(kind: str) -> str:
    return f"conv {kind}, place bigint, matrix array<bigint>"


def _through(matrices: list[np.ndarray], entry: int, leave: int | None) -> list[int]:
    """States before, between and after the pieces of a conversation on its cheapest way (``leave`` None: to the cheapest legal end)."""
    costs = [np.where(np.arange(4) == entry, 0, _FAR)]
    for m in matrices:
        costs.append((costs[-1][:, None] + m).min(axis=0))
    states = [leave if leave is not None else min(range(4), key=lambda s: costs[-1][s] + closing(s)[0])]
    for n in range(len(matrices) - 1, -1, -1):
        states.append(int(np.argmin(costs[n] + matrices[n][:, states[-1]])))
    return states[::-1]


def _traced(table: pa.Table, entry: int, leave: int | None) -> pa.Table:
    table = table.sort_by("place")
    states = _through([np.array(m).reshape(4, 4) for m in table.column("matrix").to_pylist()], entry, leave)
    n = table.num_rows
    # The last piece of a conversation ends where it is cheapest, which its own task finds.
    out = [None if leave is None and k == n - 1 else states[k + 1] for k in range(n)]
    return pa.table([table.column("conv"), table.column("place"), pa.array(states[:-1], pa.int64()), pa.array(out, pa.int64())], ["conv", "place", "entry", "leave"])


def _states(pieces: DataFrame, kind: str, span: int = SPAN) -> DataFrame:
    """``(conv, place, entry, leave)`` of the pieces of all conversations that have several; ``leave`` is null for a last piece.

    Up to ``span`` pieces are traced in one task. Longer conversations are first cut into stretches of ``span`` pieces, whose matrices
    (min, +) multiply to pieces of a shorter conversation; when its states are known, every stretch is traced on its own.
    """
    ddl = f"conv {kind}, place bigint, entry bigint, leave bigint"
    sizes = pieces.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("low")).filter("n > 1")
    cut = durable(pieces.join(sizes.withColumnRenamed("conv", "of"), F.col("conv").eqNullSafe(F.col("of"))).drop("of"))
    short = cut.filter(F.col("n") <= span).select("conv", "place", "matrix")
    found = short.groupBy("conv").applyInArrow(lambda t: _traced(t, START, None), ddl)
    if cut.filter(F.col("n") > span).isEmpty():
        return found
    # Pieces of a conversation are numbered by a global sort; a stretch is a run of ``span`` numbers.
    null_first = F.col("conv").isNull()
    long = global_index(cut.filter(F.col("n") > span).select("conv", "place", "matrix"), null_first.desc(), F.asc("conv"), F.asc("place"), name="at")
    starts = long.groupBy("conv").agg(F.min("at").alias("first")).withColumnRenamed("conv", "of")
    long = long.join(starts, F.col("conv").eqNullSafe(F.col("of"))).select("conv", "place", "matrix", F.floor((F.col("at") - F.col("first")) / span).alias("stretch"))
    long = durable(long)

    def multiplied(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        total = np.where(np.eye(4, dtype=bool), 0, _FAR)
        for m in table.column("matrix").to_pylist():
            total = product(total, np.array(m).reshape(4, 4))
        return pa.table([table.column("conv").slice(0, 1), table.column("stretch").slice(0, 1), pa.array([total.ravel().tolist()], pa.list_(pa.int64()))], ["conv", "place", "matrix"])

    above = _states(durable(long.groupBy("conv", "stretch").applyInArrow(multiplied, _pieces_ddl(kind))), kind, span)
    known = durable(above).select(F.col("conv").alias("of"), F.col("place").alias("stretch_of"), "entry", "leave")
    ready = long.join(known, F.col("conv").eqNullSafe(F.col("of")) & (F.col("stretch") == F.col("stretch_of"))).drop("of", "stretch_of")

    def traced(table: pa.Table) -> pa.Table:
        return _traced(table.select(["conv", "place", "matrix"]), table.column("entry")[0].as_py(), table.column("leave")[0].as_py())

    return found.unionByName(ready.groupBy("conv", "stretch").applyInArrow(traced, ddl))


def _turn(role: int, text: str) -> str:
    return f"<|{ROLES[role - 1]}|>\n{text}"


_END = "<|end|>\n"


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """``conv_id, turn, role_in, role_out, action, inserted, cost, rendered`` of every row; ``inserted`` names the empty
    turns put before it (after it, for the last row, behind a ``|``)."""
    kinds = dict(turns.dtypes)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), text.alias("text"))
    keyed = rows.withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange("conv", "turn", "role", "h", "row").sortWithinPartitions("conv", "turn", "role", "h")
    bundles = bundle_files(ordered.select("conv", "turn", "role", "text"), 3)
    kind = kinds[conv_col]
    pieces = durable(bundles.mapInArrow(_summaries(kind), _pieces_ddl(kind)))
    states = _states(pieces, kind, span)
    # A bundle that begins inside a conversation has an entry state there, one that ends inside a conversation an exit state.
    head = states.join(states.groupBy("conv").agg(F.min("place").alias("low")).withColumnRenamed("conv", "of"), F.col("conv").eqNullSafe(F.col("of")))
    ends = durable(head.groupBy(F.col("place").alias("bundle")).agg(
        F.max(F.when(F.col("place") > F.col("low"), F.col("entry"))).alias("entry"), F.max("leave").alias("leave")
    ))
    placed = bundles.join(ends, "bundle", "left").select("bundle", "blob", "entry", "leave").repartition(tasks_for(bundles))
    ddl = (
        f"`{conv_col}` {kinds[conv_col]}, `{turn_col}` {kinds[turn_col]}, role_in string, role_out string, action string, "
        "inserted string, cost bigint, rendered string"
    )
    names = [conv_col, turn_col, "role_in", "role_out", "action", "inserted", "cost", "rendered"]

    def render(batches):
        for b in batches:
            for blob, entry, leave in zip(*(b.column(c).to_pylist() for c in ("blob", "entry", "leave")), strict=True):
                rows = unpack_rows(blob)
                ids, roles, texts = rows.column(0).to_pylist(), rows.column(2).to_pylist(), rows.column(3).to_pylist()
                done = []
                for a, z in _runs(ids):
                    start = entry if a == 0 and entry is not None else START
                    stop = leave if z == len(ids) else None
                    way = trace([state_of(r) for r in roles[a:z]], start, stop)
                    for k, (before, after, path, action, cost) in enumerate(way):
                        parts, added, last = [], ",".join(ROLES[p - 1] for p in path), before
                        for p in path:
                            parts += [_END if last != START else "", _turn(p, "")]
                            last = p
                        if action.startswith("merge"):
                            parts.append("\n" + texts[a + k])
                        else:
                            parts += [_END if last != START else "", _turn(after, texts[a + k])]
                        if k == len(way) - 1 and stop is None:
                            more, tail = closing(after)
                            for p in tail:
                                parts += [_END, _turn(p, "")]
                            parts.append(_END)
                            cost += more
                            added += "|" + ",".join(ROLES[p - 1] for p in tail) if tail else ""
                        done.append((ROLES[after - 1], action, added, cost, "".join(parts)))
                columns = list(zip(*done, strict=True))
                arrays = [pa.array(columns[i], t) for i, t in enumerate((pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(2), *arrays], names)

    return placed.mapInArrow(render, ddl)
