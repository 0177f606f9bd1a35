"""Repair of damaged conversations at least cost by an auction for shortest paths.

A conversation's rows and the states of the turn order (nothing yet, after
system, after user, after assistant) span a lattice; edits are its arcs. Node
prices rise by path extension and contraction until every node's price is its
distance to the end. Arcs that lose nothing at these prices are the arcs of
cheapest repairs, and the one that comes first in the alphabet is traced along
them. Long conversations are cut into chunks: the distances between the states
at both ends of a chunk let the chunks be solved one by one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldweave.llm.common import sieve
from goldweave.llm.turns import placed, turn_name
from goldweave.session import Scratch

# White space, ends of sentences, costs, and the states of the turn order.
BLANKS = " \t\n\x0b\f\r"
STOPS = ".!?"
RETAG, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 50
_END = (0, NEVER, NEVER, 0)  # a conversation may end before its first turn or behind an assistant


@dataclass(frozen=True)
class Settings:
    """``chunk`` rows of a conversation are solved at a time; the result does not depend on it."""

    chunk: int = 4096


# What an output of a role leads to, by state.
_AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}


@lru_cache(None)
def _row_arcs(code: str, state: int) -> tuple[tuple[int, str, str, int], ...]:
    """Arcs over a row: (cost, edit, role, next state). ``code`` is x for a row that must go, else its role's initial, a capital if cut short."""
    arcs = [(DELETE, "D", "-", state)]
    if code != "x":
        more = CUT_SHORT if code.isupper() else 0
        for role, after in _AFTER.items():
            if state in after:
                if role == code.lower():
                    arcs.append((more, "K", role, after[state]))
                if role != "s":
                    arcs.append((RETAG + more, "R", role, after[state]))
    return tuple(arcs)


_INSERTS = {state: tuple((INSERT, "I", role, after[state]) for role, after in _AFTER.items() if role != "s" and state in after) for state in range(4)}


class _Lattice:
    """Nodes are row * 4 + state; ``ends`` prices the states behind the last row, where only a ``last`` chunk may insert."""

    def __init__(self, codes: str, ends: tuple[int, ...], last: bool):
        self.codes, self.ends, self.n, self.last = codes, ends, len(codes), last

    def arcs(self, node: int):
        """(cost, edit, role, next node); the end is node -1."""
        row, state = divmod(node, 4)
        if row < self.n:
            for cost, edit, role, after in _row_arcs(self.codes[row], state):
                yield cost, edit, role, node - state + 4 + after
        elif self.ends[state] < NEVER:
            yield self.ends[state], "", "", -1
        if row < self.n or self.last:
            for cost, edit, role, after in _INSERTS[state]:
                yield cost, edit, role, node - state + after

    def prices(self) -> list[int]:
        """Distance of every node to the end, by an auction from each node in turn.

        Prices never exceed cost plus price along an arc, and meet it along the
        path. The path's last node raises its price to the best of its arcs and
        leaves the path, or, where it has that price, the best arc extends the
        path. At a node of known distance the path is a shortest one, and so
        all its nodes are known.
        """
        price, known = [0] * (4 * self.n + 4), [False] * (4 * self.n + 4)
        if min(self.ends[USER], self.ends[ASSISTANT]) >= NEVER:  # both are left only for each other
            for node in range(4 * self.n + 4):
                if node % 4 in (USER, ASSISTANT):
                    price[node], known[node] = NEVER, True
        for origin in range(4 * self.n + 3, -1, -1):
            path = [origin]
            while path[-1] >= 0 and not known[path[-1]]:
                node = path[-1]
                best, to = min(((cost + (price[j] if j >= 0 else 0), j) for cost, _, _, j in self.arcs(node)), default=(NEVER, -1))
                if best >= NEVER:
                    price[node], known[node] = NEVER, True
                elif best > price[node]:
                    price[node] = best
                else:
                    path.append(to)
                    continue
                if len(path) > 1:
                    path.pop()
            for node in path:
                if node >= 0:
                    known[node] = True
        return price

    def trace(self, price: list[int], state: int) -> tuple[list[tuple[str, str, int | None]], int]:
        """Edits (initial, role, row) along the tight arcs from a state at the first row, least initials first, and the state at the end."""
        edits, node = [], state
        while True:
            tight = [(edit, role, j) for cost, edit, role, j in self.arcs(node) if cost + (price[j] if j >= 0 else 0) == price[node]]
            edit, role, to = min(tight)
            if to < 0:
                return edits, node % 4
            edits.append((edit, role, None if edit == "I" else node // 4))
            node = to


@lru_cache(1 << 14)
def _repair(codes: str, ends: tuple[int, ...], last: bool, state: int):
    lattice = _Lattice(codes, ends, last)
    price = lattice.prices()
    return price[state], lattice.trace(price, state)[0]


def _distances(codes: str, last: bool) -> list[int]:
    """From each state before the chunk to each state behind it; for the last chunk, to the end, four times."""
    goals = [_END] * 4 if last else [tuple(0 if j == k else NEVER for j in range(4)) for k in range(4)]
    solved = {goal: _Lattice(codes, goal, last).prices()[:4] for goal in dict.fromkeys(goals)}
    return [solved[goal][state] for state in range(4) for goal in goals]


def _distances_of(codes, last):
    import pyarrow as pa

    return pa.array([_distances(c, e) for c, e in zip(codes.to_pylist(), last.to_pylist())], pa.list_(pa.int64()))


def _exits_of(codes, ends, last):
    import pyarrow as pa

    out = []
    for c, e, final in zip(codes.to_pylist(), ends.to_pylist(), last.to_pylist()):
        lattice = _Lattice(c, tuple(e), final)
        price = lattice.prices()
        out.append([lattice.trace(price, state)[1] if price[state] < NEVER else START for state in range(4)])
    return pa.array(out, pa.list_(pa.int32()))


def _edits_of(codes, ends, last, state):
    import pyarrow as pa

    kind = pa.struct([("cost", pa.int64()), ("edits", pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("row", pa.int64())])))])
    out = []
    for c, e, final, q in zip(codes.to_pylist(), ends.to_pylist(), last.to_pylist(), state.to_pylist()):
        cost, edits = _repair(c, tuple(e), final, q)
        out.append({"cost": cost, "edits": [{"edit": a, "role": b, "row": r} for a, b, r in edits]})
    return pa.array(out, kind)


def _ends(table):
    """Prices of the states behind each chunk, from the last chunk to the first."""
    import pyarrow as pa

    order = sorted(range(table.num_rows), key=table["chunk"].to_pylist().__getitem__, reverse=True)
    distances, ends = table["distances"].to_pylist(), [None] * table.num_rows
    price = _END
    for step, i in enumerate(order):
        ends[i] = list(price)
        d = distances[i]
        price = tuple(d[4 * q] if not step else min(min(d[4 * q + k] + price[k] for k in range(4)), NEVER) for q in range(4))
    return pa.table({"conv_id": table["conv_id"], "chunk": table["chunk"], "ends": pa.array(ends, pa.list_(pa.int64()))})


def _entries(table):
    """State in which the repair enters each chunk."""
    import pyarrow as pa

    chunks, exits = table["chunk"].to_pylist(), table["exits"].to_pylist()
    entry, state = [0] * len(chunks), START
    for i in sorted(range(len(chunks)), key=chunks.__getitem__):
        entry[i], state = state, exits[i][state]
    return pa.table({"conv_id": table["conv_id"], "chunk": table["chunk"], "state": pa.array(entry, pa.int32())})


def damage(conversations: DataFrame, *, id_column: str = "conv_id") -> DataFrame:
    """(conv_id, turn, role, text) after damage that the CRC-32 of ``conv_id:turn`` modulo 20 decides.

    0 drops the row, 1 empties its text, 2 takes the stops out of it, 3 repeats the row, 4 makes its role user. Nulls
    count as one space, in the checksum as in role and text; a null turn stays null.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col(id_column).alias("conv_id"), "turn", said("role").alias("role"), said("text").alias("text"),
        (F.crc32(F.concat(said(id_column), F.lit(":"), said("turn")).cast("binary")) % 20).cast("int").alias("harm")).filter("harm <> 0")
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _faults(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows in order with their first fault: blank, duplicate, truncated or none."""
    turns = placed(rows, scratch, "turn", "role", "text", turn_name().alias("name"))
    first = scratch.save(turns.groupBy("conv_id", "name").agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        F.col("conv_id").alias("c"), F.col("name").alias("m"), "first"), "first")
    # Only turns that may be said twice look for their first occurrence.
    suspects, others = sieve(turns, F.col("name"), first.select("m"))
    again = suspects.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("name") == F.col("m")), "left").drop("c", "m")
    every = again.unionByName(others.withColumn("first", F.lit(None).cast("long")))
    trimmed = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(trimmed == "", "blank").when(F.col("position") > F.col("first"), "duplicate").when(
        ~F.coalesce(F.instr(F.lit(STOPS), F.right(trimmed, F.lit(1))) > 0, F.lit(False)), "truncated")
    return every.select("conv_id", "position", "turn", "role", "text", fault.alias("fault"))


def repair_conversations(conversations: DataFrame, scratch: Scratch, cfg: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(edits, report) of conversations (conv_id, turn, role, text).

    Rows are taken by turn, nulls first, equal ones by role and text. A row's
    first fault counts: blank (nothing but white space), duplicate (role and text seen
    earlier in the conversation), truncated (the last character that is not
    white space is no stop). The cheapest edits are found after which the roles'
    initials read (s?(ua)+)? : Keep 0, Rerole to user or assistant 2, Delete 3,
    Insert an empty user or assistant turn anywhere 2; blank and duplicate
    rows must go, and a truncated row that stays costs 1. Among equally cheap
    ones the initials of the edits decide, least in ASCII.

    ``edits``: conv_id, chunk, step (their order), edit, position (of the row;
    null for Insert), turn, role and text (after the edit; null for Delete).
    ``report``, one row a conversation: conv_id, gaps (numbers missing between
    its turns, nulls aside), blank, duplicate, truncated, illegal (neighbours
    whose initials are not su, ua or au), cost, audit (the edits' initials).

    Null ids are one conversation, null roles and texts one space. Repeated rows are duplicates. Empty
    input gives empty results; extra columns are left out. A conversation may
    hold any share of the rows: its chunks are solved apart, and only its
    audit, a byte for each edit, is ever in one place.
    """
    rows = conversations.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    work = Scratch(scratch.spark, "repair")
    found = scratch.save(_faults(rows, work), "faults")
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    letters = lambda name: F.array_join(F.transform("rows", lambda r: r[name]), "")
    size = F.lit(cfg.chunk)
    chunks = work.save(found.groupBy("conv_id", F.floor(F.col("position") / size).alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("position", code.alias("code"), initial.alias("initial")))).alias("rows"),
    ).select("conv_id", "chunk", letters("code").alias("codes"), letters("initial").alias("initials")), "chunks")
    ordered = Window.partitionBy("conv_id").orderBy("chunk")
    chained = work.save(chunks.select(
        "*", F.lead("chunk").over(ordered).isNull().alias("last"), F.lag(F.right("initials", F.lit(1))).over(ordered).alias("before")), "chained")
    alone = chained.filter("chunk = 0 AND last")
    several = chained.filter("NOT (chunk = 0 AND last)")

    # Back over the chunks of long conversations for the prices behind each, forth for the states that the repair passes.
    id_type = chained.schema["conv_id"].dataType.simpleString()
    keyed = lambda df, name: df.select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"), name)
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k"))
    priced = work.save(several.select("conv_id", "chunk", F.arrow_udf(_distances_of, "array<bigint>")("codes", "last").alias("distances")).groupBy("conv_id").applyInArrow(
        _ends, f"conv_id {id_type}, chunk long, ends array<bigint>"), "priced")
    passed = work.save(several.join(keyed(priced, "ends"), same).drop("c", "k"), "passed")
    entered = passed.select("conv_id", "chunk", F.arrow_udf(_exits_of, "array<int>")("codes", "ends", "last").alias("exits")).groupBy("conv_id").applyInArrow(
        _entries, f"conv_id {id_type}, chunk long, state int")
    every = alone.withColumns({"ends": F.array(*[F.lit(e).cast("long") for e in _END]), "state": F.lit(START)}).unionByName(
        passed.join(keyed(entered, "state"), same).drop("c", "k"))
    edits_of = F.arrow_udf(_edits_of, "struct<cost: bigint, edits: array<struct<edit: string, role: string, row: bigint>>>")
    solved = scratch.save(every.withColumn("r", edits_of("codes", "ends", "last", "state")).select(
        "conv_id", "chunk", "initials", "before", "r.cost", "r.edits"), "solved")
    work.close()

    names = F.create_map(*[F.lit(x) for pair in (("K", "Keep"), ("R", "Rerole"), ("D", "Delete"), ("I", "Insert")) for x in pair])
    roles = F.create_map(*[F.lit(x) for pair in (("u", "user"), ("a", "assistant")) for x in pair])
    steps = solved.select("conv_id", "chunk", F.posexplode("edits").alias("step", "e")).select(
        F.col("conv_id").alias("c"), "chunk", "step", "e.edit", "e.role", (F.col("chunk") * size + F.col("e.row")).alias("row"))
    joined = steps.join(found, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("row") == F.col("position")), "left")
    kept, gone = F.col("edit") == "K", F.col("edit") == "D"
    edits = joined.select(
        F.col("c").alias("conv_id"), "chunk", "step", names[F.col("edit")].alias("edit"), F.col("row").alias("position"), "turn",
        F.when(kept, found["role"]).when(~gone, roles[steps["role"]]).alias("role"), F.when(F.col("edit") == "I", "").when(~gone, F.col("text")).alias("text"))

    counted = lambda fault: F.count_if(F.col("fault") == fault).alias(fault)
    rows_report = found.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"), counted("blank"), counted("duplicate"), counted("truncated"))
    linked = F.concat(F.coalesce("before", F.lit("")), "initials")
    pairs = F.transform(F.sequence(F.lit(1), F.char_length(linked)), lambda i: linked.substr(i, F.lit(2)))
    illegal = F.size(F.filter(pairs, lambda p: (F.char_length(p) == 2) & ~p.isin("su", "ua", "au")))
    path_report = solved.groupBy(F.col("conv_id").alias("c")).agg(
        F.sum(illegal).cast("long").alias("illegal"), F.min_by("cost", "chunk").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", F.array_join("edits.edit", "").alias("audit")))), lambda a: a["audit"]), "").alias("audit"))
    report = rows_report.join(path_report, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    return edits, report
