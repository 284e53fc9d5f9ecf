"""Chat formatting: the cheapest repair of a conversation's roles, and its rendering.

A legal conversation is an optional system turn, then user and assistant turns in
alternation, beginning with user and ending with assistant. A dynamic program
over the automaton of legal turns chooses for each turn to keep its role, relabel
it, or merge it into the turn before, and where to insert empty turns, at the
least total cost (COSTS). Each turn yields its piece of the rendered sequence;
pieces in turn order are the whole of it, so no conversation is ever one value.

A conversation may be of any length. Rows are dealt out in order of
conversation and turn, so that a long one lies in several parts. Each part tells
one small cost matrix for its first and its last conversation (costs from any
state of the automaton to any other); from these, two for each part, the driver
fixes in which state each cut is passed, and every part then repairs its own
rows between fixed states. The result is the same as in one piece.

Order within a conversation: turn (null first), then role and text, so that ties
and repeated rows have a fixed place; repeated rows are turns of their own. Rows
without a conversation id are one conversation. A null or unknown role may become
any role at a small cost. A null text is empty. An empty table gives no rows. Extra
columns are not read.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from airmart.session import materialize

NONE, SYSTEM, USER, ASSISTANT = range(4)  # the last turn made so far
ROLES = ("", "system", "user", "assistant")
OTHER = 4  # code of a role that is none of these
NEXT = {NONE: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
COSTS = {"insert": 3, "merge": 1, "merge other": 4, "relabel": 2, "relabel system": 4, "name": 1}
FAR = 1 << 40
PART_TURNS = 200_000
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant"}


def relabel_cost(role: int, to: int) -> int:
    if role == to:
        return 0
    if role == OTHER:
        return COSTS["name"]
    return COSTS["relabel system" if SYSTEM in (role, to) else "relabel"]


@cache
def moves(role: int) -> dict[tuple[int, int], tuple[int, str, int, int]]:
    """For each pair of states the cheapest way to take a turn of a role: cost, action, made role, inserted role (0: none)."""
    found: dict[tuple[int, int], tuple[int, str, int, int]] = {}

    def offer(a: int, b: int, *way) -> None:
        if (a, b) not in found or way < found[a, b]:
            found[a, b] = way

    for state in range(4):
        if state:
            offer(state, state, COSTS["merge" if state == role else "merge other"], "merge", state, 0)
        for between in (0, *NEXT[state]):
            for made in NEXT[between or state]:
                action = "keep" if made == role else "relabel"
                offer(state, made, relabel_cost(role, made) + COSTS["insert"] * (between > 0), action, made, between)
    return found


@cache
def step(role: int) -> np.ndarray:
    """Cost of taking a turn of a role from any state to any other."""
    cost = np.full((4, 4), FAR, np.int64)
    for (a, b), way in moves(role).items():
        cost[a, b] = way[0]
    return cost


# Roles to insert, and their cost, to end legally from each state.
ENDS = {NONE: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
END_COST = np.array([COSTS["insert"] * len(ENDS[s]) for s in range(4)], np.int64)


def product(roles: np.ndarray) -> np.ndarray:
    """Costs of taking all turns, from any state to any other."""
    total = np.where(np.eye(4, dtype=bool), 0, FAR).astype(np.int64)
    for role in roles.tolist():
        total = np.minimum((total[:, :, None] + step(role)[None]).min(1), FAR)
    return total


def repair(roles: np.ndarray, enter: int = NONE, leave: int | None = None) -> list[tuple[int, str, int, int]]:
    """Cost, action, made role and inserted role of each turn, from one state to another (None: a legal end)."""
    best = np.full(4, FAR, np.int64)
    best[enter] = 0
    came = np.zeros((len(roles), 4), np.int8)
    for i, role in enumerate(roles.tolist()):
        total = best[:, None] + step(role)
        came[i] = total.argmin(0)
        best = np.minimum(total.min(0), FAR)
    state = int((best + END_COST).argmin()) if leave is None else leave
    out = []
    for i in range(len(roles) - 1, -1, -1):
        before = int(came[i, state])
        out.append(moves(int(roles[i]))[before, state])
        state = before
    return out[::-1]


def pieces(texts: list[str], ways: list[tuple], last: bool) -> list[str]:
    """Rendered piece of each turn; what ends a turn stands before the next one, or at the end of the conversation."""
    out = []
    for text, (_, action, made, between) in zip(texts, ways):
        if action == "merge":
            out.append(f"\n{text}")
        else:
            opened = "".join(f"<|{ROLES[r]}|>\n<|end|>\n" for r in (between,) if r)
            out.append(f"{opened}<|{ROLES[made]}|>\n{text}")
    for i in range(len(out)):
        ends = i + 1 < len(out) and ways[i + 1][1] != "merge"
        out[i] += "\n<|end|>\n" if ends else ""
    if last and out:
        out[-1] += "\n<|end|>\n" + "".join(f"<|{ROLES[r]}|>\n<|end|>\n" for r in ENDS[ways[-1][2]])
    return out


def role_code(role: str | Column) -> Column:
    name = F.lower(F.trim(F.col(role) if isinstance(role, str) else role))
    known = F.create_map(*(F.lit(x) for r, k in [*((r, k) for k, r in enumerate(ROLES) if r), *((a, ROLES.index(r)) for a, r in ALIASES.items())] for x in (r, k)))
    return F.coalesce(F.try_element_at(known, name), F.lit(OTHER))


def cut_states(edges: list[dict]) -> dict[tuple[int, bool], tuple[int, int | None, bool]]:
    """State at entry and at exit (None: legal end) and whether the conversation goes on, for the first and last conversation of each part that is cut."""
    chains: list[list[dict]] = []
    for edge in sorted(edges, key=lambda e: (e["part"], not e["first"])):
        if chains and edge["first"] and edge["part"] > chains[-1][-1]["part"] and edge["conv"] == chains[-1][-1]["conv"]:
            chains[-1].append(edge)
        else:
            chains.append([edge])
    states = {}
    for chain in (c for c in chains if len(c) > 1):
        best, came = np.array([0, FAR, FAR, FAR], np.int64), []
        for edge in chain:
            total = best[:, None] + np.array(edge["cost"], np.int64).reshape(4, 4)
            came.append(total.argmin(0))
            best = np.minimum(total.min(0), FAR)
        state: int | None = int((best + END_COST).argmin())
        for k in range(len(chain) - 1, -1, -1):
            before, final = int(came[k][state]), k == len(chain) - 1
            edge = chain[k]
            for first in ([True, False] if edge["only"] else [edge["first"]]):
                states[edge["part"], first] = (before, state, not final)
            state = before
    return states


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", parts: int | None = None) -> DataFrame:
    """(conv_id, turn, role, action, out_role, inserted, cost, piece) for each turn, with its place in `part` and `seq`."""
    spark = turns.sparkSession
    own = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    dealt = own.withColumn("code", role_code("role"))
    # Parts are groups that a task holds, so their number grows with the turns.
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-own.count() // PART_TURNS))
    dealt = dealt.repartitionByRange(parts, *order)
    dealt = dealt.sortWithinPartitions(*order).withColumns({"part": F.spark_partition_id(), "seq": F.monotonically_increasing_id()})
    dealt = materialize(dealt, "chat-turns")

    def runs_of(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        table = table.sort_by("seq").combine_chunks()
        conv = np.array([repr(x) for x in table.column("conv_id").to_pylist()])
        return table, np.append(np.flatnonzero(np.append(True, conv[1:] != conv[:-1])), len(conv))

    def edge_costs(table: pa.Table) -> pa.Table:
        table, cut = runs_of(table)
        codes, n = table.column("code").to_numpy(), len(cut) - 1
        rows = []
        for k in sorted({0, n - 1}):
            conv = repr(table.column("conv_id")[int(cut[k])].as_py())
            rows.append((table.column("part")[0].as_py(), k == 0, n == 1, conv, product(codes[cut[k] : cut[k + 1]]).ravel().tolist()))
        part, first, only, own, cost = zip(*rows)
        return pa.table({"part": pa.array(part, pa.int32()), "first": pa.array(first), "only": pa.array(only), "conv": pa.array(own), "cost": pa.array(cost, pa.list_(pa.int64()))})

    narrow = dealt.select("part", "seq", "conv_id", "code")
    edges = narrow.groupBy("part").applyInArrow(edge_costs, "part int, first boolean, only boolean, conv string, cost array<long>")
    states = cut_states([r.asDict() for r in edges.collect()])  # two rows for each part

    def formatted(table: pa.Table) -> pa.Table:
        table, cut = runs_of(table)
        part, n = table.column("part")[0].as_py(), len(cut) - 1
        codes, texts = table.column("code").to_numpy(), table.column("text").to_pylist()
        ways, made = [], []
        for k in range(n):
            enter, leave, goes_on = NONE, None, False
            for first in ([True] if k == 0 else []) + ([False] if k == n - 1 else []):
                if (part, first) in states:
                    enter, leave, goes_on = states[part, first]
            own = slice(cut[k], cut[k + 1])
            chosen = repair(codes[own], enter, leave)
            rendered = pieces(texts[own], chosen, not goes_on)
            if enter != NONE and chosen[0][1] != "merge":  # ends the turn that was left open in the part before
                rendered[0] = "\n<|end|>\n" + rendered[0]
            ways += chosen
            made += rendered
        cost, action, role_made, between = zip(*ways)
        return table.select(["conv_id", "turn", "role", "part", "seq"]).append_column("action", pa.array(action)).append_column(
            "out_role", pa.array([ROLES[r] for r in role_made])).append_column("inserted", pa.array([ROLES[r] or None for r in between], pa.string())).append_column(
            "cost", pa.array(cost, pa.int64())).append_column("piece", pa.array(made, pa.string()))

    kinds = {c: dealt.schema[c].dataType.simpleString() for c in ("conv_id", "turn", "role")}
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", part int, seq long, action string, out_role string, inserted string, cost long, piece string"
    return dealt.groupBy("part").applyInArrow(formatted, schema)
