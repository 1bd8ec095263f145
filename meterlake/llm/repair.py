"""Conversation structure repair (operator 13).

A conversation is well formed if its roles' initials read ``(s?(ua)+)?``.  The
edit lattice of a conversation has a node per (rows read, state), the state
being nothing yet, after the system turn, after a user turn, after an assistant
turn; its edges are

    K  keep the row                      0
    R  give it the role that is due      1  (user or assistant)
    D  delete it                         2  (the only edge of a blank or duplicate row)
    I  insert an empty turn that is due  5

and K and R of a truncated row cost 5 more.  The cheapest path is found by
bidirectional Dijkstra: a forward and a reverse heap grow towards each other
until no crossing of equal cost can be missing; what both sides settled holds
all cheapest paths, and the least audit (the edges' letters in ASCII order) is
read off by walking only edges on these.  Roles follow from the letters, so an
audit is one repair.

At scale each row is two letters (initial, fault); rows are searched in blocks
of ``BLOCK``, for every pair of a state before and a state after, and
a second lattice, whose steps are blocks and whose edges are these pairs, is
searched the same way for each conversation.  Insertions stand before a row of
their block or at the conversation's end, so audits of one block never are
prefixes of each other and comparing blocks in turn compares audits.  A
conversation of a third of all rows is spread until its texts are written out in
order, which one task streams without holding them.

Faults, first that counts: ``b`` blank (no character but ASCII white space),
``d`` duplicate (role and text of an earlier row), ``t`` truncated (the last
such character is none of ``.!?``), ``k`` none.

Defined results: null role and null text are one space; a null conv_id is a
conversation of its own; null turns come first, rows of one turn by role and
text (the first 64 characters of each, then their hash); a role whose initial
is not s, u or a (an empty one too) cannot be kept; very long texts pass as
single cells; an empty table has no edits; columns other than conv_id, turn,
role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from math import inf

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import col, stored
from meterlake.llm.order import numbered, text_order

BLOCK = 256
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
INSERT, DELETE, REROLE, CUT = 5, 2, 1, 5
SPACE = " \t\n\x0b\x0c\r"

Node = tuple[int, int]
Edges = Callable[[Node], list[tuple[Node, int, object]]]  # (neighbour, cost, label)


# ---- search ---------------------------------------------------------------

def least_path(out: Edges, into: Edges, source: Node, target: Node) -> tuple[int, list[Node], list] | None:
    """(cost, nodes, labels) of the cheapest path whose labels come first.

    Free edges must lead from step k to k + 1, and two edges of a node that
    begin cheapest paths must differ in label."""
    cost = ({source: 0}, {target: 0})
    heaps = [[(0, source[0], source)], [(0, -target[0], target)]]
    settled: tuple[dict, dict] = ({}, {})  # in order of settling
    best = 0 if source == target else inf
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        side = int(heaps[1][0][0] < heaps[0][0][0])
        c, _, node = heappop(heaps[side])
        if node in settled[side]:
            continue
        settled[side][node] = c
        for near, w, _ in (out, into)[side](node):
            if c + w < cost[side].get(near, inf):
                cost[side][near] = c + w
                heappush(heaps[side], (c + w, (1, -1)[side] * near[0], near))
            best = min(best, c + w + cost[1 - side].get(near, inf))
    if best == inf:
        return None
    ahead, behind = settled
    # Forward nodes on a cheapest path: from the crossings backwards.
    useful: set[Node] = set()

    def goes_on(c: int, near: Node, w: int) -> bool:
        return c + w + behind.get(near, inf) == best or (near in useful and ahead[near] == c + w)

    for node, c in reversed(ahead.items()):
        if (node == target and c == best) or any(goes_on(c, near, w) for near, w, _ in out(node)):
            useful.add(node)
    nodes, labels, c = [source], [], 0
    while nodes[-1] != target:
        near, w, label = min(((n, w, x) for n, w, x in out(nodes[-1]) if goes_on(c, n, w)), key=lambda e: e[2])
        nodes.append(near)
        labels.append(label)
        c += w
    return best, nodes, labels


def due(state: int) -> int:
    """The state after the turn that is due."""
    return ASSISTANT if state == USER else USER


@lru_cache(maxsize=None)  # 4 states x 16 codes
def row_edges(state: int, code: str) -> tuple[tuple[int, int, str], ...]:
    """(state after, cost, letter) of a row, ``code`` its initial and fault."""
    edges = [(state, DELETE, "D")]
    if code[1] not in "bd":
        extra = CUT if code[1] == "t" else 0
        edges.append((due(state), REROLE + extra, "R"))
        if code[0] == "sua"[due(state) - 1]:
            edges.append((due(state), extra, "K"))
        elif code[0] == "s" and state == START:
            edges.append((SYSTEM, extra, "K"))
    return tuple(edges)


def lattice(codes: list[str]) -> tuple[Edges, Edges]:
    """Edges of a block's lattice, forward and reverse."""
    n = len(codes)

    def out(node: Node):
        k, s = node
        return [] if k == n else [((k, due(s)), INSERT, "I")] + [
            ((k + 1, t), w, x) for t, w, x in row_edges(s, codes[k])]

    def into(node: Node):
        k, s = node
        found = [((k, t), INSERT, "I") for t in STATES if k < n and due(t) == s]
        return found + [((k - 1, t), w, x) for t in STATES if k for u, w, x in row_edges(t, codes[k - 1]) if u == s]

    return out, into


@lru_cache(maxsize=4096)
def block_paths(codes: str, first: bool) -> list[tuple[int, int, int, int, str]]:
    """(state before, state after, cost, rank of the audit in the block, audit)
    for every pair of states that a block joins; ``first``: the block begins
    its conversation."""
    rows = [codes[i:i + 2] for i in range(0, len(codes), 2)]
    out, into = lattice(rows)
    found = []
    for a in STATES[:1] if first else STATES:
        for z in STATES:
            path = least_path(out, into, (0, a), (len(rows), z))
            if path:
                found.append((a, z, path[0], "".join(path[2])))
    rank = {audit: k for k, audit in enumerate(sorted({f[3] for f in found}))}
    return [(a, z, c, rank[audit], audit) for a, z, c, audit in found]


def closing(state: int) -> str:
    """Insertions at a conversation's end."""
    return {SYSTEM: "II", USER: "I"}.get(state, "")


def joined(blocks: list[list[tuple[int, int, int, int]]]) -> list[tuple[int, int]]:
    """(state before, state after) of each block of a conversation, ``blocks``
    holding the (before, after, cost, rank) of its pairs."""
    n = len(blocks)
    step, back = [], []
    for pairs in blocks:
        step.append({s: [p for p in pairs if p[0] == s] for s in STATES})
        back.append({s: [p for p in pairs if p[1] == s] for s in STATES})
    end = (n + 1, START)

    def out(node: Node):
        k, s = node
        if k < n:
            return [((k + 1, z), c, rank) for _, z, c, rank in step[k][s]]
        return [(end, INSERT * len(closing(s)), 0)] if k == n else []

    def into(node: Node):
        k, s = node
        if node == end:
            return [((n, t), INSERT * len(closing(t)), 0) for t in STATES]
        return [((k - 1, a), c, rank) for a, _, c, rank in back[k - 1][s]] if k else []

    _, nodes, _ = least_path(out, into, (0, START), end)
    return [(a[1], z[1]) for a, z in zip(nodes[:-2], nodes[1:-1])]


# ---- Spark ----------------------------------------------------------------

def coded(turns: DataFrame) -> DataFrame:
    """conv_id, pos, block, turn, role, text, code per row."""
    rows = turns.select(col(turns, "conv_id").cast("long").alias("conv_id"),
                        col(turns, "turn").cast("long").alias("turn"),
                        *[F.coalesce(col(turns, c), F.lit(" ")).alias(c) for c in ("role", "text")])
    keys = [F.substring("role", 1, 64), text_order()[0], F.xxhash64("role", "text"), text_order()[2]]
    rows = numbered(rows.select("*", *[k.alias(f"o{i}") for i, k in enumerate(keys)]), "conv_id",
                    [F.col("turn").asc_nulls_first(), *[F.col(f"o{i}") for i in range(4)]], "repair-places")
    bare = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    mark = F.md5(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")),
                             F.length("role").cast("string"), F.concat("role", "text")))
    rows = rows.select("conv_id", "pos", F.floor(F.col("pos") / BLOCK).alias("block"), "turn", "role", "text",
                       F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
                       (bare == "").alias("blank"), F.right(bare, F.lit(1)).isin(".", "!", "?").alias("whole"),
                       mark.alias("mark"))
    again = rows.groupBy("mark").agg(F.min("pos").alias("before"), F.count("*").alias("n")).where("n > 1")
    rows = rows.join(again.select("mark", "before"), "mark", "left")
    fault = (F.when(F.col("blank"), "b").when(F.col("pos") > F.col("before"), "d")
             .when(~F.col("whole"), "t").otherwise("k"))
    return rows.select("conv_id", "pos", "block", "turn", "role", "text",
                       F.concat("initial", fault).alias("code"))


PAIRS = "array<struct<a: int, z: int, cost: long, rank: int, audit: string>>"
PAIR = pa.struct([("a", pa.int32()), ("z", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()),
                  ("audit", pa.string())])
PATH = pa.struct([("block", pa.int64()), ("a", pa.int32()), ("z", pa.int32())])


def _batches(schema: pa.Schema, rows: Iterator[tuple], most: int = 4096,
             most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size (texts counted)."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= most or size >= most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, block, audit: the edits of each block's rows on the cheapest
    path of their conversation, and the state ``a`` before them."""
    blocks = rows.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("c"))
    blocks = blocks.select("conv_id", "block", F.array_join(F.transform("c", lambda x: x["code"]), "").alias("codes"))
    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("pairs", pa.list_(PAIR))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in PAIR]
        for batch in batches:
            yield from _batches(schema, ((c, b, [dict(zip(names, p)) for p in block_paths(codes, b == 0)])
                                         for c, b, codes in zip(*[x.to_pylist() for x in batch.columns])))

    paths = stored(blocks.mapInArrow(search, f"conv_id long, block long, pairs {PAIRS}"), "repair-paths")
    light = F.transform("pairs", lambda p: F.struct(p["a"], p["z"], p["cost"], p["rank"]))
    whole = paths.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", light.alias("p")))).alias("b"))
    schema2 = pa.schema([("conv_id", pa.int64()), ("path", pa.list_(PATH))])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(conv, blocks):
            pairs = [[tuple(p.values()) for p in b["p"]] for b in blocks]
            return conv, [{"block": b["block"], "a": a, "z": z} for b, (a, z) in zip(blocks, joined(pairs))]

        for batch in batches:
            yield from _batches(schema2, (one(*x) for x in zip(*[x.to_pylist() for x in batch.columns])))

    chosen = whole.mapInArrow(choose, "conv_id long, path array<struct<block: long, a: int, z: int>>")
    chosen = chosen.select("conv_id", F.explode("path").alias("c")).select("conv_id", "c.*")
    on = paths["conv_id"].eqNullSafe(chosen["conv_id"]) & (paths["block"] == chosen["block"])
    took = F.filter("pairs", lambda p: (p["a"] == chosen["a"]) & (p["z"] == chosen["z"]))
    return paths.join(chosen, on).select(paths["conv_id"], paths["block"], chosen["a"], took[0]["audit"].alias("audit"))


EDIT = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                  ("text", pa.string()), ("turn", pa.int64()), ("code", pa.string())])
EDIT_TYPE = "conv_id long, place long, edit string, role string, text string, turn long, code string"


def edits(turns: DataFrame) -> DataFrame:
    """One row per edit of the conversations (conv_id, turn, role, text):
    conv_id, place (from 0), edit, role and text after the edit (of a deleted row: as
    it was), turn and code of the row edited (null for an insertion).

    A conversation's rows lie in one partition in order of ``place``."""
    rows = stored(coded(turns), "repair-rows")
    plan = audits(rows).select("conv_id", "block", F.lit(-1).cast("long").alias("pos"),
                               F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                               F.col("audit").alias("text"), F.lit(None).cast("string").alias("code"))
    both = rows.select(plan.columns).unionByName(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def steps():
            at, state, place, letters = None, START, 0, iter(())
            said = ("", "system", "user", "assistant")

            def finish():
                nonlocal state, place
                for x in closing(state):
                    state = due(state)
                    yield (at[0], place, x, said[state], "", None, None)
                    place += 1

            for batch in batches:
                for conv, block, pos, turn, role, text, code in zip(*[c.to_pylist() for c in batch.columns]):
                    if at is None or at[0] != conv:
                        if at is not None:
                            yield from finish()
                        at, state, place = (conv,), START, 0
                    if code is None:  # the block's audit comes before its rows
                        letters = iter(text)
                        continue
                    while (x := next(letters)) == "I":
                        state = due(state)
                        yield (conv, place, x, said[state], "", None, None)
                        place += 1
                    if x != "D":
                        state = SYSTEM if x == "K" and code[0] == "s" else due(state)
                    yield (conv, place, x, said[state] if x == "R" else role, text, turn, code)
                    place += 1
            if at is not None:
                yield from finish()

        yield from _batches(EDIT, steps())

    by = ["conv_id", "block", "pos"]
    return both.repartition("conv_id").sortWithinPartitions(*by).select(
        "conv_id", "block", "pos", "turn", "role", "text", "code").mapInArrow(run, EDIT_TYPE)


REPORT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in (
    "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()),
    ("repaired_sha256", pa.string())])
REPORT_TYPE = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'string'}" for f in REPORT)


def report(edited: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of each conversation in the rows of
    ``edits`` (as it gives them; a stored table has to be partitioned by conv_id
    and sorted by place again).  Texts are hashed as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversations():
            at = None
            for batch in batches:
                for conv, _, edit, role, text, turn, code in zip(*[c.to_pylist() for c in batch.columns]):
                    if at is None or at[0] != conv:
                        if at is not None:
                            yield done()
                        at, faults, audit, cost, illegal = (conv,), {"b": 0, "d": 0, "t": 0, "k": 0}, [], 0, 0
                        initial, turns, low, high, digest, empty = None, 0, None, None, hashlib.sha256(), True

                        def done():
                            gaps = 0 if low is None else high - low + 1 - turns
                            return (at[0], gaps, faults["b"], faults["d"], faults["t"], illegal, cost,
                                    "".join(audit), digest.hexdigest())

                    audit.append(edit)
                    cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
                    if code is not None:
                        faults[code[1]] += 1
                        cost += CUT if code[1] == "t" and edit != "D" else 0
                        illegal += initial is not None and initial + code[0] not in ("su", "ua", "au")
                        initial = code[0]
                        if turn is not None and turn != high:
                            turns, low, high = turns + 1, turn if low is None else low, turn
                    if edit != "D":
                        digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                        empty = False
            if at is not None:
                yield done()

        yield from _batches(REPORT, conversations())

    return edited.mapInArrow(run, REPORT_TYPE)


def repaired(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, role, text."""
    return edits(turns).where("edit <> 'D'").select("conv_id", "place", "role", "text")


def damaged(turns: DataFrame, kind: Column) -> DataFrame:
    """``turns`` with the fault that ``kind`` names: 0 drops the row, 1 empties
    its text, 2 takes out its ``.!?``, 3 repeats it, 4 makes its role user;
    others leave it.  Null role and text become one space."""
    rows = turns.select(col(turns, "conv_id").alias("conv_id"), col(turns, "turn").alias("turn"), kind.alias("kind"),
                        *[F.coalesce(col(turns, c), F.lit(" ")).alias(c) for c in ("role", "text")])
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    times = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")
