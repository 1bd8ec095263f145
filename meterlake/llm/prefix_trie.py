"""Prefix trie of conversations (operator 12).

A conversation is a key of 16 bytes a turn (MD5 of its role and text), so keys
sort as conversations do and the longest common prefix (LCP) of two keys, in
turns, is that of the conversations.  No trie is built: conversations are
sorted by key, and every node is a candidate prefix (a sorted place and a
depth) whose members are the interval around that place in which no LCP falls
below the depth.  Each candidate binary-searches the interval's left and right
ends by itself over a sparse table of range minima, without a stack and
without any other candidate.

At scale the sorted order is range-partitioned by (key, conversation), so a
first turn or a whole conversation that a third of all rows share is spread
over many tasks, and cut into blocks of bounded size.  A block has a sparse
table of its own; the blocks' edges have another (one LCP between neighbouring
blocks and one within each block).  A candidate whose interval reaches a block's
edge searches on over the edges, and the pieces of such a node, at most one a
block, are summed.  Numbers that pass the driver: two a block.

Counts come from the intervals: members, leaves and saved bytes by prefix sums,
the smallest member by a second table of range minima, children and parents by
the left end at one turn less.

Defined results: null role and null text are empty; a conversation without
turns is a member of the root; rows of equal conv_id and turn are turns in the
order of role and text (its first 64 characters, then its hash); a null conv_id
is no conversation; equal conversations are members of the same nodes; an empty
table has no node, not even a root; very long texts enter by their hash and
length only; a conversation's key is one cell (16 bytes a turn, 1e8 turns at
most); columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import col, stored
from meterlake.llm.order import numbered, text_order

DIGEST = 16
BLOCK_SEQUENCES = 4096
BLOCK_BYTES = 4 << 20
CHUNK_TURNS = 256


# ---- conversations to keys ------------------------------------------------

def placed(turns: DataFrame) -> DataFrame:
    """conv_id, pos, digest, size (bytes of the text) per turn; pos from 0 by
    turn, null first."""
    rows = turns.select(col(turns, "conv_id").cast("long").alias("conv_id"), col(turns, "turn").alias("turn"),
                        F.coalesce(col(turns, "role"), F.lit("")).alias("role"),
                        F.coalesce(col(turns, "text"), F.lit("")).alias("text")).where("conv_id IS NOT NULL")
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))
    light = rows.select("conv_id", "turn", F.substring("role", 1, 64).alias("role"),
                        *[c.alias(f"o{i}") for i, c in enumerate(text_order())],
                        digest.alias("digest"), F.octet_length("text").cast("long").alias("size"))
    out = numbered(light, "conv_id", [F.col("turn").asc_nulls_first(), F.col("role"),
                                      *[F.col(f"o{i}") for i in range(3)]], "turn-places")
    return out.select("conv_id", "pos", "digest", "size")


def branched(turns: DataFrame, shared: Column, base: Column) -> DataFrame:
    """conv_id, pos, digest, size of every conversation whose first ``shared``
    turns are those of conversation ``base`` (both Columns over conv_id).  A
    conversation left without turns has one row with a null digest."""
    rows = stored(placed(turns), "turn-digests")
    ids = rows.where("pos = 0").select("conv_id")
    wanted = ids.select(F.col("conv_id").alias("to"), base.alias("conv_id"), shared.alias("n")).where("n > 0")
    taken = rows.join(wanted, "conv_id").where(F.col("pos") < F.col("n")).select(
        F.col("to").alias("conv_id"), "pos", "digest", "size")
    own = rows.where(F.col("pos") >= shared)
    none = ids.select("conv_id", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("digest"),
                      F.lit(0).cast("long").alias("size"))
    return taken.unionByName(own).unionByName(none)


def sequences(rows: DataFrame) -> DataFrame:
    """member, key, sizes per conversation of rows (conv_id, pos, digest, size);
    rows with a null digest only say that the conversation exists.  Turns meet
    in chunks first, so a conversation of very many turns is few pieces."""
    turn = F.when(F.col("digest").isNotNull(), F.struct("pos", "digest", "size"))
    chunks = rows.groupBy("conv_id", F.floor(F.col("pos") / CHUNK_TURNS).alias("chunk")).agg(
        F.array_sort(F.collect_list(turn)).alias("t"))
    chunks = chunks.select("conv_id", F.struct(
        "chunk", F.array_join(F.transform("t", lambda x: x["digest"]), "").alias("key"),
        F.transform("t", lambda x: x["size"]).alias("sizes")).alias("c"))
    whole = chunks.groupBy("conv_id").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    return whole.select(F.col("conv_id").alias("member"),
                        F.unhex(F.array_join(F.transform("cs", lambda c: c["key"]), "")).alias("key"),
                        F.flatten(F.transform("cs", lambda c: c["sizes"])).alias("sizes"))


# ---- sorted blocks --------------------------------------------------------

def lcp(a: bytes, b: bytes) -> int:
    """Longest common prefix, in turns."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax()) // DIGEST


ITEM = pa.struct([("key", pa.binary()), ("sizes", pa.list_(pa.int64())), ("n", pa.int64()),
                  ("first", pa.int64()), ("ends", pa.string())])
BLOCK = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("edge", pa.int64()), ("within", pa.int64()),
                   ("first_key", pa.binary()), ("last_key", pa.binary()), ("items", pa.list_(ITEM))])
BLOCK_TYPE = ("part long, block long, edge long, within long, first_key binary, last_key binary, "
              "items array<struct<key: binary, sizes: array<long>, n: long, first: long, ends: string>>")


def blocks(seqs: DataFrame, most: int = BLOCK_SEQUENCES, most_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of sorted sequences, equal ones collapsed: ``n`` members,
    the ``first`` of them and all of them as text (``ends``).  ``edge`` is the
    LCP with the block before in the same partition (null for the first),
    ``within`` that of the block's first and last keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        items: list[dict] = []
        state = {"bytes": 0, "block": 0, "last": None}

        def flush() -> pa.RecordBatch:
            for x in items:
                x["ends"] = ",".join(x["ends"])
            a, z = items[0]["key"], items[-1]["key"]
            out = pa.RecordBatch.from_pylist([{
                "part": part, "block": state["block"], "within": lcp(a, z), "first_key": a, "last_key": z,
                "edge": None if state["last"] is None else lcp(state["last"], a), "items": items}], schema=BLOCK)
            state.update(bytes=0, block=state["block"] + 1, last=z)
            items.clear()
            return out

        for batch in batches:
            for member, key, sizes in zip(*[c.to_pylist() for c in batch.columns]):
                new = not items or items[-1]["key"] != key
                if items and (state["bytes"] >= most_bytes or (new and len(items) >= most)):
                    yield flush()
                    new = True
                if new:
                    items.append({"key": key, "sizes": sizes, "n": 0, "first": member, "ends": []})
                    state["bytes"] += 2 * len(key)
                items[-1]["n"] += 1
                items[-1]["ends"].append(str(member))
                state["bytes"] += len(items[-1]["ends"][-1]) + 1
        if items:
            yield flush()

    by = ["key", "member"]
    order = seqs.select("member", "key", "sizes").repartitionByRange(*by).sortWithinPartitions(*by)
    return stored(order.mapInArrow(run, BLOCK_TYPE), "trie-blocks")


def edges(blocked: DataFrame) -> tuple[dict[int, int], np.ndarray, np.ndarray]:
    """(number of the first block of each partition, LCPs left of every block,
    LCPs within every block), blocks in sorted order."""
    ends = blocked.groupBy("part").agg(F.min(F.struct("block", "first_key")).alias("a"),
                                       F.max(F.struct("block", "last_key")).alias("z"))
    # One row a range partition, with two keys.
    before = ends.select("part", F.col("a.first_key").alias("key"),
                         F.lag("z.last_key").over(Window.orderBy("part")).alias("earlier"))

    @F.pandas_udf("long")
    def common(key, earlier):
        return key.combine(earlier, lambda a, b: -1 if b is None else lcp(bytes(a), bytes(b))).astype("int64")

    across = {r.part: r.n for r in before.select("part", common("key", "earlier").alias("n")).collect()}
    rows = sorted(blocked.select("part", "block", "edge", "within").collect())
    start: dict[int, int] = {}
    for k, r in enumerate(rows):
        start.setdefault(r.part, k)
    left = np.array([across[r.part] if r.edge is None else r.edge for r in rows], np.int64)
    return start, left, np.array([r.within for r in rows], np.int64)


# ---- intervals ------------------------------------------------------------

class RangeMin:
    """Sparse table of range minima: level k holds the minima of 2^k values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 1 << len(self.levels) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))
        self.n = len(values)

    def least(self, a: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Minimum of values a..z, both included."""
        k = np.frexp(z - a + 1)[1] - 1
        out = np.empty(len(a), self.levels[0].dtype)
        for level in np.unique(k):
            at = k == level
            out[at] = np.minimum(self.levels[level][a[at]], self.levels[level][z[at] - (1 << level) + 1])
        return out

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Largest r >= at with values at+1..r all >= depth."""
        pos = at.copy()
        for k in reversed(range(len(self.levels))):
            step, level = 1 << k, self.levels[k]
            ok = pos + step < self.n
            ok &= level[np.where(ok, pos + 1, 0)] >= depth
            pos += step * ok
        return pos

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Least l <= at with values l+1..at all >= depth."""
        pos = at.copy()
        for k in reversed(range(len(self.levels))):
            step, level = 1 << k, self.levels[k]
            ok = pos >= step
            ok &= level[np.where(ok, pos - step + 1, 0)] >= depth
            pos -= step * ok
        return pos


class Edges:
    """The blocks' edges: edge b lies left of block b; LCPs of edges b-1 and b
    are bounded by both and by what block b-1 has in common."""

    def __init__(self, left: np.ndarray, within: np.ndarray):
        self.at = left
        between = np.minimum(np.minimum(left[:-1], left[1:]), within[:-1]) if len(left) else left
        self.table = RangeMin(np.concatenate([[-1], between]).astype(np.int64))

    def lcp(self, block: int) -> int:
        """LCP left of a block; -1 at both ends of the order."""
        return int(self.at[block]) if 0 < block < len(self.at) else -1


NODE = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
                  ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                  ("saved", pa.int64()), ("bytes", pa.int64()), ("top", pa.int64()), ("last", pa.int64()),
                  ("parent_top", pa.int64()), ("block", pa.int64()), ("ends", pa.string())])
NODE_TYPE = ", ".join(f"{f.name} {'string' if f.name == 'ends' else 'long'}" for f in NODE)


def block_nodes(number: int, items: pa.StructArray, edges: Edges) -> pa.RecordBatch:
    """Nodes and pieces of nodes of one block.  ``top`` is null for a node that
    lies within the block, else the first edge that it spans, ``last`` the last
    one; ``parent_top`` is set where the parent spans edges."""
    keys = items.field("key").to_pylist()
    sizes, ends = items.field("sizes"), items.field("ends")
    m = len(keys)
    length = np.array([len(k) // DIGEST for k in keys], np.int64)
    common = np.array([-1, *[lcp(a, b) for a, b in zip(keys, keys[1:])]], np.int64)
    table, firsts = RangeMin(common), RangeMin(items.field("first").to_numpy())
    to_left, to_right = edges.lcp(number), edges.lcp(number + 1)

    # Candidates: at each place the depths that its left neighbour lacks.
    low = common + 1
    count = np.maximum(length - low + 1, 0)
    off = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(np.arange(m), count)
    depth = low[at] + np.arange(len(at)) - off[at]
    left, right = table.left(at, depth), table.right(at, depth)
    spans_left = (left == 0) & (depth <= to_left)
    spans_right = (right == m - 1) & (depth <= to_right)
    spans = spans_left | spans_right

    def between(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[right + 1] - total[left]

    n = between(items.field("n").to_numpy())
    following = np.concatenate([common[1:], [to_right]])
    leaves = between((following < length).astype(np.int64))
    flat, base = pc.list_flatten(sizes).to_numpy(), np.cumsum(length) - length
    last_bytes = np.where(depth > 0, flat[base[at] + np.maximum(depth, 1) - 1] if len(flat) else 0, 0)
    # Candidates stand in preorder, so a subtree is a run of them.
    value = np.concatenate([[0], np.cumsum(np.where(spans, 0, (n - 1) * last_bytes))])
    here = off[left] + depth - low[left]
    saved = value[off[right + 1]] - value[here]

    above = table.left(at, np.maximum(depth - 1, 0))
    parent = off[above] + depth - 1 - low[above]
    has = depth > 0
    children = np.zeros(len(at), np.int64)
    np.add.at(children, parent[has & ~spans_left], 1)

    first_edge = np.where(spans_left, number, number + 1)
    top, last = np.full(len(at), -1), np.full(len(at), -1)
    top[spans] = edges.table.left(first_edge[spans], depth[spans])
    end_edge = np.where(spans_right, number + 1, number)
    last[spans] = edges.table.right(end_edge[spans], depth[spans])
    first = firsts.least(left, right)

    def where(values: np.ndarray, keep: np.ndarray) -> pa.Array:
        return pa.array(values, pa.int64(), mask=~keep)

    parent = np.where(has, parent, 0)
    in_edge = has & spans[parent]
    whole = depth == length[at]
    named = pc.if_else(pa.array(whole), ends.take(pa.array(at)), pa.scalar(None, pa.string()))
    return pa.RecordBatch.from_arrays([
        pa.array(first), pa.array(depth), where(first[parent], has & ~in_edge), pa.array(n), pa.array(children),
        pa.array(leaves), pa.array(saved), pa.array(last_bytes), where(top, spans), where(last, spans),
        where(top[parent], in_edge), pa.array(np.full(len(at), number)), named], schema=NODE)


# ---- the trie -------------------------------------------------------------

def _chunk_hashes(chunks: DataFrame) -> DataFrame:
    """top, depth, ends_sha256 of rows (top, depth, block, ends): the hash runs
    over a node's pieces as they stream by, whatever their number."""
    schema = pa.schema([("top", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for top, depth, ends in zip(*[c.to_pylist() for c in batch.columns]):
                if node != (top, depth):
                    if node:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (top, depth), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ends.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d)) for d in done], schema=schema)
        if node:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*node, digest.hexdigest())))], schema=schema)

    # A node's pieces are one row a block of up to 4 MB.
    rows = chunks.repartition("top", "depth").sortWithinPartitions("top", "depth", "block")
    return rows.select("top", "depth", "ends").mapInArrow(run, "top long, depth long, ends_sha256 string")


def trie(seqs: DataFrame, most: int = BLOCK_SEQUENCES, most_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per node of the trie of ``seqs`` (member, key, sizes): conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    spark = seqs.sparkSession
    blocked = blocks(seqs, most, most_bytes)
    start, left, within = edges(blocked)
    shared = spark.sparkContext.broadcast((start, left, within))  # two numbers a block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, left, within = shared.value
        edge = Edges(left, within)
        for batch in batches:
            for part, block, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                yield block_nodes(start[part] + block, items.values, edge)

    # Few rows of up to a few MB each: one a batch is enough.
    nodes = stored(blocked.select("part", "block", "items").mapInArrow(run, NODE_TYPE), "trie-nodes")
    inner, pieces = nodes.where("top IS NULL"), nodes.where("top IS NOT NULL")
    spine = pieces.groupBy("top", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        *[F.max(c).alias(c) for c in ("bytes", "last", "parent_top")])
    spine = stored(spine.withColumn("value", (F.col("n_convs") - 1) * F.col("bytes")), "trie-spine")
    # Nodes that begin at one edge, deepest first, and sums over the edges.
    deeper = Window.partitionBy("top").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    upto = Window.orderBy("edge").rowsBetween(Window.unboundedPreceding, 0)
    at_edge = spine.groupBy(F.col("top").alias("edge")).agg(F.sum("value").alias("value"))
    sums = stored(spark.range(len(left)).select(F.col("id").alias("edge")).join(at_edge, "edge", "left")
                  .select("edge", F.coalesce(F.sum("value").over(upto), F.lit(0)).alias("upto")), "trie-edges")
    hashes = _chunk_hashes(pieces.where("ends IS NOT NULL").select("top", "depth", "block", "ends"))
    up = spine.select(F.col("top").alias("parent_top"), (F.col("depth") + 1).alias("depth"),
                      F.col("conv_id").alias("parent_in_spine"))
    nothing = F.sha2(F.lit(""), 256)
    crossing = (spine.withColumn("deeper", F.sum("value").over(deeper))
                .join(sums.select(F.col("edge").alias("top"), F.col("upto").alias("before")), "top")
                .join(sums.select(F.col("edge").alias("last"), F.col("upto").alias("after")), "last")
                .join(hashes, ["top", "depth"], "left").join(up, ["parent_top", "depth"], "left")
                .select("conv_id", "depth", F.col("parent_in_spine").alias("parent_conv_id"), "n_convs", "n_children",
                        "n_leaves", (F.col("saved") + F.col("deeper") + F.col("after") - F.col("before")).alias("saved"),
                        F.coalesce("ends_sha256", nothing).alias("ends_sha256")))
    inside = inner.withColumn("ends_sha256", F.sha2(F.coalesce("ends", F.lit("")), 256))
    rows = inside.where("parent_top IS NULL").select(crossing.columns).unionByName(
        inside.where("parent_top IS NOT NULL").join(up, ["parent_top", "depth"])
        .withColumn("parent_conv_id", F.col("parent_in_spine")).select(crossing.columns)).unionByName(crossing)
    return rows.withColumnRenamed("saved", "saved_tokens")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of whole conversations (conv_id, turn, role, text)."""
    return trie(sequences(placed(turns)))
