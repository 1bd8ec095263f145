"""L4: second-order gradient boosting with an L2 leaf penalty and columns
sampled per tree, on histograms.

Features are cut once into equal-width bins (least and greatest value per
feature, one pass).  A tree grows level by level: one pass sums the gradients
and counts the rows by (node, feature, bin), each task adding up its rows first,
and the driver picks every node's split by the gain

    GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2),

a leaf's value being -G / (H + l2) (squared error: g = prediction - label,
h = 1).  A level's sums give the next level's totals, so the deepest level needs
no pass.  Of two children only the one with fewer rows is summed; the other's
sums are its parent's less these.  Gradients are summed as whole multiples of
2^-16, so sums do not depend on the order of rows, the differences are exact,
and equal gains go to the first feature and bin: the model is the same on any
partitioning.

What a pass shuffles is bounded by tasks x nodes x features x bins and what the
driver sees by nodes x features x bins, whatever the rows.  Predictions so far
are kept beside the rows and written down every ``KEEP`` trees, so a pass
replays at most that many trees and a lost executor no more.  The rows are kept
in blocks of at most ``BLOCK``: labels, predictions, samples (one bit a tree, so a
row id is hashed once per tree and not once per level) and bins are a cell each,
so that a pass hands blocks and not rows to its tasks.

Defined results: rows without a label take no part in fitting; a missing value
goes left of every split; a constant feature is never split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators.gram import TASKS_PER_CORE
from meterlake.session import scratch_path

BINS = 256
SCALE = 1 << 16
KEEP = 10
SAMPLE_OF = 1000
BLOCK = 4096
BLOCKS = "y binary, p binary, taken binary, bins binary"


@dataclass
class Tree:
    """Nodes in heap order (children of i: 2i + 1, 2i + 2): the feature split on
    (-1: leaf), the last bin that goes left, sums, the leaf value."""
    feature: np.ndarray
    bin: np.ndarray
    g: np.ndarray
    h: np.ndarray
    value: np.ndarray

    def node_of(self, bins: np.ndarray) -> np.ndarray:
        at, inner = np.zeros(len(bins), np.int64), self.feature >= 0
        if not inner.any():
            return at
        # Every row takes as many steps as the tree is deep; at a leaf it stays.
        here = np.arange(len(inner))
        left, feature = np.where(inner, 2 * here + 1, here), np.where(inner, self.feature, 0)
        last = np.where(inner, self.bin, BINS).astype(bins.dtype)
        flat, row = np.ascontiguousarray(bins).ravel(), np.arange(len(bins)) * bins.shape[1]
        for _ in range(int(np.flatnonzero(inner)[-1] + 1).bit_length()):
            at = left.take(at) + (flat.take(row + feature.take(at)) > last.take(at))
        return at


@dataclass
class Boosted:
    cols: list[str]
    low: np.ndarray
    width: np.ndarray
    base: float
    step: float
    trees: list[Tree] = field(default_factory=list)

    def score(self, bins: np.ndarray, trees: Sequence[Tree] | None = None) -> np.ndarray:
        out = np.zeros(len(bins))
        for t in self.trees if trees is None else trees:
            out += self.step * t.value[t.node_of(bins)]
        return out

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the prediction; the model is at most trees x 2^(depth + 1) nodes."""
        names = df.columns
        fields = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])
        width, base = len(self.cols), self.base
        model = df.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bins = np.column_stack([b.column(b.num_columns - width + i).to_numpy(zero_copy_only=False)
                                        for i in range(width)])
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:b.num_columns - width], pa.array(base + model.value.score(bins))],
                    names=[*names, out])

        return df.select("*", *self.binned()).mapInArrow(run, fields)

    def binned(self) -> list[Column]:
        return [bin_of(F.col(f"`{c}`").cast("double"), lo, w).alias(f"_b{i}")
                for i, (c, lo, w) in enumerate(zip(self.cols, self.low.tolist(), self.width.tolist()))]

    def nodes(self, spark) -> DataFrame:
        """tree, node, feature, bin, threshold, g, h, value per node (feature and
        threshold null at leaves)."""
        rows = []
        for k, t in enumerate(self.trees):
            for i in _present(t):
                j = int(t.feature[i])
                cut = None if j < 0 else float(self.low[j] + (t.bin[i] + 1) * self.width[j])
                rows.append((k, i, self.cols[j] if j >= 0 else None, int(t.bin[i]) if j >= 0 else None, cut,
                             float(t.g[i]), float(t.h[i]), float(t.value[i])))
        return spark.createDataFrame(rows, "tree int, node int, feature string, bin int, threshold double, "
                                           "g double, h double, value double")


def _present(t: Tree) -> list[int]:
    found, stack = [], [0]
    while stack:
        i = stack.pop()
        found.append(i)
        if t.feature[i] >= 0:
            stack += [2 * i + 2, 2 * i + 1]
    return sorted(found)


def bin_of(x: Column, low: float, width: float) -> Column:
    """Bin of a value; missing ones go below the first."""
    if width <= 0:
        return F.lit(0).cast("smallint")
    k = F.least(F.greatest(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(0)), F.lit(BINS - 1))
    return F.when(x.isNull() | F.isnan(x), F.lit(-1)).otherwise(k).cast("smallint")


def sampled_columns(n: int, tree: int, share: float, seed: int) -> list[int]:
    """The columns of a tree, the same everywhere: least hashes first."""
    def key(j: int) -> str:
        return hashlib.md5(f"{seed}:{tree}:{j}".encode()).hexdigest()

    return sorted(sorted(range(n), key=key)[:max(1, round(share * n))])


def samples(ids: list[int | None], trees: int, keep: int, share: float, seed: int) -> np.ndarray:
    """rows x words of ``keep`` trees, one bit a tree: whether the row is in the
    tree's sample, by a hash of both."""
    tails = [b"" if i is None else b":%d" % i for i in ids]
    out = np.zeros((len(ids), -(-trees // keep)), np.int32)
    for t in range(trees):
        head = f"{seed}:{t}".encode()
        mixed = np.frombuffer(b"".join([hashlib.md5(head + x).digest() for x in tails]), ">u4")[::4]
        out[:, t // keep] |= (mixed % SAMPLE_OF < round(share * SAMPLE_OF)).astype(np.int32) << t % keep
    return out


def best_split(g: np.ndarray, h: np.ndarray, l2: float, min_weight: float) -> tuple[float, int, int] | None:
    """(gain, feature place, bin) from histograms (features x (bins + 1), the
    first bin for missing values) of whole gradient sums and counts."""
    gl, hl = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
    gt, ht = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
    gr, hr = gt - gl, ht - hl

    def part(a, b):
        a = a / SCALE
        return a * a / (b + l2)

    gain = part(gl, hl) + part(gr, hr) - part(gt, ht)
    gain[(hl < min_weight) | (hr < min_weight)] = -np.inf
    at = int(gain.argmax())  # the first of equals
    j, k = divmod(at, gain.shape[1])
    return (float(gain[j, k]), j, k - 1) if gain[j, k] > 0 else None


def fit_gbt_l2(df: DataFrame, cols: Sequence[str], label: str = "label", id_col: str = "row_id", rounds: int = 100,
               step: float = 0.1, max_depth: int = 6, subsample: float = 0.8, col_sample: float = 0.8,
               l2: float = 1.0, min_weight: float = 1.0, seed: int = 42) -> Boosted:
    cols, d = list(cols), len(cols)
    spark = df.sparkSession
    y = F.col(f"`{label}`").cast("double")
    rows = df.where(y.isNotNull() & ~F.isnan(y))
    plain = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in cols]
    ends = rows.agg(F.avg(y).alias("y"), *[F.min(x).alias(f"a{i}") for i, x in enumerate(plain)],
                    *[F.max(x).alias(f"z{i}") for i, x in enumerate(plain)]).first()
    low = np.array([ends[f"a{i}"] or 0.0 for i in range(d)])
    high = np.array([ends[f"z{i}"] or 0.0 for i in range(d)])
    model = Boosted(cols, low, (high - low) / BINS, float(np.floor((ends["y"] or 0.0) * 1e6 + 0.5) / 1e6), step)

    def stored(table: DataFrame) -> DataFrame:
        path = scratch_path(spark, "boost-rows")
        # A reader's batch may hold a whole row group.
        table.write.option("parquet.block.size", 16 << 20).parquet(path)
        return spark.read.schema(BLOCKS).parquet(path)

    block, keep = BLOCK, KEEP  # as the driver has them
    data = stored(rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), y.alias("y"),
                              F.array(*model.binned()).alias("bins"))
                  .mapInArrow(_blocks(model.base, d, block, lambda ids: samples(ids, rounds, keep, subsample, seed)), BLOCKS))
    for t in range(rounds):
        kept = t // KEEP * KEEP
        if 0 < t == kept:
            data = stored(_advanced(data, model, model.trees[t - KEEP:], d))
        used = sampled_columns(d, t, col_sample, seed)
        model.trees.append(_grow(data, model, model.trees[kept:], used, d, max_depth, l2, min_weight))
    return model


def _blocks(base: float, d: int, block: int, taken: Callable[[list], np.ndarray]):
    """Rows (id, label, bins) packed into blocks; the prediction is ``base``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, block):
                b = whole.slice(at, block)
                bins = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                yield _cells(b.column(1).to_numpy(), np.full(len(bins), base), taken(b.column(0).to_pylist()),
                             bins.astype(np.int16))
    return run


def _cells(*parts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts],
                                      names=["y", "p", "taken", "bins"])


def _unpacked(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[np.ndarray, ...]]:
    """y, p, taken (rows x words of ``KEEP`` trees) and bins (rows x features) of every block."""
    for b in batches:
        for i in range(b.num_rows):
            y, p, taken, bins = (np.frombuffer(b.column(k)[i].as_buffer(), kind)
                                 for k, kind in enumerate((np.float64, np.float64, np.int32, np.int16)))
            yield y, p, taken.reshape(len(y), -1), bins.reshape(len(y), d)


def _advanced(data: DataFrame, model: Boosted, trees: list[Tree], d: int) -> DataFrame:
    """The blocks with the trees' part added to their predictions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for y, p, taken, bins in _unpacked(batches, d):
            yield _cells(y, p + model.score(bins, trees), taken, bins)

    return data.mapInArrow(run, BLOCKS)


def _grow(data: DataFrame, model: Boosted, replay: list[Tree], used: list[int], d: int, max_depth: int,
          l2: float, min_weight: float) -> Tree:
    size = 2 ** (max_depth + 1) - 1
    tree = Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.zeros(size), np.zeros(size))
    open_nodes, summed = [0], [0]
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for depth in range(max_depth):
        if not open_nodes:
            break
        above, sums = sums, _histograms(data, model, replay, tree, summed, used, d)
        for node in set(open_nodes) - set(summed):  # its sibling is summed: 1, 2 and so on are siblings
            sums[node] = tuple(a - b for a, b in zip(above[(node - 1) // 2], sums[node + 1 if node % 2 else node - 1]))
        following, summed = [], []
        for node in open_nodes:
            g, h = sums[node]
            if depth == 0:
                tree.g[0], tree.h[0] = g[0].sum() / SCALE, h[0].sum()
            split = best_split(g, h, l2, min_weight)
            if split is None:
                continue
            _, j, k = split
            tree.feature[node], tree.bin[node] = used[j], k
            left = 2 * node + 1
            gl, hl = g[j, :k + 2].sum(), h[j, :k + 2].sum()
            tree.g[left], tree.h[left] = gl / SCALE, hl
            tree.g[left + 1], tree.h[left + 1] = (g[j].sum() - gl) / SCALE, h[j].sum() - hl
            following += [left, left + 1]
            summed.append(left if tree.h[left] <= tree.h[left + 1] else left + 1)
        open_nodes = following
    tree.value = np.where(tree.feature < 0, -tree.g / (tree.h + l2), 0.0)
    return tree


def _histograms(data: DataFrame, model: Boosted, replay: list[Tree], tree: Tree, open_nodes: list[int],
                used: list[int], d: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """node -> (gradient sums, row counts) of the sample of the tree after the
    model's, each features x (bins + 1), in one pass: a task sums its rows, the
    next stage the tasks."""
    slots, wide = np.full(len(tree.feature), -1), BINS + 1
    slots[open_nodes] = np.arange(len(open_nodes))
    cells = len(used) * wide
    word, bit = divmod(len(model.trees), KEEP)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((len(used), len(open_nodes) * wide), np.int64)
        h = np.zeros((len(used), len(open_nodes) * wide), np.int64)
        for y, p, taken, bins in _unpacked(batches, d):
            slot = slots[tree.node_of(bins)]
            live = np.flatnonzero((slot >= 0) & (taken[:, word] >> bit & 1 > 0))
            if not live.size:
                continue
            bins, first = bins.take(live, axis=0), slot[live] * wide + 1
            p = p[live] + model.score(bins, replay)
            grad = np.rint((p - y[live]) * SCALE).astype(np.int64)
            # Sums of whole numbers: split where the doubles of bincount might not be exact.
            exact = max(int(grad.max()), -int(grad.min())) * len(grad) < 1 << 53
            parts = [(grad.astype(float), 1)] if exact else [(grad >> 24, 1 << 24), (grad & 0xFFFFFF, 1)]
            by_feature = np.ascontiguousarray(bins.T)
            for i, j in enumerate(used):
                at = first + by_feature[j]
                for part, unit in parts:
                    g[i] += np.bincount(at, part, g.shape[1]).astype(np.int64) * unit
                h[i] += np.bincount(at, minlength=h.shape[1])
        # Cells in the order node, feature, bin.
        g, h = (x.reshape(len(used), len(open_nodes), wide).swapaxes(0, 1).ravel() for x in (g, h))
        some = np.flatnonzero(h)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(g[some]), pa.array(h[some])],
                                         names=["cell", "g", "h"])

    cores = data.sparkSession.sparkContext.defaultParallelism
    parts = data.coalesce(TASKS_PER_CORE * cores).mapInArrow(partial, "cell long, g long, h long")
    rows = parts.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    g, h = np.zeros(len(open_nodes) * cells, np.int64), np.zeros(len(open_nodes) * cells, np.int64)
    at = rows.column("cell").to_numpy()
    g[at], h[at] = rows.column("g").to_numpy(), rows.column("h").to_numpy()
    shape = (len(open_nodes), len(used), wide)
    g, h = g.reshape(shape), h.reshape(shape)
    return {node: (g[i], h[i]) for i, node in enumerate(open_nodes)}
