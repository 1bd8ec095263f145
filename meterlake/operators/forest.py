"""L3: random forest on histograms, its rows dealt to the trees.

1. Features are cut at MLlib's candidate thresholds (``MAX_BINS`` bins from a
   sample of about ``SAMPLE_ROWS`` rows; all of them where a feature has few
   values) and the rows are written down once, in blocks of bytes.
2. Where a table has more than ``LOCAL_ROWS`` rows, the upper levels of all trees
   grow together, a pass a level: tasks add up weights and labels by (tree, node,
   feature, bin), the next stage picks the splits, the driver gets the splits.
3. A node of at most ``LOCAL_ROWS`` rows is a cell: its rows go to one task, which
   grows the rest of the branch level by level.  Trees take turns, so that no more
   than ``TURN_BYTES`` of rows are dealt at a time.

The driver holds what lies above the cells; the branches are a table.  For
scoring, trees are dealt into groups of at most ``GROUP_BYTES``, every group reads
the rows' bins once, and a row's sums are added by its place.

Every tree sees a bootstrap of all rows (Poisson weights by block and tree) and
every node its own sample of the features.  Labels are summed as whole multiples
of a power of two, so a tree does not depend on the order in which rows arrive.

Defined results: a row without a label is an error, as in MLlib; a missing value
goes right of every split; of equal gains the first feature and bin wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.operators.gram import TASKS_PER_CORE
from meterlake.session import scratch_path

MAX_BINS = 32
SAMPLE_ROWS = 10_000
BLOCK = 8192
LOCAL_ROWS = 200_000
TURN_BYTES = 1 << 30
GROUP_BYTES = 64 << 20
CELL_BYTES = 8 << 20
#: Histogram cells that a task holds for the nodes it looks at together.
SLAB = 1 << 17
TREES = "tree int, cell int, feature binary, cut binary, left binary, value binary, gain binary"
BLOCKS = "part int, block int, y binary, bins binary"


# ---- bins -----------------------------------------------------------------

def cut_points(values: np.ndarray, bins: int = MAX_BINS) -> np.ndarray:
    """MLlib's candidate thresholds of a feature: the middles between all its
    values, or, where these are more than ``bins``, about every 1 / ``bins`` of them."""
    there, count = np.unique(values[~np.isnan(values)] + 0.0, return_counts=True)
    middle = (there[:-1] + there[1:]) / 2
    if len(middle) < bins:
        return middle
    stride, seen = count.sum() / bins, np.cumsum(count)
    out, target = [], stride
    for i in range(1, len(there)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def thresholds(rows: DataFrame, n: int, d: int, seed: int) -> list[np.ndarray]:
    """Thresholds of every feature of ``rows`` (x: array of ``d`` doubles)."""
    some = rows.select("x") if n <= SAMPLE_ROWS else rows.select("x").sample(SAMPLE_ROWS / n, seed)
    x = some.toArrow().column("x").combine_chunks()
    x = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return [cut_points(x[:, j]) for j in range(d)]


def binned(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of rows x features: a value up to the first threshold has bin 0."""
    out = np.empty(x.shape, np.uint8)
    for j, c in enumerate(cuts):
        out[:, j] = np.searchsorted(c, x[:, j])
    return out


def vectors(df: DataFrame, features: str, *more) -> DataFrame:
    return df.select(*more, vector_to_array(F.col(features)).alias("x"))


def whole_labels(rows: DataFrame) -> tuple[int, int, float, float]:
    """(rows, features, mean, unit): sums of labels less the mean, in whole units, are exact."""
    y = F.col("y")
    s = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(y.isNull() | F.isnan(y), 1)).alias("bad"), F.avg("y").alias("y"),
                 F.min("y").alias("a"), F.max("y").alias("z"), F.max(F.size("x")).alias("d")).first()
    if not s["n"]:
        raise ValueError("no rows to fit on")
    if s["bad"]:
        raise ValueError("labels must not be null or NaN")
    far = max(s["z"] - s["y"], s["y"] - s["a"])
    return s["n"], s["d"], s["y"], 2.0 ** (math.frexp(far * s["n"] * 4)[1] - 52) if far > 0 else 1.0


def stored_blocks(rows: DataFrame, cuts: Sequence[np.ndarray], mean: float, unit: float) -> DataFrame:
    """``rows`` (y, x) as blocks of whole labels and bins, each with a name of its own."""
    d, spark, block = len(cuts), rows.sparkSession, BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for whole in batches:
            for first in range(0, whole.num_rows, block):
                b = whole.slice(first, block)
                y = np.rint((b.column(0).to_numpy() - mean) / unit)
                x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([at], pa.int32()), pa.array([y.tobytes()], pa.binary()),
                     pa.array([binned(x, cuts).tobytes()], pa.binary())], names=["part", "block", "y", "bins"])
                at += 1

    path = scratch_path(spark, "tree_rows")
    # A reader's batch may hold a whole row group.
    rows.select("y", "x").mapInArrow(run, BLOCKS).write.option("parquet.block.size", 16 << 20).parquet(path)
    return spark.read.schema(BLOCKS).parquet(path)


def _unpacked(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for b in batches:
        for i in range(b.num_rows):
            y = np.frombuffer(b.column(2)[i].as_buffer(), np.float64)
            yield b.column(0)[i].as_py(), b.column(1)[i].as_py(), y, np.frombuffer(b.column(3)[i].as_buffer(), np.uint8).reshape(len(y), d)


# ---- one branch -----------------------------------------------------------

@dataclass
class Nodes:
    """A branch: the feature split on (-1: leaf), the last bin that goes left, the
    place of the left child (the right one follows), the mean label in units, and
    by feature the gains times rows.  ``cell``: the branch that goes on at a leaf."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cell: np.ndarray | None = None

    def reached(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        at, inner = np.zeros(len(bins), np.int64), self.feature >= 0
        if not inner.any():
            return at
        left = np.where(inner, self.left, np.arange(len(inner)))  # at a leaf a row stays
        feature, cut = np.where(inner, self.feature, 0), np.where(inner, self.cut, 255).astype(np.uint8)
        flat, row = np.ascontiguousarray(bins).ravel(), np.arange(len(bins)) * bins.shape[1]
        while True:
            there = left.take(at) + (flat.take(row + feature.take(at)) > cut.take(at))
            if (there == at).all():
                return at
            at = there


def best_splits(hw: np.ndarray, hs: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, feature place, bin) of every node from weights and label sums (nodes x
    features x bins): label sums squared over weights, children less parent."""
    wl, sl = np.cumsum(hw, axis=2), np.cumsum(hs, axis=2)
    w, s = wl[:, :, -1:], sl[:, :, -1:]
    wl, sl = wl[:, :, :-1], sl[:, :, :-1]
    wr, sr = w - wl, s - sl
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = sl * sl / wl + sr * sr / wr - s * s / w
    gain[(wl < least) | (wr < least)] = -np.inf
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)  # the first of equals
    return flat[np.arange(len(flat)), at], at // gain.shape[2], at % gain.shape[2]


def grown(bins: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, k: int, least: int,
          rng: np.random.Generator, width: int = MAX_BINS) -> Nodes:
    """A branch of at most ``depth`` levels below its root, ``k`` features a node, at
    least ``least`` of the weight in a leaf.  Rows stand in the order of their
    nodes, so a level is a few passes over all of them."""
    d = bins.shape[1]
    flat, rows, start = np.ascontiguousarray(bins).ravel(), np.arange(len(y)), np.array([0, len(y)])
    w = w.astype(float)
    wy, gains, levels, base = w * y, np.zeros(d), [], 0
    while True:
        m, first, n = len(start) - 1, start[:-1], np.diff(start)
        here, weight = y[rows], w[rows]
        total, sums = np.add.reduceat(weight, first), np.add.reduceat(weight * here, first)
        feature, cut, gain = np.full(m, -1, np.int16), np.zeros(m, np.uint8), np.zeros(m)
        if len(levels) < depth:
            squares = np.add.reduceat(weight * here * here, first)
            open_ = np.flatnonzero((total >= 2 * least) & (np.minimum.reduceat(here, first) < np.maximum.reduceat(here, first)))
            step = max(1, SLAB // (k * width))
            for at in range(0, len(open_), step):
                nodes = open_[at:at + step]
                count = n[nodes]
                q = np.repeat(np.arange(len(nodes)), count)
                place = np.arange(len(q)) + np.repeat(first[nodes] - np.cumsum(count) + count, count)
                r = rows[place]
                chosen = np.sort(rng.random((len(nodes), d)).argsort(axis=1)[:, :k], axis=1)
                hw, hs = (np.empty((len(nodes), k, width)) for _ in range(2))
                wr, wyr, rd, cell = w[r], wy[r], r * d, q * width
                for i in range(k):
                    c = cell + flat.take(rd + chosen[:, i].take(q))
                    hw[:, i] = np.bincount(c, wr, len(nodes) * width).reshape(-1, width)
                    hs[:, i] = np.bincount(c, wyr, len(nodes) * width).reshape(-1, width)
                found, j, b = best_splits(hw, hs, least)
                some = found > 1e-12 * squares[nodes]
                feature[nodes[some]] = chosen[np.arange(len(nodes)), j][some]
                cut[nodes[some]], gain[nodes[some]] = b[some], found[some]
        split = np.flatnonzero(feature >= 0)
        left = np.zeros(m, np.int32)
        left[split] = base + m + 2 * np.arange(len(split))
        levels.append((feature, cut, left, sums / total))
        np.add.at(gains, feature[split], gain[split])
        if not len(split):
            return Nodes(*(np.concatenate(x) for x in zip(*levels)), gains)
        base += m
        count = n[split]
        q, ahead = np.repeat(np.arange(len(split)), count), np.cumsum(count) - count
        rows = rows[np.arange(len(q)) + np.repeat(first[split] - ahead, count)]
        goes = flat.take(rows * d + feature[split].astype(np.int64).take(q)) <= cut[split].take(q)
        lefts = np.add.reduceat(goes.astype(np.int64), ahead)
        start = np.concatenate([[0], np.cumsum(np.column_stack([lefts, count - lefts]).ravel())])
        rank = np.cumsum(goes) - goes
        rank -= rank[ahead].take(q)
        to = np.where(goes, start[2 * q] + rank, start[2 * q + 1] + np.arange(len(q)) - ahead.take(q) - rank)
        moved = np.empty_like(rows)
        moved[to] = rows
        rows = moved


# ---- the forest -----------------------------------------------------------

def weights(seed: int, tree: int, part: int, block: int, n: int) -> np.ndarray:
    """How often each row of a block is in a tree's bootstrap."""
    return np.random.default_rng([seed, tree, part, block]).poisson(1.0, n)


def subset(seed: int, tree: int, node: int, d: int, k: int) -> np.ndarray:
    return np.sort(np.random.default_rng([seed, tree, 1, node]).permutation(d)[:k])


def _tops(blocks: DataFrame, n: int, d: int, k: int, depth: int, least: int, trees: int, seed: int,
          local: int) -> list[Nodes]:
    """What lies above the cells of every tree, a pass a level."""
    spark, width = blocks.sparkSession, MAX_BINS
    one = lambda: Nodes(np.array([-1], np.int16), np.zeros(1, np.uint8), np.zeros(1, np.int32), np.zeros(1), np.zeros(d), np.zeros(1, np.int64))
    tops = [one() for _ in range(trees)]
    level = {t: [0] for t in range(trees)} if n > local else {}
    cores = spark.sparkContext.defaultParallelism
    for _ in range(depth):
        if not level:
            break
        said = spark.sparkContext.broadcast((tops, level))

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tops, level = said.value
            sums = {t: np.zeros((2, k, len(nodes) * width)) for t, nodes in level.items()}
            chosen = {t: np.stack([subset(seed, t, v, d, k) for v in nodes]) for t, nodes in level.items()}
            for part, block, y, bins in _unpacked(batches, d):
                flat = bins.ravel()
                for t, nodes in level.items():
                    slots = np.full(len(tops[t].feature), -1)
                    slots[nodes] = np.arange(len(nodes))
                    w, q = weights(seed, t, part, block, len(y)), slots[tops[t].reached(bins)]
                    r = np.flatnonzero((w > 0) & (q >= 0))
                    w, q, v = w[r].astype(float), q[r], y[r]
                    for i in range(k):
                        c = q * width + flat.take(r * d + chosen[t][:, i].take(q))
                        sums[t][0, i] += np.bincount(c, w, len(nodes) * width)
                        sums[t][1, i] += np.bincount(c, w * v, len(nodes) * width)
            for t, nodes in level.items():
                cells = sums[t].reshape(2, k, len(nodes), width).transpose(2, 0, 1, 3)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t] * len(nodes), pa.int32()), pa.array(nodes, pa.int32()),
                     pa.array([x.tobytes() for x in cells], pa.binary())], names=["tree", "node", "sums"])

        def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int], np.ndarray] = {}
            for b in batches:
                for t, v, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                    x = np.frombuffer(x.as_buffer()).reshape(2, k, width)
                    held[t, v] = held[t, v] + x if (t, v) in held else x
            out = []
            for (t, v), x in sorted(held.items()):
                gain, j, b = (z[0] for z in best_splits(x[:1], x[1:], least))
                w, s, wl, sl = x[0, 0].sum(), x[1, 0].sum(), x[0, j, :b + 1].sum(), x[1, j, :b + 1].sum()
                out.append((t, v, int(subset(seed, t, v, d, k)[j]) if gain > 1e-12 * s * s / w else -1, int(b), float(gain),
                            w, s, wl, sl))
            names = ["tree", "node", "feature", "cut", "gain", "w", "s", "wl", "sl"]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), *[pa.float64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], x) for i, x in enumerate(kinds)], names=names)

        parts = blocks.coalesce(TASKS_PER_CORE * cores).mapInArrow(partial, "tree int, node int, sums binary")
        found: dict[int, list] = {}
        for r in parts.repartition(4 * cores, "tree", "node").mapInArrow(
                chosen, "tree int, node int, feature int, cut int, gain double, w double, s double, wl double, sl double").collect():
            found.setdefault(r["tree"], []).append(r)  # a row a node
        level = {}
        for t, splits in sorted(found.items()):
            top = tops[t]
            for r in sorted(splits, key=lambda r: r["node"]):
                v = r["node"]
                top.value[v] = r["s"] / r["w"]
                if r["feature"] < 0:
                    # No split among the features drawn here: a leaf, as it would be in a cell.
                    top.cell[v] = -1
                    continue
                at, wr = len(top.feature), r["w"] - r["wl"]
                top.feature[v], top.cut[v], top.left[v], top.cell[v] = r["feature"], r["cut"], at, -1
                top.gain[r["feature"]] += r["gain"]
                top.feature = np.append(top.feature, np.int16([-1, -1]))
                top.cut, top.left = np.append(top.cut, np.uint8([0, 0])), np.append(top.left, np.int32([0, 0]))
                top.value = np.append(top.value, [r["sl"] / r["wl"], (r["s"] - r["sl"]) / wr])
                top.cell = np.append(top.cell, [at, at + 1])
                level.setdefault(t, []).extend(c for c, x in ((at, r["wl"]), (at + 1, wr)) if x > local)
        level = {t: nodes for t, nodes in level.items() if nodes}
    return tops


def _depth_of(top: Nodes) -> np.ndarray:
    out = np.zeros(len(top.feature), np.int64)
    for v in np.flatnonzero(top.feature >= 0):  # children come after their parent
        out[top.left[v]:top.left[v] + 2] = out[v] + 1
    return out


class Forest:
    """A fitted forest: what lies above the cells, and a table of the branches below."""

    def __init__(self, cuts, tops, paths, sizes, importances, mean, unit, features, params):
        self.cuts, self.tops, self.paths, self.sizes, self.mean, self.unit = cuts, tops, paths, sizes, mean, unit
        self.featureImportances, self.features, self.params = DenseVector(importances), features, params

    @property
    def stages(self) -> list:
        return [self]

    def branches(self, spark) -> DataFrame:
        """tree, cell and a branch's nodes as bytes."""
        return spark.read.schema(TREES).parquet(*self.paths)

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        spark, d, trees = df.sparkSession, len(self.cuts), len(self.tops)
        cores = spark.sparkContext.defaultParallelism
        path = scratch_path(spark, "forest_rows")
        df.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
        rows = spark.read.parquet(path)
        groups = min(trees, max(2 * cores, -(-sum(self.sizes.values()) // GROUP_BYTES)))
        cuts, block = self.cuts, BLOCK
        said = spark.sparkContext.broadcast(self.tops)

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, block):
                    b = whole.slice(at, block)
                    x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                    yield pa.RecordBatch.from_arrays([pa.array([b.column(0).to_numpy().tobytes()], pa.binary()),
                                                      pa.array([binned(x, cuts).tobytes()], pa.binary())], names=["ids", "bins"])

        none = F.lit(None).cast("binary")
        asks = vectors(rows, self.features, "_id").mapInArrow(packed, "ids binary, bins binary").select(
            F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(trees).alias("tree"), F.lit(0).alias("cell"),
            *[x.alias(c) for c, x in zip(("a", "b", "c", "e"), (F.col("ids"), F.col("bins"), none, none))])
        held = self.branches(spark).select(F.pmod("tree", F.lit(groups)).cast("int").alias("group"), "tree", "cell",
                                           F.col("feature").alias("a"), F.col("cut").alias("b"), F.col("left").alias("c"),
                                           F.col("value").alias("e"))

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            group, held = None, {}
            for b in batches:
                for i in range(b.num_rows):
                    g, tree, cell = (b.column(j)[i].as_py() for j in range(3))
                    if g != group:
                        group, held = g, {}
                    x = [b.column(j)[i].as_buffer() for j in (3, 4, 5, 6) if b.column(j)[i].is_valid]
                    if tree < trees:  # all of a group's come before its rows
                        held.setdefault(tree, {})[cell] = Nodes(*(np.frombuffer(bytes(y), z) for y, z in zip(x, (np.int16, np.uint8, np.int32, np.float64))), None)
                        continue
                    if held and isinstance(next(iter(held.values())), dict):
                        held = {t: _joined(said.value[t], cells) for t, cells in held.items()}
                    ids, bins = np.frombuffer(x[0], np.int64), np.frombuffer(x[1], np.uint8).reshape(-1, d)
                    p = np.zeros(len(ids))
                    for t in sorted({*held, *range(g, trees, groups)}):
                        one = held[t] if t in held else said.value[t]
                        p += one.value[one.reached(bins)]
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(p)], names=["_id", "_p"])

        each = (held.unionByName(asks).repartition(groups, "group").sortWithinPartitions("group", "tree", "cell")
                .mapInArrow(scored, "_id long, _p double"))
        p = each.groupBy("_id").agg((F.sum("_p") * (self.unit / trees) + self.mean).alias(out))
        return rows.join(p, "_id").drop("_id")


def _joined(top: Nodes, cells: dict[int, Nodes]) -> Nodes:
    """A tree from what lies above its cells and their branches."""
    parts, at = [(top.feature, top.cut, top.left, top.value)], len(top.feature)
    feature, cut, left, value = (x.copy() for x in parts[0])
    for v in np.flatnonzero(top.cell >= 0):
        one = cells.get(int(top.cell[v]))
        if one is None:
            continue
        # The branch's root takes the leaf's place; the others follow in their order.
        move = np.where(one.feature >= 0, one.left + at - 1, 0).astype(np.int32)
        feature[v], cut[v], left[v], value[v] = one.feature[0], one.cut[0], move[0], one.value[0]
        parts.append((one.feature[1:], one.cut[1:], move[1:], one.value[1:]))
        at += len(one.feature) - 1
    parts[0] = (feature, cut, left, value)
    return Nodes(*(np.concatenate(x) for x in zip(*parts)), top.gain)


def fit_forest(df: DataFrame, features: str, label: str, num_trees: int, max_depth: int, min_leaf: int,
               seed: int, local_rows: int | None = None) -> Forest:
    """``df``: rows with a vector of features and a label."""
    spark, local = df.sparkSession, local_rows or LOCAL_ROWS
    rows = vectors(df, features, F.col(f"`{label}`").cast("double").alias("y"))
    n, d, mean, unit = whole_labels(rows)
    k = math.ceil(math.sqrt(d))
    cuts = thresholds(rows, n, d, seed)
    blocks = stored_blocks(rows, cuts, mean, unit)
    tops = _tops(blocks, n, d, k, max_depth, min_leaf, num_trees, seed, local)
    deep = [_depth_of(t) for t in tops]
    said = spark.sparkContext.broadcast((tops, deep))
    wide = d + 9

    def deal(turn: list[int]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, block, y, bins in _unpacked(batches, d):
                for t in turn:
                    top, w = said.value[0][t], weights(seed, t, part, block, len(y))
                    cell = top.cell[top.reached(bins)]
                    r = np.flatnonzero((w > 0) & (cell >= 0))
                    r = r[np.argsort(cell[r], kind="stable")]
                    ends = np.flatnonzero(np.diff(cell[r], append=-1)) + 1
                    out = [(int(cell[x[0]]), y[x].tobytes() + np.minimum(w[x], 255).astype(np.uint8).tobytes() + bins[x].tobytes())
                           for x in np.split(r, ends[:-1]) if len(x)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([t] * len(out), pa.int32()), pa.array([c for c, _ in out], pa.int32()),
                         pa.array([x for _, x in out], pa.binary())], names=["tree", "cell", "rows"])
        return run

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def branch(tree: int, cell: int, parts: list[bytes]) -> pa.RecordBatch:
            ns = [len(x) // wide for x in parts]
            y = np.concatenate([np.frombuffer(x, np.float64, n) for x, n in zip(parts, ns)])
            w = np.concatenate([np.frombuffer(x, np.uint8, n, 8 * n) for x, n in zip(parts, ns)])
            bins = np.concatenate([np.frombuffer(x, np.uint8, n * d, 9 * n) for x, n in zip(parts, ns)]).reshape(-1, d)
            b = grown(bins, y, w, max_depth - int(said.value[1][tree][cell]), k, min_leaf, np.random.default_rng([seed, tree, 2, cell]))
            return pa.RecordBatch.from_arrays(
                [pa.array([tree], pa.int32()), pa.array([cell], pa.int32()),
                 *(pa.array([x.tobytes()], pa.binary()) for x in (b.feature, b.cut, b.left, b.value, b.gain))],
                names=["tree", "cell", "feature", "cut", "left", "value", "gain"])

        held, parts = None, []
        for b in batches:
            for t, c, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if (t, c) != held:
                    if parts:
                        yield branch(*held, parts)
                    held, parts = (t, c), []
                parts.append(x.as_py())
        if parts:
            yield branch(*held, parts)

    each = max(1, min(num_trees, int(TURN_BYTES // (0.64 * n * wide))))
    paths = []
    for first in range(0, num_trees, each):
        turn = list(range(first, min(first + each, num_trees)))
        cells = sum(int((tops[t].cell >= 0).sum()) for t in turn)
        if not cells:
            continue
        paths.append(scratch_path(spark, "forest_trees"))
        to = max(1, min(cells, max(len(turn), int(0.64 * n * wide * len(turn)) // CELL_BYTES)))
        (blocks.mapInArrow(deal(turn), "tree int, cell int, rows binary").repartition(to, "tree", "cell")
         .sortWithinPartitions("tree", "cell").mapInArrow(grow, TREES).write.parquet(paths[-1]))
        if each < num_trees:
            spark.sparkContext._jvm.System.gc()  # what a turn has dealt is deleted when the driver forgets it
    gains, sizes = np.stack([t.gain for t in tops]), dict.fromkeys(range(num_trees), 0)
    if paths:
        for r in spark.read.schema(TREES).parquet(*paths).select("tree", "gain", F.octet_length("value").alias("n")).toLocalIterator():
            gains[r["tree"]] += np.frombuffer(r["gain"])
            sizes[r["tree"]] += 2 * r["n"]
    share = gains / np.maximum(gains.sum(axis=1, keepdims=True), 1e-300)
    return Forest(cuts, tops, paths, sizes, share.sum(axis=0) / max(share.sum(), 1e-300), mean, unit, features,
                  {"numTrees": num_trees, "maxDepth": max_depth, "minInstancesPerNode": min_leaf, "seed": seed})
