"""Gradient boosting as MLlib defines it, on histograms.

The first tree is fitted to the labels and counts once; each later one is fitted
to twice the residuals and counts ``step`` times.  Thresholds and rows are those
of ``operators/forest.py``: binned once, written down in blocks of bytes.

Up to ``LOCAL_ROWS`` rows, one task holds them all and grows all trees.  Above, a
level of a tree is a pass: tasks add up rows and residuals by (node, feature,
bin), the next stage adds the tasks, the driver picks the splits.  Of two
children only the one with fewer rows is summed; the other's sums are its
parent's less these.  Predictions so far are written beside the rows every ``KEEP``
trees, which a pass would have to replay, and the rows before are deleted.

Residuals are summed as whole multiples of a power of two, so that both ways give
the same trees on any partitioning of the blocks.  Defined results: as
``operators/forest.py``.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators.forest import MAX_BINS, Nodes, best_splits, binned, stored_blocks, subset, thresholds, vectors, whole_labels
from meterlake.session import forget, scratch_path

LOCAL_ROWS = 200_000
KEEP = 2
ROWS = "part int, block int, y binary, bins binary, p binary"


@dataclass
class Rows:
    """Training rows in blocks, with what their bins and whole labels mean."""
    blocks: DataFrame
    n: int
    cuts: list[np.ndarray]
    mean: float
    unit: float


def rows_of(df: DataFrame, features: str, label: str, seed: int) -> Rows:
    rows = vectors(df, features, F.col(f"`{label}`").cast("double").alias("y"))
    n, d, mean, unit = whole_labels(rows)
    cuts = thresholds(rows, n, d, seed)
    return Rows(stored_blocks(rows, cuts, mean, unit), n, cuts, mean, unit)


@dataclass
class Boosted:
    cuts: list[np.ndarray]
    mean: float
    unit: float
    step: float
    features: str = "features"
    trees: list[Nodes] = field(default_factory=list)

    def score(self, bins: np.ndarray, first: int = 0) -> np.ndarray:
        """The part of the trees from ``first`` on, in units of labels less their mean."""
        out = np.zeros(len(bins))
        for t, tree in enumerate(self.trees[first:], first):
            out += (2 * self.step if t else 1.0) * tree.value[tree.reached(bins)]
        return out

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` without its vectors, with the prediction; the model is at most trees x 2^(depth + 1) nodes."""
        kept = [f for f in df.schema.fields if not isinstance(f.dataType, VectorUDT)]
        names, d = [f.name for f in kept], len(self.cuts)
        model = df.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = model.value
            for b in batches:
                x = b.column(len(names)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                p = m.score(binned(x, m.cuts)) * m.unit + m.mean
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(p)], names=[*names, out])

        x = vector_to_array(F.col(self.features)).alias("_x")
        return df.select(*[F.col(f"`{c}`") for c in names], x).mapInArrow(
            run, T.StructType([*kept, T.StructField(out, T.DoubleType())]))

    def rules(self, names: list[str]) -> list[str]:
        """Every node but the roots as the conjunction of the splits on its path."""
        out = []
        for tree in self.trees:
            stack = [(0, [])]
            while stack:
                v, path = stack.pop()
                if path:
                    out.append(" AND ".join(path))
                if (j := int(tree.feature[v])) >= 0:
                    cut = repr(float(self.cuts[j][tree.cut[v]]))
                    stack += [(int(tree.left[v]), [*path, f"`{names[j]}` <= {cut}"]),
                              (int(tree.left[v]) + 1, [*path, f"`{names[j]}` > {cut}"])]
        return out


def taken(seed: int, tree: int, part: int, block: int, n: int, share: float) -> np.ndarray:
    """Which rows of a block are in a tree's sample."""
    return np.ones(n, bool) if share >= 1 else np.random.default_rng([seed, tree, part, block]).random(n) < share


def add_up(sums: np.ndarray, by_feature: np.ndarray, rest: np.ndarray, q: np.ndarray) -> None:
    """Adds rows to ``sums`` (2 x nodes x features x bins): counts and residuals of the rows at node places ``q``."""
    _, m, d, width = sums.shape
    rows = np.flatnonzero(q >= 0)
    if not len(rows):
        return
    cell, r = q[rows] * width, rest[rows]
    count, total = np.bincount(q[rows], minlength=m), np.bincount(q[rows], r, m)
    for j in range(d):
        if not by_feature[j].any():  # as of a constant feature
            sums[0, :, j, 0] += count
            sums[1, :, j, 0] += total
            continue
        at = cell + by_feature[j].take(rows)
        sums[0, :, j] += np.bincount(at, minlength=m * width).reshape(m, width)
        sums[1, :, j] += np.bincount(at, r, m * width).reshape(m, width)


def places(tree: Nodes, nodes: list[int], bins: np.ndarray, live: np.ndarray) -> np.ndarray:
    """Where the node of each row stands in ``nodes``, -1 if it does not or the row is not live."""
    slots = np.full(len(tree.feature), -1)
    slots[nodes] = np.arange(len(nodes))
    return np.where(live, slots[tree.reached(bins)], -1)


def _grow(sums_of: Callable[[Nodes, list[int]], np.ndarray], d: int, k: int, depth: int, seed: int, t: int) -> Nodes:
    tree = Nodes(np.array([-1], np.int16), np.zeros(1, np.uint8), np.zeros(1, np.int32), np.zeros(1), np.zeros(d))
    open_, summed, sums, parent = [0], [0], {}, {}
    for _ in range(depth):
        if not open_:
            break
        above, sums = sums, dict(zip(summed, sums_of(tree, summed).swapaxes(0, 1)))
        for v in open_:
            if v not in sums:  # siblings stand at 1, 2 and so on
                sums[v] = above[parent[v]] - sums[v + 1 if v % 2 else v - 1]
        chosen = np.stack([subset(seed, t, v, d, k) for v in open_])
        h = np.stack([sums[v][:, c] for v, c in zip(open_, chosen)], axis=1)
        gain, place, cut = best_splits(*h, 1)
        following, summed = [], []
        for i, v in enumerate(open_):
            w, s = h[0, i, 0].sum(), h[1, i, 0].sum()
            tree.value[v] = s / w if w else 0.0
            if not gain[i] > 1e-12 * s * s / max(w, 1):
                continue
            wl, sl = h[0, i, place[i], :cut[i] + 1].sum(), h[1, i, place[i], :cut[i] + 1].sum()
            at = len(tree.feature)
            tree.feature[v], tree.cut[v], tree.left[v] = chosen[i, place[i]], cut[i], at
            tree.gain[chosen[i, place[i]]] += gain[i]
            tree.feature, tree.cut = np.append(tree.feature, np.int16([-1, -1])), np.append(tree.cut, np.uint8([0, 0]))
            tree.left = np.append(tree.left, np.int32([0, 0]))
            tree.value = np.append(tree.value, [sl / wl, (s - sl) / (w - wl)])
            following += [at, at + 1]
            parent |= {at: v, at + 1: v}
            summed.append(at if wl <= w - wl else at + 1)
        open_ = following
    return tree


def _unpacked(batches: Iterator[pa.RecordBatch], d: int):
    for b in batches:
        for i in range(b.num_rows):
            y, bins, *p = (np.frombuffer(b.column(c)[i].as_buffer(), kind)
                           for c, kind in list(enumerate((np.float64, np.uint8, np.float64), 2))[:b.num_columns - 2])
            yield b.column(0)[i].as_py(), b.column(1)[i].as_py(), y, bins.reshape(len(y), d), p[0] if p else np.zeros(len(y))


def fit_boosted(rows: Rows, rounds: int, step: float, max_depth: int, subsample: float = 1.0, col_sample: float = 1.0,
                seed: int = 42, local_rows: int | None = None) -> Boosted:
    d = len(rows.cuts)
    k = max(1, math.ceil(col_sample * d))
    model = Boosted(rows.cuts, rows.mean, rows.unit, step)
    args = rounds, max_depth, subsample, k, seed
    if rows.n <= (local_rows or LOCAL_ROWS):
        _in_one_task(rows, model, *args)
    else:
        _in_passes(rows, model, *args)
    return model


def _in_one_task(rows: Rows, model: Boosted, rounds: int, max_depth: int, subsample: float, k: int, seed: int) -> None:
    d = len(model.cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, ys, parts = [], [], []
        for part, block, y, bins, _ in _unpacked(batches, d):
            names.append((part, block, len(y)))
            ys.append(y.copy())
            parts.append(bins.copy())
        if not names:
            return
        y, bins = np.concatenate(ys), np.concatenate(parts)
        by_feature, p = np.ascontiguousarray(bins.T), np.zeros(len(y))
        for t in range(rounds):
            live, rest = np.concatenate([taken(seed, t, *x, subsample) for x in names]), np.rint(y - p)

            def sums_of(tree: Nodes, nodes: list[int]) -> np.ndarray:
                sums = np.zeros((2, len(nodes), d, MAX_BINS))
                add_up(sums, by_feature, rest, places(tree, nodes, bins, live))
                return sums

            model.trees.append(_grow(sums_of, d, k, max_depth, seed, t))
            p += model.score(bins, t)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(x) for x in model.trees], pa.binary())], names=["tree"])

    found = rows.blocks.coalesce(1).mapInArrow(run, "tree binary").collect()
    model.trees = [pickle.loads(r["tree"]) for r in found]


def _in_passes(rows: Rows, model: Boosted, rounds: int, max_depth: int, subsample: float, k: int, seed: int) -> None:
    d, spark = len(model.cuts), rows.blocks.sparkSession
    cores = spark.sparkContext.defaultParallelism
    data, kept = rows.blocks, ""

    def advanced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, block, y, bins, p in _unpacked(batches, d):
            p = p + model.score(bins, first)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()),
                 *(pa.array([x.tobytes()], pa.binary()) for x in (y, bins, p))], names=["part", "block", "y", "bins", "p"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for v, x in zip(b.column(0).to_pylist(), b.column(1)):
                x = np.frombuffer(x.as_buffer())
                held[v] = held[v] + x if v in held else x
        yield pa.RecordBatch.from_arrays([pa.array([*held], pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())],
                                         names=["node", "sums"])

    first = 0
    for t in range(rounds):
        if t and t % KEEP == 0:
            path = scratch_path(spark, "boost_rows")
            data.mapInArrow(advanced, ROWS).write.option("parquet.block.size", 16 << 20).parquet(path)
            data, kept, first = spark.read.schema(ROWS).parquet(path), forget(spark, kept) or path, t

        def sums_of(tree: Nodes, nodes: list[int]) -> np.ndarray:
            def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                sums = np.zeros((2, len(nodes), d, MAX_BINS))
                for part, block, y, bins, p in _unpacked(batches, d):
                    q = places(tree, nodes, bins, taken(seed, t, part, block, len(y), subsample))
                    add_up(sums, np.ascontiguousarray(bins.T), np.rint(y - p - model.score(bins, first)), q)
                yield pa.RecordBatch.from_arrays([pa.array(range(len(nodes)), pa.int32()),
                                                  pa.array([x.tobytes() for x in sums.swapaxes(0, 1)], pa.binary())], names=["node", "sums"])

            each = data.coalesce(2 * cores).mapInArrow(partial, "node int, sums binary")
            out = np.zeros((len(nodes), 2, d, MAX_BINS))
            for r in each.repartition(min(cores, len(nodes)), "node").mapInArrow(added, "node int, sums binary").collect():
                out[r["node"]] = np.frombuffer(r["sums"]).reshape(out.shape[1:])  # at most 2^depth rows
            return out.swapaxes(0, 1)

        model.trees.append(_grow(sums_of, d, k, max_depth, seed, t))
    forget(spark, kept)
