"""Sums of small matrices over all rows in one pass: the sufficient statistics
of linear models, principal components and wide correlation tables.

Each task adds up the matrices of its batches and hands over one copy, row by
row; rows with one place are summed by the next stage.  What reaches the
driver is the sum alone, bounded by the number of columns squared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TASKS_PER_CORE = 4
PIECE = "piece int, line int, value array<double>"
PIECE_ARROW = pa.schema([("piece", pa.int32()), ("line", pa.int32()), ("value", pa.list_(pa.float64()))])


def _lines(keys: list[tuple[int, int]], rows: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
         pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.float64()))], schema=PIECE_ARROW)


def reduced(df: DataFrame, cols: Sequence[str], make: Callable[[np.ndarray], list[np.ndarray]]) -> list[np.ndarray]:
    """Sum over all rows of the matrices ``make`` gives for a batch of rows
    (columns ``cols`` as doubles, NULL as NaN).  ``make`` of no rows must give
    zeros of the right shapes.

    Input splits are merged down to a few tasks a core first, so the partial
    sums that are shuffled do not grow with the number of splits."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    d = len(cols)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = make(np.zeros((0, d)))
        for b in batches:
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(d)])
            for a, part in zip(total, make(x)):
                a += part
        yield _lines([(i, j) for i, m in enumerate(total) for j in range(len(m))], [r for m in total for r in m])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            flat, offsets = b.column(2).flatten().to_numpy(), b.column(2).offsets.to_numpy() - b.column(2).offsets[0].as_py()
            for i, key in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                row = flat[offsets[i]:offsets[i + 1]]
                sums[key] = sums[key] + row if key in sums else row.copy()
        yield _lines(list(sums), list(sums.values()))

    out = make(np.zeros((0, d)))
    lines = sum(len(m) for m in out)
    parts = wide.coalesce(TASKS_PER_CORE * cores).mapInArrow(partial, PIECE)
    rows = parts.repartition(min(cores, lines), "piece", "line").mapInArrow(merged, PIECE).collect()
    for r in rows:
        out[r["piece"]][r["line"]] = r["value"]
    return out


def centred_gram(z: np.ndarray) -> list[np.ndarray]:
    """[rows and column sums, products] of a batch."""
    one = np.column_stack([np.ones(len(z)), z])
    return [one.T @ one]


def moments_of(g: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, means, centred sums of products) from the Gram of [1, Z]."""
    n = int(round(g[0, 0]))
    mean = g[0, 1:] / max(n, 1)
    return n, mean, g[1:, 1:] - n * np.outer(mean, mean)


# ---- correlation of wide tables -------------------------------------------

def masked_sums(shift: np.ndarray) -> Callable[[np.ndarray], list[np.ndarray]]:
    """[presence x presence, values x presence, squares x presence, values x
    values] of a batch, values less ``shift``, absent ones zero."""
    def make(x: np.ndarray) -> list[np.ndarray]:
        there = ~np.isnan(x)
        v = np.where(there, x - shift, 0.0)
        m = there.astype(float)
        return [m.T @ m, v.T @ m, (v * v).T @ m, v.T @ v]
    return make


def pairwise_corr(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """Pearson correlation of every two columns over the rows that have both
    (NULL and NaN are absent); NaN where fewer than two rows or no variance."""
    shift = df.agg(*[F.avg(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))).alias(f"c{i}")
                     for i, c in enumerate(cols)]).first()  # near the mean, so that squares do not cancel
    n, s, q, p = reduced(df, cols, masked_sums(np.array([v or 0.0 for v in shift])))
    with np.errstate(invalid="ignore", divide="ignore"):
        var = q - s * s / n          # of a over the rows that have b too
        cov = p - s * s.T / n
        r = cov / np.sqrt(var * var.T)
        flat = var <= 1e-12 * np.maximum(q, 1e-300)
    r[(n < 2) | flat | flat.T] = np.nan
    return np.clip(r, -1.0, 1.0)


# ---- lasso on sufficient statistics ---------------------------------------

class LassoStatistics:
    """Standardised covariances of a design (columns Z, then the label):
    ``c`` = Z'Z / n, ``r`` = Z'y / n over centred columns of unit population
    variance, as MLlib standardises; constant columns are out."""

    def __init__(self, g: np.ndarray):
        self.n, self.mean, s = moments_of(g)
        self.sd = np.sqrt(np.maximum(np.diag(s), 0.0) / max(self.n, 1))
        scale = np.sqrt(np.maximum(np.diag(g)[1:], 1e-300) / max(self.n, 1))
        self.live = self.sd[:-1] > 1e-9 * scale[:-1]
        inv = np.where(self.live, 1.0 / np.where(self.live, self.sd[:-1], 1.0), 0.0)
        self.c = s[:-1, :-1] * np.outer(inv, inv) / max(self.n, 1)
        self.r = s[:-1, -1] * inv / max(self.n, 1)
        self.inv = inv
        self.sample_sd = self.sd * np.sqrt(self.n / max(self.n - 1, 1))

    def gradient(self, b: np.ndarray) -> np.ndarray:
        return self.r - self.c @ b

    def solve(self, lam: float, start: np.ndarray | None = None, tol: float = 1e-10, sweeps: int = 20_000) -> np.ndarray:
        """The standardised coefficients b that minimise b'cb / 2 - r'b + ``lam``
        |b|_1, by coordinate descent over the columns that are in or want in;
        done when a sweep over all columns moves none."""
        b = np.zeros(len(self.r)) if start is None else start.copy()
        g = self.gradient(b)
        limit = tol * max(1.0, float(np.abs(self.r).max(initial=0.0)))
        diag = np.diag(self.c)

        def sweep(js) -> float:
            moved = 0.0
            for j in js:
                u = g[j] + diag[j] * b[j]
                new = np.sign(u) * max(abs(u) - lam, 0.0) / diag[j]
                if (step := new - b[j]) != 0.0:
                    b[j] = new
                    g[:] -= self.c[:, j] * step
                    moved = max(moved, abs(step) * diag[j])
            return moved

        live = np.flatnonzero(self.live)
        for _ in range(sweeps):
            if sweep(live[(np.abs(g[live]) > lam) | (b[live] != 0)]) <= limit:
                if (np.abs(g[live]) <= lam + limit).all() or sweep(live) <= limit:
                    break
        return b

    def coefficients(self, b: np.ndarray) -> tuple[np.ndarray, float]:
        """(coefficients in the design's own units, intercept)."""
        coef = b * self.inv
        return coef, float(self.mean[-1] - self.mean[:-1] @ coef)
