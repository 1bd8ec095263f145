"""Approximate nearest neighbours by collision counting (operator 2).

Nearness is the inner product.  Blocks hold vectors of nearly equal norm: norms
fall into bands ``NORM_STEP`` wide, a large band is split by id hash, and
neighbouring bands share a block only while all its vectors are verified.
The vectors of a block are scaled by its largest norm and get one more
component that lifts them to the unit sphere; queries are scaled to length one.
The nearest by distance there are those of largest inner product.  (Under one
scale for vectors of uneven norms the shorter ones all lie near the lifting
axis, where collisions hardly tell them apart.)

Each block of vectors is hashed by ``projections`` single random projections,
each kept as a sorted array.  A query opens a window of half-width r around
its own projected value in every array; r grows by ``growth`` (virtual
rehashing: wider windows over the same arrays).  Collisions are counted by the
vectors' places in the arrays, and as windows only gain vectors, growing begins
at the width where the last query's stopped, going back while that is too wide.
Growing stops when 10 k + ``verify`` * block vectors collide at
least ``threshold`` * projections times, or the windows cover the block; the
vectors over the highest collision threshold that leaves as many are verified
by inner products of the original vectors in double precision, and the
block's best k kept.

The stated query set meets all vectors block by block; blocks and query chunks
have fixed sizes, so a task's memory does not grow with the data; the driver
sees one row per dimension and norm band.  Block answers merge by a top-k that
is cut on the map side.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part; every other row does, whatever its id: rows that share
an id are candidates and queries of their own, a null id is a candidate's; a
query leaves out its own row alone; only vectors of the query's dimension are
its candidates; ties go to the smaller id, null last; vectors of any length pass
as one cell; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import col, stored

K = 20
PROJECTIONS = 96
THRESHOLD = 0.75
VERIFY = 0.2
GROWTH = 1.25
FIRST_WIDTH = 0.02
BLOCK = 16_384
NORM_STEP = 1.05
CHUNK = 4_096
LINES = 16
SEED = 7


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """row (a number of its own), vec_id, vec (array<double>) of the rows that take
    part."""
    v = col(vectors, vector_col).cast("array<double>")
    rows = vectors.select(col(vectors, id_col).cast("long").alias("vec_id"), v.alias("vec"))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec").isNotNull() & F.coalesce(sound, F.lit(False)) & F.exists("vec", lambda x: x != 0))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vec")


class Block:
    """Vectors of one block with their sorted projection arrays."""

    def __init__(self, rows: np.ndarray, vecs: np.ndarray, projections: int):
        self.rows, self.vecs = rows, vecs
        dim = vecs.shape[1]
        self.lines = np.random.default_rng([SEED, dim]).standard_normal((dim + 1, projections))
        unit = vecs / np.abs(vecs).max()
        unit /= np.sqrt(np.einsum("ij,ij->i", unit, unit).max())
        lift = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", unit, unit)))
        at = np.column_stack([unit, lift]) @ self.lines
        self.order = [np.argsort(at[:, i], kind="stable") for i in range(projections)]
        self.sorted = [at[o, i] for i, o in enumerate(self.order)]

        # A vector's places in the arrays, line by line; narrow, so that counting streams through them.
        self.place = np.empty((projections, len(rows)), np.uint16 if len(rows) <= 1 << 16 else np.uint32)
        for place, o in zip(self.place, self.order):
            place[o] = np.arange(len(rows))

    def centres(self, queries: np.ndarray) -> np.ndarray:
        """(queries, projections) projected values."""
        return (queries / np.linalg.norm(queries, axis=1)[:, None]) @ self.lines[:-1]

    def windows(self, centre: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
        """(queries, projections) first places and sizes of the windows in the
        sorted arrays."""
        low = np.column_stack([v.searchsorted(c - width, "left") for v, c in zip(self.sorted, centre.T)])
        high = np.column_stack([v.searchsorted(c + width, "right") for v, c in zip(self.sorted, centre.T)])
        return low, high - low

    def counts(self, low: np.ndarray, span: np.ndarray) -> np.ndarray:
        """Collisions of every vector with a query: windows that its place lies in."""
        n, kind = len(self.rows), self.place.dtype
        whole = span == n  # a place may equal the type's largest number, a span may not
        low, span = low.astype(kind)[:, None], np.where(whole, 0, span).astype(kind)[:, None]
        count = np.full(n, np.count_nonzero(whole), np.uint8 if len(self.place) < 256 else np.int64)
        for i in range(0, len(self.place), LINES):
            # Places below a window wrap round to large numbers.
            inside = self.place[i:i + LINES] - low[i:i + LINES] < span[i:i + LINES]
            count += inside.view(np.uint8).sum(axis=0, dtype=count.dtype)
        return count

    def candidates(self, ends: Callable[[int], tuple[np.ndarray, np.ndarray]], widths: int, need: int,
                   collisions: int, near: int) -> tuple[np.ndarray, int]:
        """Places of the vectors to verify: from the first (narrowest) windows
        in which ``need`` vectors collide at least ``collisions`` times, those
        over the highest threshold that still leaves ``need`` of them; and the
        number of that width.  ``ends`` gives the windows of a width.  They only
        gain vectors as they widen, so the search may begin at any width: at
        ``near``, the last query's."""
        def enough(i: int) -> np.ndarray | None:
            count = self.counts(*ends(i))
            return count if np.count_nonzero(count >= collisions) >= need else None

        at, count = near, enough(near)
        if count is None:
            while count is None:
                at += 1
                if at == widths:
                    return np.arange(len(self.rows)), near
                count = enough(at)
        else:
            while at and (less := enough(at - 1)) is not None:
                at, count = at - 1, less
        over = np.cumsum(np.bincount(count)[::-1])[::-1]  # vectors by least collisions
        return np.flatnonzero(count >= np.flatnonzero(over >= need)[-1]), at


def with_band(vectors: DataFrame) -> DataFrame:
    """``vectors`` with dim and band: the number of the norm band, by logarithms,
    so that no square overflows; norm 1 is the middle of band 0."""
    peak = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + (x / F.col("peak")) * (x / F.col("peak")))
    log_norm = F.log("peak") + F.log(squares) / 2
    return (vectors.withColumns({"dim": F.size("vec"), "peak": peak})
            .withColumn("band", F.floor(log_norm / float(np.log(NORM_STEP)) + 0.5)).drop("peak"))


def norm_blocks(bands: list[tuple[int, int, int]], block: int, least: int) \
        -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int, int]]]:
    """(dim, band, first block, blocks) of every (dim, band, vectors), and
    (dim, first block, last block) of every dimension.  Neighbouring bands share
    a block while it has at most ``least`` vectors."""
    places, spans = [], {}
    at, held, last = -1, 0, None
    for dim, band, n in sorted(bands):
        if dim == last and held + n <= least:
            held += n
            places.append((dim, band, at, 1))
        else:
            parts = -(-n // block)
            at, held, last = at + 1, n, dim
            places.append((dim, band, at, parts))
            at += parts - 1
        spans[dim] = (spans.get(dim, (places[-1][2],))[0], at)
    return places, [(dim, *ends) for dim, ends in spans.items()]


def searched(vectors: DataFrame, queries: Column, k: int = K, projections: int = PROJECTIONS,
             threshold: float = THRESHOLD, verify: float = VERIFY, block: int = BLOCK,
             chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best found of every vector that
    meets the condition ``queries`` (on vec_id), among all other vectors.

    ``vectors`` is the output of ``usable``."""
    spark = vectors.sparkSession
    vectors = stored(with_band(vectors), "vectors")
    seen = vectors.groupBy("dim", "band").agg(
        F.count("*").alias("n"), F.count(F.when(queries, 1)).alias("q")).collect()
    least = min(int(10 * k / (1 - verify)) if verify < 1 else block, block)  # all of so many are verified
    places, spans = norm_blocks([(r["dim"], r["band"], r["n"]) for r in seen], block, least)
    places = F.broadcast(spark.createDataFrame(places, "dim int, band long, first int, parts int"))
    spans = F.broadcast(spark.createDataFrame(spans, "dim int, first int, last int"))
    n_chunks = -(-max(sum(r["q"] for r in seen), 1) // chunk)
    own = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), n).cast("int")
    data = vectors.join(places, ["dim", "band"]).select(
        "dim", (F.col("first") + own(F.col("parts"), 1)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"), "row", "vec_id", "vec")
    # New names for its columns: data comes from the same table.
    asked = vectors.where(queries).select(*[F.col(c).alias(c) for c in ("dim", "row", "vec_id", "vec")])
    asked = asked.join(spans, "dim").select(
        "dim", F.explode(F.sequence("first", "last")).alias("block"),
        own(F.lit(n_chunks), 2).alias("chunk"), "row", "vec_id", "vec")
    schema = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.list_(pa.int64())),
                        ("score", pa.list_(pa.float64()))])

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        rows = table.column("row").to_numpy()
        flat = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return rows, flat.reshape(len(rows), -1)

    def search(asked_: pa.Table, data_: pa.Table) -> pa.Table:
        if not len(asked_) or not len(data_):
            return schema.empty_table()
        q_rows, q_vecs = matrix(asked_)
        part = Block(*matrix(data_), projections)
        names = data_.column("vec_id").combine_chunks()
        # Ties go by id, null last.
        order = names.fill_null(np.iinfo(np.int64).max).to_numpy()
        steps = int(np.ceil(np.log(8 / FIRST_WIDTH) / np.log(GROWTH)))
        widths = FIRST_WIDTH * GROWTH ** np.arange(steps + 1)
        need = min(10 * k + int(verify * len(part.rows)), len(part.rows))
        collisions = int(np.ceil(threshold * projections))
        out: dict[str, list] = {"row": [], "query_id": asked_.column("vec_id"), "vec_id": [], "score": []}
        near = 0
        for q in range(len(q_rows)):
            if need == len(part.rows):
                found = np.arange(need)
            else:
                if q % 64 == 0:  # windows are looked up for so many queries at once
                    batch = part.centres(q_vecs[q:q + 64])
                    looked: dict[int, tuple[np.ndarray, np.ndarray]] = {}

                def ends(i: int) -> tuple[np.ndarray, np.ndarray]:
                    if i not in looked:
                        looked[i] = part.windows(batch, widths[i])
                    return looked[i][0][q % 64], looked[i][1][q % 64]

                found, near = part.candidates(ends, len(widths), need, collisions, near)
            found = found[part.rows[found] != q_rows[q]]
            score = part.vecs.take(found, axis=0) @ q_vecs[q]
            if len(found) > k:  # all that reach the k-th score stay for the tie rule
                best = score >= np.partition(score, len(score) - k)[len(score) - k]
                found, score = found[best], score[best]
            first = np.lexsort((order[found], -score))[:k]
            out["row"].append(q_rows[q])
            out["vec_id"].append(names.take(pa.array(found[first])))
            out["score"].append(score[first])
        return pa.table(out, schema=schema)

    key = ["dim", "block", "chunk"]
    best = asked.groupBy(*key).cogroup(data.groupBy(*key)).applyInArrow(
        search, "row long, query_id long, vec_id array<long>, score array<double>")
    pairs = best.select("row", "query_id", F.explode(F.arrays_zip("vec_id", "score")).alias("x")).select(
        "row", "query_id", "x.vec_id", "x.score")
    by = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return pairs.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
