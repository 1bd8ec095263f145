"""Exact quantiles (linear interpolation, as pandas / numpy / DuckDB
``quantile_cont``) in two passes, without holding a group in one task.

Spark's ``percentile`` aggregate is exact but its final merge keeps every
distinct value of a group in one task, which a hot one (a load type holding a
third of all rows) makes unbounded.  So, at every size:

1. one pass aggregates a mergeable KLL sketch per group and column (bounded
   state, combined on the map side).  Its quantiles at p -/+ a multiple of the
   sketch's rank error bracket the wanted order statistics; a group of fewer
   values than the sketch holds has them exactly;
2. a second pass counts the values below each bracket and those inside it by
   value.  Only the values inside (about 0.4 % of a large group's, a few of a
   small one's) are shuffled, as (value, count), and a running sum over them
   names the wanted ones.

The bracket is ``SIGMAS`` standard errors wide on either side; a rank that still
lay outside would raise an error, never give a wrong value.
Result: one row per (group keys..., ``column``, ``p``) with ``q``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SKETCH = 8_192
SIGMAS = 8.0
ERROR_AT_99 = 2.576  # standard errors in the sketch's stated rank error


BROADCAST_ROWS = 100_000


def sized(df: DataFrame, limit: int = BROADCAST_ROWS) -> tuple[DataFrame, int]:
    """Broadcast behind a size check: a table of at most ``limit`` rows is
    collected once and returned as a broadcast local relation; a larger one is
    returned as is (shuffle join, AQE skew handling).  Returns (frame, rows or
    limit + 1)."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df, limit + 1
    local = df.sparkSession.createDataFrame(rows, df.schema)
    return F.broadcast(local), len(rows)


def key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL meets NULL, so a NULL group is treated
    like any other; the result has the left side's key columns."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"_r_{k}"])
        on = same if on is None else on & same
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def to_long(df: DataFrame, value_cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, v) with nulls and NaN dropped (pandas ``skipna``)."""
    cols = list(value_cols)
    wide = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    long = wide.unpivot(list(by), cols, "column", "v")
    return long.where(F.col("v").isNotNull() & ~F.isnan("v"))


def rank_error(k: int) -> float:
    """Half width of a bracket in ranks, as a share of all values: the stated
    rank error of a KLL sketch of size ``k`` (at 99 %), widened to ``SIGMAS``."""
    return 2.296 / k ** 0.9021 * SIGMAS / ERROR_AT_99


def brackets(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str], k: int) -> DataFrame:
    """(by..., column, t) from one pass of sketches: ``t`` an array of (i, p,
    pos, lo, hi), one per wanted quantile."""
    clean = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols]
    # A group without a single value of a column has no quantile of it.
    sketches = df.groupBy(*by).agg(*[F.kll_sketch_agg_double(x, k).alias(f"_s{j}") for j, x in enumerate(clean)])
    parts = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_s{j}").alias("s")) for j, c in enumerate(cols)])
    rows = sketches.select(*by, F.inline(parts)).withColumn("n", F.kll_sketch_get_n_double("s")).where("n > 0")
    error, n = rank_error(k), F.col("n").cast("double")

    def at(p: float, side: int):
        """The sketch's quantile two ranks and the error away.  Ranks are
        literals there, so the two ranks are taken from a lower bound of n."""
        def of(least: int):
            rank = min(max(p + side * (error + 2.0 / least), 0.0), 1.0)
            return F.kll_sketch_get_quantile_double("s", F.lit(rank))

        out = of(1)
        for least in (8, 64, 512, 4_096, 32_768):
            out = F.when(n >= least, of(least)).otherwise(out)
        return out

    wanted = [F.struct(F.lit(i).alias("i"), F.lit(p).alias("p"), ((n - 1) * p).alias("pos"), at(p, -1).alias("lo"),
                       at(p, 1).alias("hi")) for i, p in enumerate(probs)]
    return rows.select(*by, "column", F.array(*wanted).alias("t"))


def quantiles(df: DataFrame, value_cols: Sequence[str] | str, probs: Sequence[float],
              by: Sequence[str] = (), *, k: int = SKETCH) -> DataFrame:
    cols = [value_cols] if isinstance(value_cols, str) else list(value_cols)
    by, probs = list(by), [float(p) for p in probs]
    keys = by + ["column"]
    wanted, _n = sized(brackets(df, cols, probs, by, k))
    met = key_join(to_long(df, cols, by), wanted, keys)
    # One row per value: all that lie between two brackets (or below the first)
    # are one count, v NULL, before the values of the next bracket.
    zone = F.size(F.filter("t", lambda t: t["hi"] < F.col("v")))
    inside = F.exists("t", lambda t: (t["lo"] <= F.col("v")) & (F.col("v") <= t["hi"]))
    counts = (met.select(*keys, zone.alias("zone"), F.when(inside, F.col("v")).alias("v"))
              .groupBy(*keys, "zone", "v").agg(F.count(F.lit(1)).alias("cnt")))
    w = Window.partitionBy(*keys).orderBy("zone", F.col("v").asc_nulls_first())
    ranked = (counts.withColumn("upto", F.sum("cnt").over(w.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("first", F.col("upto") - F.col("cnt")).where(F.col("v").isNotNull()))
    low, high = F.floor("pos"), F.ceil("pos")

    def value(rank):
        return F.max(F.when((F.col("first") <= rank) & (rank < F.col("upto")), F.col("v")))

    own = F.filter("t", lambda t: (t["lo"] <= F.col("v")) & (F.col("v") <= t["hi"]))
    found = (key_join(ranked, wanted, keys).select(*keys, "v", "first", "upto", F.explode(own).alias("t"))
             .select(*keys, "v", "first", "upto", "t.i", "t.p", "t.pos")
             .groupBy(*keys, "i", "p", "pos").agg(value(low).alias("a"), value(high).alias("z")))
    q = (F.when(F.col("a").isNull() | F.col("z").isNull(), F.raise_error(F.lit("quantile bracket missed its rank")).cast("double"))
         .when(low == high, F.col("a"))
         .otherwise((high - F.col("pos")) * F.col("a") + (F.col("pos") - low) * F.col("z")))
    return found.select(*keys, "p", q.alias("q"))
