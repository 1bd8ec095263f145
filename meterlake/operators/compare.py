"""Table comparison G1: exact equality of two tables (NULL equals NULL).

* multiset form: both sides tagged +1 / -1, united and summed per full row:
  one shuffle, hot duplicate rows combine on the map side.
* keyed form: both sides are cut into ranges of the key and digested range by
  range; only rows of ranges whose digests differ are joined (full outer, ``<=>``
  per column), listing every differing cell as a long row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def table_equal(a: DataFrame, b: DataFrame, name: str = "table") -> DataFrame:
    """(table, rows_a, rows_b, only_in_a, only_in_b, equal); each side is read
    once."""
    cols = sorted(a.columns)
    if sorted(b.columns) != cols:
        raise ValueError(f"column sets differ: {sorted(a.columns)} vs {sorted(b.columns)}")
    both = (a.select(*cols, F.lit(1).cast("long").alias("_a"), F.lit(0).cast("long").alias("_b"))
            .unionAll(b.select(*cols, F.lit(0).cast("long").alias("_a"), F.lit(1).cast("long").alias("_b"))))
    per_row = both.groupBy(*cols).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    more = F.col("_a") - F.col("_b")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    out = per_row.agg(total(F.col("_a")).alias("rows_a"), total(F.col("_b")).alias("rows_b"),
                      total(F.greatest(more, F.lit(0))).alias("only_in_a"),
                      total(F.greatest(-more, F.lit(0))).alias("only_in_b"))
    return out.select(F.lit(name).alias("table"), "rows_a", "rows_b", "only_in_a", "only_in_b",
                      ((F.col("only_in_a") == 0) & (F.col("only_in_b") == 0)).cast("int").alias("equal"))


RANGES = 1024


def _range_of(a: DataFrame, b: DataFrame, key: str, ranges: int) -> tuple[Column, int | None, int | None]:
    """(number of a row's key range, least key, width): equal-width ranges of an
    integral key, so that a range is a filter a scan can prune by; hash buckets
    of any other key (width None)."""
    if not all(isinstance(d.schema[key].dataType, INTEGRAL) for d in (a, b)):
        return F.pmod(F.xxhash64(key), F.lit(ranges)), None, None
    ends = a.select(key).unionAll(b.select(key)).agg(F.min(key).alias("a"), F.max(key).alias("z")).first()
    low, high = ends["a"] or 0, ends["z"] or 0
    width = -(-(int(high) - int(low) + 1) // ranges)
    return F.floor((F.col(key).cast("decimal(20,0)") - F.lit(low)) / F.lit(width)).cast("long"), int(low), width


def range_digests(df: DataFrame, number: Column, key: str, cols: Sequence[str]) -> DataFrame:
    """(range, n, x, s) per key range, whatever the order of its rows: their
    number, the xor of their hashes and the sum of others.  A missing value
    hashes by its column."""
    def row(seed: int) -> Column:
        return F.xxhash64(F.lit(seed), *[F.when(F.col(c).isNull(), F.lit(-i)).otherwise(F.xxhash64(F.lit(i), F.col(c)))
                                         for i, c in enumerate([key, *cols], 1)])

    return df.groupBy(number.alias("range")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(row(1)).alias("x"), F.sum(row(2).cast("decimal(38,0)")).alias("s"))


def differing_ranges(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str], ranges: int = RANGES
                     ) -> tuple[list[int | None], Column]:
    """(numbers of the key ranges whose digests differ, condition for a row to
    lie in one).  At most ``ranges`` rows reach the driver."""
    number, low, width = _range_of(a, b, key, ranges)
    da = range_digests(a, number, key, cols)
    db = range_digests(b, number, key, cols).toDF("range_b", "n_b", "x_b", "s_b")
    same = F.col("n").eqNullSafe(F.col("n_b")) & F.col("x").eqNullSafe(F.col("x_b")) & F.col("s").eqNullSafe(F.col("s_b"))
    both = da.join(db, da["range"].eqNullSafe(db["range_b"]), "full_outer").where(~same)
    found = sorted({r[0] for r in both.select(F.coalesce("range", "range_b")).collect()}, key=lambda r: (r is None, r))
    keys, runs = [r for r in found if r is not None], []
    if width is None:
        inside = number.isin(keys) if keys else F.lit(False)
    else:
        for r in keys:  # neighbouring ranges are one interval of keys
            if runs and runs[-1][1] == r - 1:
                runs[-1][1] = r
            else:
                runs.append([r, r])
        inside = F.lit(False)
        for r, z in runs:
            inside = inside | F.col(key).between(low + r * width, low + (z + 1) * width - 1)
    return found, (inside | F.col(key).isNull()) if None in found else inside


def cell_diff(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str] | None = None,
              as_type: str = "string", ranges: int = RANGES) -> DataFrame:
    """Keyed variant: (key, column, value_a, value_b) for every differing cell,
    values cast to ``as_type`` after they were compared in their own types.  Rows
    of key ranges with equal digests (two 64-bit sums and a count) are not
    compared."""
    cols = [c for c in (cols or a.columns) if c != key]
    _, inside = differing_ranges(a, b, key, cols, ranges)
    aa = a.where(inside).select(key, *[F.col(c).alias(f"a__{c}") for c in cols])
    bb = b.where(inside).select(key, *[F.col(c).alias(f"b__{c}") for c in cols])
    j = aa.join(bb, key, "full_outer")
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"a__{c}").cast(as_type).alias("value_a"),
                     F.col(f"b__{c}").cast(as_type).alias("value_b"),
                     (~F.col(f"a__{c}").eqNullSafe(F.col(f"b__{c}"))).alias("differs"))
            for c in cols]
    return (j.select(key, F.inline(F.array(*rows))).where("differs")
            .drop("differs"))
