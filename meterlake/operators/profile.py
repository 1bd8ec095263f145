"""Profiling operators D2-D25 (+ B5, B8, B10, B11, F4).

Every statistic is a partial-aggregated ``agg`` (one pass, bounded state)
or the exact quantile operator; per-row comparisons against a statistic use
scalar subqueries, per-column ones a broadcast of the (column-count sized)
statistics table.  Outputs are long tables so many columns profile in one
pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators.quantile import quantiles, sized, to_long

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns by type (plan-time)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def _kind(dt: T.DataType) -> str:
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "double"
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return "string" if isinstance(dt, T.StringType) else dt.simpleString()


def schema_report(df: DataFrame) -> DataFrame:
    """(column, position, kind, non_null, rows) in one pass."""
    aggs = [F.count(F.lit(1)).alias("__rows")] + [F.count(F.col(f"`{c}`")).alias(c)
                                                   for c in df.columns]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"),
                     F.lit(_kind(f.dataType)).alias("kind"), F.col(f"`{c}`").alias("non_null"),
                     F.col("__rows").alias("rows"))
            for i, (c, f) in enumerate(zip(df.columns, df.schema.fields))]
    return one.select(F.inline(F.array(*rows)))


def preview(df: DataFrame, n: int = 5, key: str = "row_id") -> DataFrame:
    """First ``n`` rows by an explicit key (TakeOrderedAndProject)."""
    return df.orderBy(key).limit(n)


def mean_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean per group, sorted descending."""
    return (df.groupBy(key).agg(F.avg(value).alias("mean"))
            .orderBy(F.desc("mean"), key))


def mean_by_ordered(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """Mean per group, reordered by a fixed list (absent groups dropped).

    The template has ``len(order)`` rows (a proven bound) and is broadcast.
    """
    spark = df.sparkSession
    tmpl = spark.createDataFrame(list(enumerate(order)), f"position int, {key} string")
    means = df.groupBy(key).agg(F.avg(value).alias("mean"))
    return means.join(F.broadcast(tmpl), key).select("position", key, "mean").orderBy("position")


def mean_by_time(df: DataFrame, ts: str, value: str, unit: str | None = None) -> DataFrame:
    """Mean per timestamp (``unit=None``, literal behaviour) or per truncated unit."""
    key = F.col(ts) if unit is None else F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz")
    return (df.where(F.col(ts).isNotNull()).groupBy(key.alias(ts))
            .agg(F.avg(value).alias("mean")).orderBy(ts))


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One pass: count, mean, sample/population std, min, max, skew, kurt per column."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.stddev_pop(x).alias(f"{c}__std_pop"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 F.skewness(x).alias(f"{c}__g1"), F.kurtosis(x).alias(f"{c}__g2")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"),
                     *[F.col(f"{c}__{s}").alias(s) for s in
                       ("n", "mean", "std", "std_pop", "min", "max", "g1", "g2")])
            for c in cols]
    m = one.select(F.inline(F.array(*rows)))
    n = F.col("n").cast("double")
    # pandas skew / kurt are the bias-corrected G1 / G2
    g1 = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    g2 = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6))
    return m.withColumn("skew", g1).withColumn("kurt", g2).drop("g1", "g2")


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std (n-1), min, 25/50/75 % (exact), max per column."""
    m = moments(df, cols).select("column", "n", "mean", "std", "min", "max")
    q = (quantiles(df, cols, [0.25, 0.5, 0.75])
         .groupBy("column").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q")))
    q = q.toDF("column", "q25", "q50", "q75")
    return m.join(q, "column", "left").select(
        "column", F.col("n").alias("count"), "mean", "std", "min", "q25", "q50", "q75", "max")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n, pct) with pct of the column's non-null total."""
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot([], list(cols), "column", "value").where(F.col("value").isNotNull()))
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    # totals: one row per profiled column (bounded by the schema) -> broadcast;
    # a window per column would put a high-cardinality column in one task
    totals = counts.groupBy("column").agg(F.sum("n").alias("_total"))
    return (counts.join(F.broadcast(totals), "column")
            .select("column", "value", "n", (F.col("n") * 100.0 / F.col("_total")).alias("pct")))


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, unique, top (ties -> smallest), freq per column."""
    vc = value_counts(df, cols)
    return vc.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min(F.struct((-F.col("n")).alias("k"), F.col("value").alias("v"))).alias("b")
    ).select("column", "count", "unique", F.col("b.v").alias("top"), (-F.col("b.k")).alias("freq"))


def n_unique(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-null count per column (``approx`` -> HyperLogLog++)."""
    fn = F.approx_count_distinct if approx else F.count_distinct
    one = df.agg(*[fn(F.col(c)).alias(c) for c in cols])
    return one.unpivot([], list(cols), "column", "n_unique")


def distinct_values(df: DataFrame, cols: Sequence[str], stage: str | None = None,
                    ordered: bool = True) -> DataFrame:
    """Sorted distinct values per column (``ordered=False`` for a part of
    a union, which would discard the order)."""
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot([], list(cols), "column", "value").distinct())
    if stage is not None:
        long = long.withColumn("stage", F.lit(stage))
    return long.orderBy("column", "value") if ordered else long


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL count per column in one pass (long)."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    return one.unpivot([], cols, "column", "nulls")


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier identical row (NULLs equal).

    Map-side combine collapses a hot duplicate group before the shuffle.
    """
    cols = list(cols or df.columns)
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
                 F.count(F.lit(1)).alias("distinct_rows"))


def date_span(df: DataFrame, ts: str) -> DataFrame:
    """Min, max and whole days between them."""
    return df.agg(F.min(ts).alias("min_date"), F.max(ts).alias("max_date")).select(
        "min_date", "max_date",
        F.timestamp_diff("DAY", F.col("min_date"), F.col("max_date")).alias("days"))


def quartiles(df: DataFrame, cols: Sequence[str]) -> dict[str, dict[float, float]]:
    """{column: {p: value}} for p = 0.25, 0.5, 0.75: three numbers per column,
    applied afterwards as literals."""
    out: dict[str, dict[float, float]] = {}
    for r in quantiles(df, cols, [0.25, 0.5, 0.75]).select("column", "p", "q").collect():
        out.setdefault(r["column"], {})[r["p"]] = r["q"]
    return out


def iqr_outliers(df: DataFrame, cols: Sequence[str],
                 known: dict[str, dict[float, float]] | None = None) -> DataFrame:
    """Quartiles, IQR, Tukey bounds, outlier count and % of all rows; the
    counts of all columns in one pass.  A column without values has a row too
    (NULL statistics, no outlier)."""
    found = known if known is not None else quartiles(df, cols)
    stats = []
    for c in cols:
        q1, q3 = (found[c][0.25], found[c][0.75]) if c in found else (None, None)
        stats.append((c, q1, q3, *((q3 - q1, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)) if c in found else [None] * 3)))
    outside = []
    for i, (c, *_b, lo, hi) in enumerate(stats):
        x = F.col(c).cast("double")
        out = ~F.isnan(x) & ((x < F.lit(lo)) | (x > F.lit(hi))) if lo is not None else F.lit(False)
        outside.append(F.count_if(out).alias(f"_o{i}"))
    one = df.agg(F.count(F.lit(1)).alias("_n"), *outside)
    names = ["column", "q1", "q3", "iqr", "lower", "upper"]
    rows = [F.struct(F.lit(s[0]).alias("column"), *[F.lit(v).cast("double").alias(k) for k, v in zip(names[1:], s[1:])],
                     F.col(f"_o{i}").alias("n_out"),
                     F.try_divide(F.col(f"_o{i}") * 100.0, F.col("_n")).alias("pct"))
            for i, s in enumerate(stats)]
    return one.select(F.inline(F.array(*rows)))


def zscore_outliers(df: DataFrame, cols: Sequence[str], z: float = 3.0) -> DataFrame:
    """|z| > 3 with population std; % over all rows."""
    m, _n = sized(moments(df, cols).select("column", "mean", "std_pop"))   # one row per column
    long = to_long(df, cols)
    total = df.select(F.count(F.lit(1))).scalar()
    zc = F.abs(F.try_divide(F.col("v") - F.col("mean"), F.col("std_pop")))   # constant column -> NULL
    cnt = (long.join(m, "column").groupBy("column")
           .agg(F.count_if(zc > z).alias("n_out")))
    return (m.join(cnt, "column", "left").withColumn("n_out", F.coalesce("n_out", F.lit(0)))
            .withColumn("pct", F.try_divide(F.col("n_out") * 100.0, total)))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation, long (a, b, r), one pass."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{k}")
                   for k, (a, b) in enumerate(pairs)])
    rows = []
    for k, (a, b) in enumerate(pairs):
        rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{k}").alias("r")))
        if a != b:
            rows.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"p{k}").alias("r")))
    return one.select(F.inline(F.array(*rows)))


def corr_matrix_wide(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D16 for tables of hundreds of columns: (a, b, r) for a <= b in the order of
    ``cols``; NULL where fewer than two rows have both, or one does not vary.

    ``corr_matrix`` asks for one aggregate expression a pair; this adds up four
    p x p matrices instead (``gram.pairwise_corr``)."""
    from meterlake.operators.gram import pairwise_corr

    cols = list(cols)
    r = pairwise_corr(df, cols)
    return df.sparkSession.createDataFrame(
        [(a, cols[j], None if math.isnan(r[i, j]) else float(r[i, j])) for i, a in enumerate(cols)
         for j in range(i, len(cols))], "a string, b string, r double")


def distinct_sketches(df: DataFrame, cols: Sequence[str], part: Column, lg_size: int = 12) -> DataFrame:
    """One mergeable distinct-count sketch per part (a day, a month) and
    column, stored; new parts are added without reading old ones."""
    from meterlake.session import scratch_path

    path = scratch_path(df.sparkSession, "distinct_sketches")
    wide = df.groupBy(part.alias("part")).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), lg_size).alias(c) for c in cols])
    wide.unpivot(["part"], list(cols), "column", "sketch").write.parquet(path)
    return df.sparkSession.read.parquet(path)


def united_estimates(sketches: DataFrame) -> DataFrame:
    """(column, parts, estimate) from stored sketches alone."""
    return sketches.groupBy("column").agg(F.count(F.lit(1)).alias("parts"), F.hll_sketch_estimate(
        F.hll_union_agg("sketch")).alias("estimate"))


def strong_corr(corr: DataFrame, threshold: float = 0.5) -> DataFrame:
    """|r| > threshold (self pairs kept), sorted by r desc."""
    return corr.where(F.abs("r") > threshold).orderBy(F.desc("r"), "a", "b")


def corr_rank_slice(corr: DataFrame, target: str, start: int = 2, stop: int = 4) -> DataFrame:
    """ranks start..stop of |r| with ``target`` (rank 1 is the target itself)."""
    w = Window.orderBy(F.desc("abs_r"), F.col("column"))
    ranked = (corr.where((F.col("a") == target) & F.col("r").isNotNull())
              .select(F.col("b").alias("column"), F.abs("r").alias("abs_r"))
              .withColumn("rank", F.row_number().over(w)))
    return ranked.where(F.col("rank").between(start, stop))


def _finite(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(F.abs(x) < float("inf"), x)  # NaN compares greater


def _range_scalar(df: DataFrame, c: str) -> Column:
    """Least and greatest finite value and their number; a constant column's
    range is widened by a half on either side."""
    x = _finite(c)
    one = F.min(x) == F.max(x)
    return df.agg(F.struct(F.when(one, F.min(x) - 0.5).otherwise(F.min(x)).alias("mn"),
                           F.when(one, F.max(x) + 0.5).otherwise(F.max(x)).alias("mx"),
                           F.count(x).alias("n")).alias("s")).scalar()


def histogram(df: DataFrame, c: str, bins: int = 50, density: bool = False) -> DataFrame:
    """Equal-width bins over [min, max], last bin right-closed,
    empty bins included.  Values that are not finite are left out."""
    spark = df.sparkSession
    s = _range_scalar(df, c)
    mn, mx, n = s.getField("mn"), s.getField("mx"), s.getField("n")
    width = (mx - mn) / bins
    v = _finite(c)
    b = F.least(F.floor((v - mn) / (mx - mn) * bins), F.lit(bins - 1)).cast("int")
    counts = df.where(v.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = (grid.join(counts, "bin", "left").select(
        "bin", (mn + F.col("bin") * width).alias("lo"), (mn + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n")))
    if density:
        out = out.withColumn("density", F.try_divide(F.col("n"), n * width))
    return out.orderBy("bin")


def normal_overlay(df: DataFrame, c: str, points: int = 100) -> DataFrame:
    """Normal pdf (sample mean / std) on an even grid over [min, max]."""
    spark = df.sparkSession
    s = df.agg(F.struct(F.min(c).alias("mn"), F.max(c).alias("mx"), F.avg(c).alias("mu"),
                        F.stddev_samp(c).alias("sd")).alias("s")).scalar()
    mn, mx = s.getField("mn").cast("double"), s.getField("mx").cast("double")
    mu, sd = s.getField("mu"), s.getField("sd")
    x = mn + F.col("i") * (mx - mn) / (points - 1)
    g = spark.range(points).select(F.col("id").cast("int").alias("i"))
    pdf = F.try_divide(F.exp(-0.5 * F.pow(F.try_divide(x - mu, sd), 2)), sd * F.lit(math.sqrt(2 * math.pi)))
    return g.select("i", x.alias("x"), pdf.alias("pdf"))


def boxplot_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers at the furthest point within 1.5 IQR, flier count;
    a column without values has NULLs and no flier."""
    q = (quantiles(df, cols, [0.25, 0.5, 0.75]).groupBy("column").pivot("p", [0.25, 0.5, 0.75])
         .agg(F.first("q")).toDF("column", "q1", "med", "q3"))
    b, _n = sized(q.withColumn("lo_f", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")))
                  .withColumn("hi_f", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))))   # per column
    long = to_long(df, cols)
    v = F.col("v")
    agg = (long.join(b.select("column", "lo_f", "hi_f"), "column").groupBy("column").agg(
        F.min(F.when(v >= F.col("lo_f"), v)).alias("whisker_lo"),
        F.max(F.when(v <= F.col("hi_f"), v)).alias("whisker_hi"),
        F.count_if((v < F.col("lo_f")) | (v > F.col("hi_f"))).alias("fliers")))
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return every.join(b, "column", "left").join(agg, "column", "left").select(
        "column", "q1", "med", "q3", "whisker_lo", "whisker_hi", F.coalesce("fliers", F.lit(0)).alias("fliers"))


def summary_stats(df: DataFrame, c: str) -> DataFrame:
    """Mean, median, std, skew, kurtosis, min, max, range."""
    m = moments(df, [c])
    med = quantiles(df, [c], [0.5]).select("column", F.col("q").alias("median"))
    return m.join(med, "column", "left").select(
        "column", "mean", "median", "std", "skew", "kurt", "min", "max",
        (F.col("max") - F.col("min")).alias("range"))


def prediction_stats(df: DataFrame, c: str) -> DataFrame:
    """Mean, population std, min, max, median of a prediction column."""
    m = moments(df, [c])
    med = quantiles(df, [c], [0.5]).select("column", F.col("q").alias("median"))
    return m.join(med, "column", "left").select(
        F.col("n").alias("count"), "mean", F.col("std_pop").alias("std"), "min", "max", "median")


def completeness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """1 - nulls / (rows * columns)."""
    cols = list(cols or df.columns)
    nulls = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in cols), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("rows"), nulls.alias("nulls")).select(
        "rows", "nulls", (1 - F.try_divide(F.col("nulls"), F.col("rows") * len(cols))).alias("completeness"))


def fill_global_median(df: DataFrame, c: str) -> DataFrame:
    """NULL -> global exact median (scalar subquery, no join)."""
    med = quantiles(df, [c], [0.5]).select("q").scalar()
    return df.withColumn(c, F.coalesce(F.col(c), med))


def eda_report(spark: SparkSession, df: DataFrame, target: str, cats: Sequence[str],
               nums: Sequence[str]) -> DataFrame:
    """The summary report as long (section, metric, value) rows."""
    def rows(section, d: DataFrame, cols):
        return d.select(F.inline(F.array(*[F.struct(F.lit(section).alias("section"),
                                                    F.lit(k).alias("metric"),
                                                    F.col(k).cast("double").alias("value"))
                                           for k in cols])))
    overview = df.agg(F.count(F.lit(1)).alias("records"),
                      F.lit(len(df.columns)).alias("features"),
                      F.lit(len(nums)).alias("numeric_features"),
                      F.lit(len(cats)).alias("categorical_features"))
    quart = quartiles(df, [target])  # once, for the median and the bounds
    median = F.lit(quart.get(target, {}).get(0.5)).cast("double")
    tgt = moments(df, [target]).select("mean", median.alias("median"), "std", "skew")
    iqr = iqr_outliers(df, [target], quart).select(F.col("n_out").alias("outliers_iqr"),
                                            F.col("pct").alias("outliers_iqr_pct"))
    uniq = n_unique(df, cats).groupBy().pivot("column", list(cats)).agg(F.first("n_unique"))
    uniq = uniq.toDF(*[f"unique_{c}" for c in cats])
    missing = null_counts(df).agg(F.sum("nulls").alias("missing_values"))
    dups = duplicate_rows(df, [c for c in df.columns if c != "row_id"]).select("duplicate_rows")
    return (rows("overview", overview, overview.columns)
            .unionByName(rows("target", tgt, tgt.columns))
            .unionByName(rows("target", iqr, iqr.columns))
            .unionByName(rows("categorical", uniq, uniq.columns))
            .unionByName(rows("quality", missing, missing.columns))
            .unionByName(rows("quality", dups, dups.columns)))
