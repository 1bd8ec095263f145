"""Registered queries: profiling (B5, B8, B10, B11, D2-D25, F4) on the meter
view, plus volume runs on ``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake import schema as S
from meterlake.operators import profile as P
from meterlake.plans import oracle as O
from meterlake.plans import views as V
from meterlake.plans.registry import register

NUMS = S.NUMERIC
CATS = S.CATEGORICAL
LI_NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# Weekday names in calendar order (upper-cased as after cleaning).
WEEKDAYS = ["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY"]


def mc(body: str) -> str:
    return O.with_(O.CHAIN_CLEAN, body)


def li(spark, sf):
    return V.table(spark, sf, "lineitem")


def union(parts):
    return " UNION ALL ".join(parts)


# ---------------------------------------------------------------- B
@register("select_numeric", O.rounded(mc("SELECT row_id, " + ", ".join(NUMS) + " FROM meter_clean"),
                                      [c for c in NUMS if c != S.NSM]))
def select_numeric(spark, sf):
    """B5."""
    return P.select_numeric(V.meter_clean(spark, sf))


@register("preview", O.rounded(mc("SELECT * FROM meter_clean ORDER BY row_id LIMIT 5"),
                               [c for c in NUMS if c != S.NSM]))
def preview(spark, sf):
    """First 5 rows by row_id."""
    return P.preview(V.meter_clean(spark, sf), 5)


def _schema_sql():
    kinds = {"row_id": "bigint", "date": "timestamp", S.NSM: "bigint"}
    cols = ["row_id", "date", *NUMS, *CATS]
    parts = [f"SELECT '{c}' AS column, CAST({i} AS BIGINT) AS position, "
             f"'{kinds.get(c, 'string' if c in CATS else 'double')}' AS kind, "
             f"CAST(count({c}) AS BIGINT) AS non_null, CAST(count(*) AS BIGINT) AS rows FROM meter_clean"
             for i, c in enumerate(cols)]
    return mc(union(parts))


@register("schema_report", _schema_sql())
def schema_report(spark, sf):
    """B11."""
    return P.schema_report(V.meter_clean(spark, sf))


# ---------------------------------------------------------------- D2-D4
@register("mean_by_week", O.rounded(mc(
    "SELECT week_status, avg(usage_kwh) AS mean FROM meter_clean GROUP BY week_status"), ["mean"]))
def mean_by_week(spark, sf):
    """D2."""
    return P.mean_by(V.meter_clean(spark, sf), S.WEEK_STATUS, S.TARGET)


@register("mean_by_load", O.rounded(mc(
    "SELECT load_type, avg(usage_kwh) AS mean FROM meter_clean GROUP BY load_type"), ["mean"]))
def mean_by_load(spark, sf):
    """D2."""
    return P.mean_by(V.meter_clean(spark, sf), S.LOAD_TYPE, S.TARGET)


_days_values = ", ".join(f"({i}, '{d}')" for i, d in enumerate(WEEKDAYS))


@register("mean_by_day", O.rounded(mc(
    "SELECT CAST(t.position AS BIGINT) AS position, m.day_of_week, m.mean FROM "
    "(SELECT day_of_week, avg(usage_kwh) AS mean FROM meter_clean GROUP BY day_of_week) m "
    f"JOIN (VALUES {_days_values}) t(position, day_of_week) ON m.day_of_week = t.day_of_week"),
    ["mean"]))
def mean_by_day(spark, sf):
    """D3 + C5: mean per weekday in calendar order (order-template join)."""
    return P.mean_by_ordered(V.meter_clean(spark, sf), S.DAY_OF_WEEK, S.TARGET, WEEKDAYS)


@register("usage_by_ts", O.rounded(mc(
    "SELECT date, avg(usage_kwh) AS mean FROM meter_clean WHERE date IS NOT NULL GROUP BY date"),
    ["mean"]))
def usage_by_ts(spark, sf):
    """D4 (literal: groups by the full timestamp)."""
    return P.mean_by_time(V.meter_clean(spark, sf), S.DATE, S.TARGET)


@register("usage_by_day", O.rounded(mc(
    "SELECT CAST(date_trunc('day', date) AS TIMESTAMP) AS date, avg(usage_kwh) AS mean "
    "FROM meter_clean WHERE date IS NOT NULL GROUP BY 1"), ["mean"]))
def usage_by_day(spark, sf):
    """D4 (daily)."""
    return P.mean_by_time(V.meter_clean(spark, sf), S.DATE, S.TARGET, "day")


# ---------------------------------------------------------------- D5-D13
def _describe_sql(src, cols):
    return union(
        f"SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, avg({c}) AS mean, "
        f"stddev_samp({c}) AS std, min(CAST({c} AS DOUBLE)) AS min, "
        f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50, "
        f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75, max(CAST({c} AS DOUBLE)) AS max FROM {src}"
        for c in cols)


_DESC = ["mean", "std", "min", "q25", "q50", "q75", "max"]


@register("describe_numeric", O.rounded(mc(_describe_sql("meter_clean", NUMS)), _DESC))
def describe_numeric(spark, sf):
    """D5."""
    return P.describe_numeric(V.meter_clean(spark, sf), NUMS)


_LARGE_KEY = "CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_returnflag END"


@register("quantiles_large_groups", O.rounded(" UNION ALL ".join(
    f"SELECT {_LARGE_KEY} AS flag, '{c}' AS \"column\", {p} AS p, quantile_cont(CAST({c} AS DOUBLE), {p}) AS q "
    f"FROM lineitem GROUP BY 1" for c in ("l_extendedprice", "l_quantity") for p in (0.25, 0.5, 0.9)), ["p", "q"]))
def quantiles_large_groups(spark, sf):
    """Exact quantiles of groups far larger than their sketches, with a NULL key
    group that holds a third of all rows."""
    from meterlake.operators.quantile import quantiles
    rows = V.table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 != 0, F.col("l_returnflag")).alias("flag"),
        "l_extendedprice", "l_quantity")
    return quantiles(rows, ["l_extendedprice", "l_quantity"], [0.25, 0.5, 0.9], by=["flag"], k=200)


@register("n_unique_approx", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT date_trunc('month', l_shipdate)) AS parts, "
    f"count(DISTINCT {c}) AS exact, CAST(1 AS BIGINT) AS within_bound FROM lineitem"
    for c in ("l_orderkey", "l_partkey", "l_quantity")))
def n_unique_approx(spark, sf):
    """D9, approximate form: sketches stored per month, united without a rescan;
    the estimates lie within 5 % of the exact counts."""
    cols = ["l_orderkey", "l_partkey", "l_quantity"]
    rows = V.table(spark, sf, "lineitem")
    stored = P.distinct_sketches(rows, cols, F.date_trunc("month", "l_shipdate").cast("timestamp_ntz"))
    exact = P.n_unique(rows, cols).withColumnRenamed("n_unique", "exact")
    near = F.abs(F.col("estimate") - F.col("exact")) <= F.greatest(F.col("exact") * 0.05, F.lit(1))
    return P.united_estimates(stored).join(exact, "column").select(
        "column", "parts", "exact", near.cast("int").alias("within_bound"))


WIDE = 200
# Column k of the wide table over the cleaned meter table, the same in both engines.
WIDE_COLS = [f"CASE WHEN (row_id + {k}) % 7 = 0 THEN NULL ELSE CAST(usage_kwh AS DOUBLE) * {k % 5 + 1} + "
             f"(row_id * {k + 11}) % 97 END AS w{k}" for k in range(WIDE)]


@register("corr_matrix_wide", O.rounded(O.with_(O.CHAIN_CLEAN + [
    f"wide AS (SELECT row_id, {', '.join(WIDE_COLS)} FROM meter_clean)",
    f"long AS (SELECT row_id, f, substr(f, 2)::INT AS k, v FROM (UNPIVOT wide ON "
    f"{', '.join(f'w{k}' for k in range(WIDE))} INTO NAME f VALUE v))"],
    f"SELECT a, b, corr(x, y) AS r FROM (SELECT p.f AS a, q.f AS b, p.v AS x, q.v AS y, p.k AS i, q.k AS j FROM long p "
    f"JOIN long q ON p.row_id = q.row_id AND p.k <= q.k) GROUP BY a, b"), ["r"]))
def corr_matrix_wide(spark, sf):
    """D16 on 200 columns with NULLs: presence, sums and products of all pairs
    in one pass."""
    d = V.meter_clean(spark, sf).selectExpr("row_id", *WIDE_COLS)
    return P.corr_matrix_wide(d, [f"w{k}" for k in range(WIDE)])


@register("describe_numeric_lineitem", O.rounded(_describe_sql("lineitem", LI_NUMS), _DESC))
def describe_numeric_lineitem(spark, sf):
    """D5 volume run."""
    return P.describe_numeric(li(spark, sf), LI_NUMS)


_VC = ('SELECT "column", value, CAST(n AS BIGINT) AS n, '
       'n * 100.0 / sum(n) OVER (PARTITION BY "column") AS pct '
       'FROM (SELECT "column", value, count(*) AS n FROM (' + union(
           f"SELECT '{c}' AS column, CAST({c} AS VARCHAR) AS value FROM meter_clean" for c in CATS)
       + ") WHERE value IS NOT NULL GROUP BY 1, 2)")


@register("value_counts", O.rounded(mc(_VC), ["pct"]))
def value_counts(spark, sf):
    """D8."""
    return P.value_counts(V.meter_clean(spark, sf), CATS)


@register("describe_categorical", mc(
    'SELECT "column", CAST(sum(n) AS BIGINT) AS count, CAST(count(*) AS BIGINT) AS unique, '
    "arg_min(value, struct_pack(k := -n, v := value)) AS top, CAST(max(n) AS BIGINT) AS freq FROM ("
    + _VC + ') GROUP BY "column"'))
def describe_categorical(spark, sf):
    """D6."""
    return P.describe_categorical(V.meter_clean(spark, sf), CATS)


@register("n_unique", mc(union(
    f"SELECT '{c}' AS column, CAST(count(DISTINCT {c}) AS BIGINT) AS n_unique FROM meter_clean"
    for c in CATS)))
def n_unique(spark, sf):
    """D9."""
    return P.n_unique(V.meter_clean(spark, sf), CATS)


@register("distinct_values", mc(
    'SELECT DISTINCT "column", value, stage FROM (' + union(
        [f"SELECT '{c}' AS column, {c} AS value, 'raw' AS stage FROM meter_raw" for c in CATS]
        + [f"SELECT '{c}' AS column, {c} AS value, 'clean' AS stage FROM meter_clean" for c in CATS])
    + ")"))
def distinct_values(spark, sf):
    """Distinct categorical values before and after cleaning."""
    raw = P.distinct_values(V.meter_raw(spark, sf), CATS, "raw", ordered=False)
    cln = P.distinct_values(V.meter_clean(spark, sf), CATS, "clean", ordered=False)
    return raw.unionByName(cln)


_TYPED_COLS = ["date", *NUMS, *CATS]


@register("null_counts", O.with_(O.CHAIN_TYPED, union(
    f"SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM meter_typed"
    for c in _TYPED_COLS)))
def null_counts(spark, sf):
    """After type coercion."""
    return P.null_counts(V.meter_typed(spark, sf), _TYPED_COLS)


@register("duplicate_rows", mc(
    "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows, CAST(count(*) AS BIGINT) AS distinct_rows "
    "FROM (SELECT count(*) AS n FROM meter_clean GROUP BY ALL_COLS)".replace(
        "ALL_COLS", ", ".join(_TYPED_COLS))))
def duplicate_rows(spark, sf):
    """D12 on the meter view (row_id excluded)."""
    return P.duplicate_rows(V.meter_clean(spark, sf), _TYPED_COLS)


_LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("duplicate_rows_lineitem",
          "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows, CAST(count(*) AS BIGINT) "
          f"AS distinct_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY {', '.join(_LI_ALL)})")
def duplicate_rows_lineitem(spark, sf):
    """D12 volume run."""
    return P.duplicate_rows(li(spark, sf), _LI_ALL)


@register("duplicate_keys_lineitem",
          "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows, CAST(count(*) AS BIGINT) "
          "AS distinct_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def duplicate_keys_lineitem(spark, sf):
    """D12 on the (l_orderkey, l_linenumber) key."""
    return P.duplicate_rows(li(spark, sf), ["l_orderkey", "l_linenumber"])


@register("date_span", mc(
    "SELECT min(date) AS min_date, max(date) AS max_date, "
    "CAST(floor((epoch_us(max(date)) - epoch_us(min(date))) / 86400000000) AS BIGINT) AS days FROM meter_clean"))
def date_span(spark, sf):
    """D13."""
    return P.date_span(V.meter_clean(spark, sf), S.DATE)


# ---------------------------------------------------------------- D7, D14-D19
@register("usage_stats", O.rounded(mc(
    "SELECT 'usage_kwh' AS column, avg(usage_kwh) AS mean, quantile_cont(usage_kwh, 0.5) AS median, "
    "stddev_samp(usage_kwh) AS std, skewness(usage_kwh) AS skew, kurtosis(usage_kwh) AS kurt, "
    "min(usage_kwh) AS min, max(usage_kwh) AS max, max(usage_kwh) - min(usage_kwh) AS range FROM meter_clean"),
    ["mean", "median", "std", "skew", "kurt", "min", "max", "range"]))
def usage_stats(spark, sf):
    """D7 with bias-corrected skew / kurtosis."""
    return P.summary_stats(V.meter_clean(spark, sf), S.TARGET)


def _iqr_sql(src, c):
    return (f"SELECT '{c}' AS column, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, "
            f"q3 + 1.5 * (q3 - q1) AS upper, CAST(n_out AS BIGINT) AS n_out, n_out * 100.0 / total AS pct FROM "
            f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, count(*) AS total FROM {src}) s, "
            f"LATERAL (SELECT count(*) AS n_out FROM {src} WHERE {c} < s.q1 - 1.5 * (s.q3 - s.q1) "
            f"OR {c} > s.q3 + 1.5 * (s.q3 - s.q1))")


_IQR = ["q1", "q3", "iqr", "lower", "upper", "pct"]


@register("iqr_outliers", O.rounded(mc(_iqr_sql("meter_clean", S.TARGET)), _IQR))
def iqr_outliers(spark, sf):
    """D14 + B6."""
    return P.iqr_outliers(V.meter_clean(spark, sf), [S.TARGET])


@register("iqr_outliers_lineitem", O.rounded(_iqr_sql("lineitem", "l_extendedprice"), _IQR))
def iqr_outliers_lineitem(spark, sf):
    """D14 volume run."""
    return P.iqr_outliers(li(spark, sf), ["l_extendedprice"])


@register("filter_outliers", O.rounded(mc(
    "SELECT row_id, usage_kwh FROM meter_clean, (SELECT quantile_cont(usage_kwh, 0.25) AS q1, "
    "quantile_cont(usage_kwh, 0.75) AS q3 FROM meter_clean) s "
    "WHERE usage_kwh < q1 - 1.5 * (q3 - q1) OR usage_kwh > q3 + 1.5 * (q3 - q1)"), [S.TARGET]))
def filter_outliers(spark, sf):
    """Rows outside the Tukey bounds (bounds applied as a scalar subquery)."""
    from meterlake.operators.quantile import quantiles
    df = V.meter_clean(spark, sf)
    q = (quantiles(df, [S.TARGET], [0.25, 0.75]).groupBy()
         .agg(F.struct(F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
                       F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3")).alias("s"))).scalar()
    q1, q3 = q.getField("q1"), q.getField("q3")
    u = F.col(S.TARGET)
    return df.where((u < q1 - 1.5 * (q3 - q1)) | (u > q3 + 1.5 * (q3 - q1))).select(S.ROW_ID, S.TARGET)


@register("zscore_outliers", O.rounded(mc(
    "SELECT 'usage_kwh' AS column, mu AS mean, sd AS std_pop, CAST(n_out AS BIGINT) AS n_out, "
    "n_out * 100.0 / total AS pct FROM (SELECT avg(usage_kwh) AS mu, stddev_pop(usage_kwh) AS sd, "
    "count(*) AS total FROM meter_clean) s, LATERAL (SELECT count(*) AS n_out FROM meter_clean "
    "WHERE abs((usage_kwh - s.mu) / s.sd) > 3)"), ["mean", "std_pop", "pct"]))
def zscore_outliers(spark, sf):
    """D15."""
    return P.zscore_outliers(V.meter_clean(spark, sf), [S.TARGET])


def _corr_sql(src, cols):
    return union(f"SELECT '{a}' AS a, '{b}' AS b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r "
                 f"FROM {src}" for a in cols for b in cols)


@register("corr_matrix", O.rounded(mc(_corr_sql("meter_clean", NUMS)), ["r"]))
def corr_matrix(spark, sf):
    """D16."""
    return P.corr_matrix(V.meter_clean(spark, sf), NUMS)


@register("corr_matrix_lineitem", O.rounded(_corr_sql("lineitem", LI_NUMS), ["r"]))
def corr_matrix_lineitem(spark, sf):
    """D16 volume run."""
    return P.corr_matrix(li(spark, sf), LI_NUMS)


@register("strong_corr", O.rounded(mc(
    "SELECT * FROM (" + _corr_sql("meter_clean", NUMS) + ") WHERE abs(r) > 0.5"), ["r"]))
def strong_corr(spark, sf):
    """B8."""
    return P.strong_corr(P.corr_matrix(V.meter_clean(spark, sf), NUMS))


@register("corr_top3", O.rounded(mc(
    'SELECT "column", abs_r, CAST(rank AS BIGINT) AS rank FROM (SELECT b AS "column",' " abs(r) AS abs_r, "
    "row_number() OVER (ORDER BY abs(r) DESC, b) AS rank FROM ("
    + _corr_sql("meter_clean", NUMS) + ") WHERE a = 'usage_kwh' AND r IS NOT NULL) WHERE rank BETWEEN 2 AND 4"),
    ["abs_r"]))
def corr_top3(spark, sf):
    """2nd-4th strongest correlations with the target."""
    return P.corr_rank_slice(P.corr_matrix(V.meter_clean(spark, sf), NUMS), S.TARGET)


def _hist_sql(src, c, bins=50, density=False):
    dens = ", coalesce(h.n, 0) / (s.cnt * (s.mx - s.mn) / 50) AS density" if density else ""
    # NumPy's rules: values that are not finite are left out, a constant column's
    # range is widened by a half on either side.
    x = f"CASE WHEN isfinite(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END"
    ends = (f"(SELECT CASE WHEN a = z THEN a - 0.5 ELSE a END AS mn, CASE WHEN a = z THEN z + 0.5 ELSE z END AS mx, cnt "
            f"FROM (SELECT min({x}) AS a, max({x}) AS z, count({x}) AS cnt FROM {src}))")
    return (f"SELECT CAST(g.bin AS BIGINT) AS bin, s.mn + g.bin * ((s.mx - s.mn) / {bins}) AS lo, "
            f"s.mn + (g.bin + 1) * ((s.mx - s.mn) / {bins}) AS hi, CAST(coalesce(h.n, 0) AS BIGINT) AS n{dens} "
            f"FROM (SELECT range AS bin FROM range({bins})) g CROSS JOIN {ends} s "
            f"LEFT JOIN (SELECT CAST(least(floor(({x} - s2.mn) / (s2.mx - s2.mn) * {bins}), {bins - 1}) AS INT) AS bin, "
            f"count(*) AS n FROM {src}, {ends} s2 WHERE {x} IS NOT NULL GROUP BY 1) h ON h.bin = g.bin")


@register("histogram50", O.rounded(mc(_hist_sql("meter_clean", S.TARGET)), ["lo", "hi"]))
def histogram50(spark, sf):
    """D17."""
    return P.histogram(V.meter_clean(spark, sf), S.TARGET, 50)


_ODD_HIST = "(SELECT {} AS x FROM meter_clean)"
_WITH_INF = f"CASE row_id % 40 WHEN 0 THEN CAST('inf' AS DOUBLE) WHEN 1 THEN CAST('-inf' AS DOUBLE) WHEN 2 THEN CAST('nan' AS DOUBLE) ELSE {S.TARGET} END"


@register("histogram_constant", O.rounded(mc(_hist_sql(_ODD_HIST.format("CAST(7 AS DOUBLE)"), "x")), ["lo", "hi"]))
def histogram_constant(spark, sf):
    """D17 of a constant column: all rows in the middle bin of a range of 1."""
    return P.histogram(V.meter_clean(spark, sf).selectExpr("CAST(7 AS DOUBLE) AS x"), "x", 50)


@register("histogram_inf", O.rounded(mc(_hist_sql(_ODD_HIST.format(_WITH_INF), "x")), ["lo", "hi"]))
def histogram_inf(spark, sf):
    """D17 with infinite and NaN values: left out of range and counts."""
    return P.histogram(V.meter_clean(spark, sf).selectExpr(f"{_WITH_INF} AS x"), "x", 50)


@register("histogram50_lineitem", O.rounded(_hist_sql("lineitem", "l_extendedprice"), ["lo", "hi"]))
def histogram50_lineitem(spark, sf):
    """D17 volume run."""
    return P.histogram(li(spark, sf), "l_extendedprice", 50)


@register("histogram_density", O.rounded(mc(_hist_sql("meter_clean", S.TARGET, density=True)),
                                         ["lo", "hi", "density"]))
def histogram_density(spark, sf):
    """Density histogram."""
    return P.histogram(V.meter_clean(spark, sf), S.TARGET, 50, density=True)


@register("normal_overlay", O.rounded(mc(
    "SELECT CAST(range AS BIGINT) AS i, mn + range * (mx - mn) / 99 AS x, "
    "exp(-0.5 * pow(((mn + range * (mx - mn) / 99) - mu) / sd, 2)) / (sd * 2.5066282746310002) AS pdf "
    "FROM range(100), (SELECT CAST(min(usage_kwh) AS DOUBLE) AS mn, CAST(max(usage_kwh) AS DOUBLE) AS mx, "
    "avg(usage_kwh) AS mu, stddev_samp(usage_kwh) AS sd FROM meter_clean)"), ["x", "pdf"]))
def normal_overlay(spark, sf):
    """Fitted normal pdf on a 100-point grid."""
    return P.normal_overlay(V.meter_clean(spark, sf), S.TARGET, 100)


def _box_sql(src, cols):
    return union(
        f"SELECT '{c}' AS column, q1, med, q3, "
        f"(SELECT min(CAST({c} AS DOUBLE)) FROM {src} WHERE {c} >= q1 - 1.5 * (q3 - q1)) AS whisker_lo, "
        f"(SELECT max(CAST({c} AS DOUBLE)) FROM {src} WHERE {c} <= q3 + 1.5 * (q3 - q1)) AS whisker_hi, "
        f"(SELECT CAST(count(*) AS BIGINT) FROM {src} WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS fliers "
        f"FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS med, "
        f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {src})" for c in cols)


@register("boxplot_stats", O.rounded(mc(_box_sql("meter_clean", NUMS)),
                                     ["q1", "med", "q3", "whisker_lo", "whisker_hi"]))
def boxplot_stats(spark, sf):
    """D19."""
    return P.boxplot_stats(V.meter_clean(spark, sf), NUMS)


# ---------------------------------------------------------------- D22-D25
@register("prediction_stats", O.rounded(
    "SELECT CAST(count(y) AS BIGINT) AS count, avg(y) AS mean, stddev_pop(y) AS std, min(y) AS min, "
    "max(y) AS max, quantile_cont(y, 0.5) AS median FROM (SELECT l_quantity * 2100 AS y FROM lineitem)",
    ["mean", "std", "min", "max", "median"]))
def prediction_stats(spark, sf):
    """D22 on the lineitem stand-in predictions y_hat = l_quantity * 2100."""
    return P.prediction_stats(li(spark, sf).select((F.col("l_quantity") * 2100).alias("y")), "y")


@register("completeness", O.rounded(O.with_(
    O.CHAIN_TYPED, "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(" + " + ".join(
        f"count(*) FILTER (WHERE {c} IS NULL)" for c in _TYPED_COLS) + " AS BIGINT) AS nulls, "
    "1 - (" + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in _TYPED_COLS)
    + f") / (count(*) * {len(_TYPED_COLS)}) AS completeness FROM meter_typed"), ["completeness"]))
def completeness(spark, sf):
    """D23."""
    return P.completeness(V.meter_typed(spark, sf), _TYPED_COLS)


@register("fill_global_median", O.rounded(O.with_(
    O.CHAIN_TYPED, "SELECT row_id, coalesce(usage_kwh, (SELECT quantile_cont(usage_kwh, 0.5) FROM meter_typed)) "
    "AS usage_kwh FROM meter_typed"), [S.TARGET]))
def fill_global_median(spark, sf):
    """D24 (+ C2 scalar join)."""
    t = V.meter_typed(spark, sf).select(S.ROW_ID, S.TARGET)
    return P.fill_global_median(t, S.TARGET)


def _eda_sql():
    def rows(section, src, items):
        return union(f"SELECT '{section}' AS section, '{k}' AS metric, CAST({e} AS DOUBLE) AS value FROM {src}"
                     for k, e in items)
    cols = len(["row_id", *_TYPED_COLS])
    parts = [
        rows("overview", "meter_clean", [("records", "count(*)")]),
        rows("overview", "(SELECT 1)", [("features", str(cols)), ("numeric_features", str(len(NUMS))),
                                        ("categorical_features", str(len(CATS)))]),
        rows("target", "meter_clean", [("mean", "avg(usage_kwh)"), ("median", "quantile_cont(usage_kwh, 0.5)"),
                                       ("std", "stddev_samp(usage_kwh)"), ("skew", "skewness(usage_kwh)")]),
        rows("target", f"({_iqr_sql('meter_clean', S.TARGET)})",
             [("outliers_iqr", "n_out"), ("outliers_iqr_pct", "pct")]),
        rows("categorical", "meter_clean", [(f"unique_{c}", f"count(DISTINCT {c})") for c in CATS]),
        rows("quality", "meter_clean", [("missing_values", " + ".join(
            f"count(*) FILTER (WHERE {c} IS NULL)" for c in ["row_id", *_TYPED_COLS]))]),
        rows("quality", f"(SELECT count(*) AS n FROM meter_clean GROUP BY {', '.join(_TYPED_COLS)})",
             [("duplicate_rows", "coalesce(sum(n - 1), 0)")]),
    ]
    return O.rounded(mc(union(parts)), ["value"])


@register("eda_report", _eda_sql())
def eda_report(spark, sf):
    """The EDA summary as long (section, metric, value) rows."""
    return P.eda_report(spark, V.meter_clean(spark, sf), S.TARGET, CATS, NUMS)
