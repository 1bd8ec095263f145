"""Cleaning pipeline I0-I5: coerce types, normalise categoricals and fill
them with their mode, fill numeric gaps (target: median of its load type),
apply the quality rules, truncate NSM.

Statistics are computed by distributed aggregations and applied without
joins where they are global (scalar subqueries), and by an equi-join where
they are per group (broadcast behind a row-count check; beyond it a shuffle
join whose skewed partitions AQE splits).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake import schema as S
from meterlake.functions import expr as X
from meterlake.functions.rules import QUALITY_RULES, apply_rule
from meterlake.operators.quantile import quantiles, sized

UNKNOWN = "UNKNOWN"


def present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Keep only listed columns that exist (plan-time, no job)."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def clean_types(raw: DataFrame, date_formats: Sequence[str] = (X.TS_FORMAT,)) -> DataFrame:
    """Numerics -> DOUBLE (bad -> NULL), date -> TIMESTAMP_NTZ (bad -> NULL)."""
    out = []
    for c in raw.columns:
        if c in S.NUMERIC:
            out.append(X.to_double_or_null(c).alias(c))
        elif c == S.DATE:
            out.append(X.to_timestamp_or_null(c, *date_formats).alias(c))
        else:
            out.append(F.col(c))
    return raw.select(*out)


def normalized_categoricals(df: DataFrame, cols: Sequence[str] = S.CATEGORICAL) -> DataFrame:
    cols = present(df, cols)
    return df.select(*[X.null_tokens(X.normalize_text(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, mode, freq): most frequent non-null value, ties -> smallest.

    Counting is a map-side combined aggregation on (column, value), so a
    high-cardinality column is spread over all tasks; the pick is a min over
    a (-count, value) struct, again partial-aggregated.
    """
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot([], list(cols), "column", "value").where(F.col("value").isNotNull()))
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("value"))).alias("b"))
    return best.select("column", F.col("b.value").alias("mode"), (-F.col("b.neg_n")).alias("freq"))


def clean_categoricals(df: DataFrame, cols: Sequence[str] = S.CATEGORICAL) -> DataFrame:
    """Normalise text, tokens -> NULL, fill with the column mode (else UNKNOWN)."""
    return fill_modes(normalized_categoricals(df, present(df, cols)), cols)


def fill_modes(norm: DataFrame, cols: Sequence[str] = S.CATEGORICAL) -> DataFrame:
    """I1 second half on already-normalised columns: NULL -> mode, else UNKNOWN."""
    cols = present(norm, cols)
    if not cols:
        return norm
    # one job for all columns; the result is one value per column (bounded by
    # the schema) and is applied as literals, like a fitted parameter
    modes = {r["column"]: r["mode"] for r in column_modes(norm, cols).collect()}
    return norm.select(*[F.coalesce(F.col(c), F.lit(modes.get(c) or UNKNOWN)).alias(c)
                         if c in cols else F.col(c) for c in norm.columns])


def group_median(df: DataFrame, value: str, by: str) -> DataFrame:
    """Exact median of ``value`` per ``by`` -> (by, median)."""
    q = quantiles(df, [value], [0.5], [by])
    return q.select(by, F.col("q").alias("median"))


def fill_group_median(df: DataFrame, value: str = S.TARGET, by: str = S.LOAD_TYPE,
                      global_fallback: bool = False) -> DataFrame:
    """NULL ``value`` -> median of its ``by`` group (left equi-join).

    ``global_fallback`` also uses the global median when the group has no
    median (pandas ``Series.get`` default applies only to unseen keys, which
    cannot happen after I1, so it is off by default).
    """
    # one row per group: broadcast behind a size check (a hot group is never
    # shuffled by key), a plain join beyond it
    med, _n = sized(group_median(df, value, by).withColumnRenamed("median", "_grp_median"))
    filled = F.coalesce(F.col(value), F.col("_grp_median"))
    if global_fallback:
        g = quantiles(df, [value], [0.5]).select("q").scalar()
        filled = F.coalesce(filled, g)
    joined = df.join(med, by, "left")
    return joined.select(*[filled.alias(c) if c == value else F.col(c) for c in df.columns])


def clean_nulls(df: DataFrame) -> DataFrame:
    """Target -> group median by load type; other numerics -> 0."""
    out = df
    if S.TARGET in df.columns and S.LOAD_TYPE in df.columns:
        out = fill_group_median(out, S.TARGET, S.LOAD_TYPE)
    zero = [c for c in present(out, S.NUMERIC) if c != S.TARGET]
    return out.select(*[F.coalesce(F.col(c), F.lit(0.0)).alias(c) if c in zero else F.col(c)
                        for c in out.columns])


def clean_rules(df: DataFrame, rules=QUALITY_RULES) -> DataFrame:
    """All quality rules in one projection (rules are per column)."""
    by_col = {r.column: r for r in rules if r.column in df.columns}
    return df.select(*[apply_rule(by_col[c]).alias(c) if c in by_col else F.col(c)
                       for c in df.columns])


def clean_final(df: DataFrame) -> DataFrame:
    """I4: NSM -> BIGINT (truncation)."""
    return df.select(*[X.truncate_to_long(c).alias(c) if c == S.NSM else F.col(c)
                       for c in df.columns])


def clean(raw: DataFrame) -> DataFrame:
    """I0-I4 in order."""
    return clean_final(clean_rules(clean_nulls(clean_categoricals(clean_types(raw)))))


def rule_violations(typed_filled: DataFrame, rules=QUALITY_RULES) -> DataFrame:
    """Per rule, values above the cap before and after correction, and
    min / max after correction — one pass, long output."""
    rs = [r for r in rules if r.column in typed_filled.columns]
    aggs = []
    for i, r in enumerate(rs):
        c = F.col(r.column)
        fixed = apply_rule(r)
        aggs += [F.count(F.when(c > F.lit(r.cap), 1)).alias(f"b{i}"),
                 F.count(F.when(fixed > F.lit(r.cap), 1)).alias(f"a{i}"),
                 F.min(fixed).alias(f"mn{i}"), F.max(fixed).alias(f"mx{i}")]
    one = typed_filled.agg(*aggs)
    rows = [F.struct(F.lit(r.column).alias("column"), F.lit(float(r.cap)).alias("max_allowed"),
                     F.col(f"b{i}").alias("before"), F.col(f"a{i}").alias("after"),
                     F.col(f"mn{i}").alias("min_after"), F.col(f"mx{i}").alias("max_after"))
            for i, r in enumerate(rs)]
    return one.select(F.inline(F.array(*rows)))
