"""Registered queries: sources, scalar functions, cleaning (A, B, H, I, C1, D1, D20, D21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake import schema as S
from meterlake.functions import expr as X
from meterlake.operators import clean as C
from meterlake.plans import oracle as O
from meterlake.plans import views as V
from meterlake.plans.registry import register

NUMS = S.NUMERIC
NUM_NO_NSM = [c for c in NUMS if c != S.NSM]


@register("coerce_numeric", O.rounded(O.with_(O.CHAIN_TYPED, "SELECT row_id, "
          + ", ".join(NUMS) + " FROM meter_typed"), NUMS))
def coerce_numeric(spark, sf):
    """H1: text -> DOUBLE, unparsable / NaN -> NULL."""
    raw = V.meter_raw(spark, sf)
    return raw.select(S.ROW_ID, *[X.to_double_or_null(c).alias(c) for c in NUMS])


@register("coerce_timestamp", O.with_(
    O.CHAIN_TYPED, "SELECT r.row_id, r.date AS date_text, t.date AS date "
    "FROM meter_raw r JOIN meter_typed t ON r.row_id = t.row_id"))
def coerce_timestamp(spark, sf):
    """H2: text -> TIMESTAMP_NTZ, unparsable -> NULL."""
    raw = V.meter_raw(spark, sf)
    return raw.select(S.ROW_ID, F.col(S.DATE).alias("date_text"),
                      X.to_timestamp_or_null(S.DATE).alias(S.DATE))


@register("normalize_text", O.with_(O.CHAIN_TYPED, "SELECT row_id, " + ", ".join(
    f"upper(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')) AS {c}" for c in S.CATEGORICAL)
    + " FROM meter_raw"))
def normalize_text(spark, sf):
    """H4: upper-case + strip all surrounding whitespace."""
    raw = V.meter_raw(spark, sf)
    return raw.select(S.ROW_ID, *[X.normalize_text(c).alias(c) for c in S.CATEGORICAL])


@register("clean_types", O.rounded(O.with_(O.CHAIN_TYPED, "SELECT * FROM meter_typed"), NUMS))
def clean_types(spark, sf):
    """I0."""
    return V.meter_typed(spark, sf)


@register("column_mode", O.with_(
    O.CHAIN_CAT,
    " UNION ALL ".join(
        f"SELECT '{c}' AS column, coalesce((SELECT {c} FROM meter_norm WHERE {c} IS NOT NULL "
        f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1), 'UNKNOWN') AS mode"
        for c in S.CATEGORICAL)))
def column_mode(spark, sf):
    """Mode per categorical column, ties -> smallest, none -> UNKNOWN."""
    norm = C.normalized_categoricals(V.meter_typed(spark, sf))
    m = C.column_modes(norm, S.CATEGORICAL)
    cols = spark.createDataFrame([(c,) for c in S.CATEGORICAL], "column string")
    return (cols.join(m, "column", "left")
            .select("column", F.coalesce("mode", F.lit(C.UNKNOWN)).alias("mode")))


@register("clean_categoricals", O.rounded(O.with_(O.CHAIN_CAT, "SELECT * FROM meter_cat"), NUMS))
def clean_categoricals(spark, sf):
    """I1."""
    return V.meter_cat(spark, sf)


@register("median_by_group", O.rounded(O.with_(
    O.CHAIN_CAT, "SELECT load_type, quantile_cont(usage_kwh, 0.5) AS median "
    "FROM meter_cat GROUP BY load_type"), ["median"]))
def median_by_group(spark, sf):
    """Exact median of the target per load type."""
    return C.group_median(V.meter_cat(spark, sf), S.TARGET, S.LOAD_TYPE)


@register("fill_group_median", O.rounded(O.with_(
    O.CHAIN_FILLED, "SELECT row_id, load_type, usage_kwh FROM meter_filled"), [S.TARGET]))
def fill_group_median(spark, sf):
    """NULL target -> median of its load type (left equi-join)."""
    return C.fill_group_median(V.meter_cat(spark, sf)).select(S.ROW_ID, S.LOAD_TYPE, S.TARGET)


@register("fill_zero", O.rounded(O.with_(
    O.CHAIN_TYPED, "SELECT row_id, " + ", ".join(
        f"coalesce({O.num(c)}, 0.0) AS {c}" for c in NUMS if c != S.TARGET)
    + " FROM meter_raw"), [c for c in NUMS if c != S.TARGET]))
def fill_zero(spark, sf):
    """H6: fillna(0) on the non-target numerics."""
    t = V.meter_typed(spark, sf)
    return t.select(S.ROW_ID, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c)
                                for c in NUMS if c != S.TARGET])


@register("clean_nulls", O.rounded(O.with_(O.CHAIN_FILLED, "SELECT * FROM meter_filled"), NUMS))
def clean_nulls(spark, sf):
    """I2."""
    return V.meter_filled(spark, sf)


@register("clean_rules", O.rounded(O.with_(O.CHAIN_CLEAN, "SELECT * FROM meter_ruled"), NUMS))
def clean_rules(spark, sf):
    """The seven quality rules in one projection."""
    return C.clean_rules(V.meter_filled(spark, sf))


@register("clean_job", O.rounded(O.with_(O.CHAIN_CLEAN, "SELECT * FROM meter_clean"),
                                      NUM_NO_NSM))
def clean_job(spark, sf):
    """The full cleaning job (flagship)."""
    return V.build_meter_clean(spark, sf)


@register("truncate_nsm", O.with_(O.CHAIN_CLEAN, "SELECT row_id, nsm FROM meter_clean"))
def truncate_nsm(spark, sf):
    """H3 / I4: DOUBLE -> BIGINT truncation of NSM after the rules."""
    return C.clean_final(C.clean_rules(V.meter_filled(spark, sf))).select(S.ROW_ID, S.NSM)


def _violations_sql():
    from meterlake.functions.rules import QUALITY_RULES
    parts = []
    for r in QUALITY_RULES:
        c = r.column
        parts.append(
            f"SELECT '{c}' AS column, CAST({float(r.cap)} AS DOUBLE) AS max_allowed, "
            f"CAST(count(*) FILTER (WHERE {c} > {r.cap}) AS BIGINT) AS before, "
            f"CAST(count(*) FILTER (WHERE ({O.rule(c)}) > {r.cap}) AS BIGINT) AS after, "
            f"min({O.rule(c)}) AS min_after, max({O.rule(c)}) AS max_after FROM meter_filled")
    return O.rounded(O.with_(O.CHAIN_FILLED, " UNION ALL ".join(parts)),
                     ["max_allowed", "min_after", "max_after"])


@register("rule_violations", _violations_sql())
def rule_violations(spark, sf):
    """Violations before/after each quality rule, one pass."""
    return C.rule_violations(V.meter_filled(spark, sf))


@register("nanlike_count", O.with_(O.CHAIN_TYPED, " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE upper(trim({c})) IN "
    f"('NAN','NA','NONE','NULL','') OR {c} IS NULL) AS BIGINT) AS n FROM meter_raw"
    for c in S.CATEGORICAL)))
def nanlike_count(spark, sf):
    """Membership + null predicate count per categorical column."""
    raw = V.meter_raw(spark, sf)
    aggs = [F.count(F.when(X.normalize_text(c).isin(*X.NULL_TOKENS) | F.col(c).isNull(), 1)).alias(c)
            for c in S.CATEGORICAL]
    return raw.agg(*aggs).unpivot([], S.CATEGORICAL, "column", "n")


@register("drop_if_present", O.rounded(O.with_(O.CHAIN_TYPED, "SELECT row_id, date, " + ", ".join(
    f"{O.num(c)} AS {c}" for c in NUMS) + ", " + ", ".join(S.CATEGORICAL) + " FROM meter_raw"), NUMS))
def drop_if_present(spark, sf):
    """B2: a junk column is dropped if present; dropping an absent name is a
    no-op."""
    junk = F.concat_ws("/", S.DATE, S.ROW_ID)
    raw = (V.meter_raw(spark, sf).withColumn("mixed_type_col", junk)
           .drop("mixed_type_col", "column_that_is_not_there"))
    # numeric text compared as DOUBLE (its text form is engine-specific)
    return raw.select(*[X.to_double_or_null(c).alias(c) if c in NUMS else F.col(c) for c in raw.columns])


@register("rename_map", O.rounded(O.with_(
    O.CHAIN_CLEAN, "SELECT row_id, " + ", ".join(f'{c} AS "{S.CSV_NAMES[c]}"' for c in S.METER_COLUMNS)
    + " FROM meter_clean"), [f'"{S.CSV_NAMES[c]}"' for c in S.NUMERIC if c != S.NSM]))
def rename_map(spark, sf):
    """Rename by map (internal -> file names with dots and parentheses)."""
    from meterlake.sources.io import to_file_names
    return to_file_names(V.meter_clean(spark, sf))
