"""Registered queries: scalar feature functions (H8-H15), feature derivation
(J1-J9) and fitted transformers (K1-K12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake import schema as S
from meterlake.functions import expr as X
from meterlake.operators import features as FE
from meterlake.operators import prep as PR
from meterlake.plans import oracle as O
from meterlake.plans import views as V
from meterlake.plans.registry import register

CAL = S.CALENDAR
DOUBLE_FEATS = S.CYCLIC + S.POWER_FACTOR + S.REACTIVE + S.INTENSITY
BASE_DOUBLES = [c for c in S.NUMERIC if c != S.NSM]


def mf(body: str) -> str:
    return O.with_(O.CHAIN_FEATURES, body)


def feat_sql(cols, doubles):
    return O.rounded(mf("SELECT row_id, " + ", ".join(cols) + " FROM meter_features"), doubles)


@register("calendar_parts", feat_sql(CAL, []))
def calendar_parts(spark, sf):
    """Calendar columns, Monday-0 weekday, is_weekend."""
    return V.meter_clean(spark, sf).select(S.ROW_ID, *[v.alias(k) for k, v in FE.calendar().items()])


@register("feat_calendar", feat_sql(CAL, []))
def feat_calendar(spark, sf):
    """J1 out of the whole feature stage (the other features are pruned)."""
    return V.build_meter_features(spark, sf).select(S.ROW_ID, *CAL)


@register("cyclic_encode", feat_sql(S.CYCLIC, S.CYCLIC))
def cyclic_encode(spark, sf):
    """H10 / J2."""
    return V.meter_clean(spark, sf).select(S.ROW_ID, *[v.alias(k) for k, v in FE.cyclic_features().items()])


@register("feat_power_factor", feat_sql(S.POWER_FACTOR, S.POWER_FACTOR))
def feat_power_factor(spark, sf):
    """J3."""
    return V.meter_clean(spark, sf).select(S.ROW_ID, *[v.alias(k) for k, v in FE.power_factor().items()])


@register("feat_reactive", feat_sql(S.REACTIVE, S.REACTIVE))
def feat_reactive(spark, sf):
    """J4."""
    return V.meter_clean(spark, sf).select(S.ROW_ID, *[v.alias(k) for k, v in FE.reactive().items()])


@register("safe_ratio", feat_sql(["power_factor_ratio", "reactive_power_ratio", "co2_per_kwh", "nsm_per_kwh"],
                                 ["power_factor_ratio", "reactive_power_ratio", "co2_per_kwh", "nsm_per_kwh"]))
def safe_ratio(spark, sf):
    """A / (b + 1e-6)."""
    d = V.meter_clean(spark, sf)
    return d.select(S.ROW_ID, X.safe_ratio(S.LAG_PF, S.LEAD_PF).alias("power_factor_ratio"),
                    X.safe_ratio(S.LAG_REACTIVE, S.LEAD_REACTIVE).alias("reactive_power_ratio"),
                    X.safe_ratio(S.CO2, S.TARGET).alias("co2_per_kwh"),
                    X.safe_ratio(S.NSM, S.TARGET).alias("nsm_per_kwh"))


@register("pair_arith", feat_sql(["power_factor_diff", "avg_power_factor", "reactive_power_total",
                                  "reactive_power_diff"],
                                 ["power_factor_diff", "avg_power_factor", "reactive_power_total",
                                  "reactive_power_diff"]))
def pair_arith(spark, sf):
    """Sum, difference, mean of two columns."""
    made = {**FE.power_factor(), **FE.reactive()}
    return V.meter_clean(spark, sf).select(S.ROW_ID, *[made[c].alias(c) for c in (
        "power_factor_diff", "avg_power_factor", "reactive_power_total", "reactive_power_diff")])


@register("feat_intensity", feat_sql(S.INTENSITY + [S.HIGH_FLAG], S.INTENSITY))
def feat_intensity(spark, sf):
    """J5 + J6."""
    d = V.meter_clean(spark, sf)
    return d.select(S.ROW_ID, *[v.alias(k) for k, v in FE.intensity(d).items()])


@register("feat_high_flag", O.rounded(mf(
    "SELECT row_id, usage_kwh, is_high_consumption, (SELECT quantile_cont(usage_kwh, 0.5) FROM meter_clean) "
    "AS global_median FROM meter_features"), [S.TARGET, "global_median"]))
def feat_high_flag(spark, sf):
    """Strict > global median (scalar subquery)."""
    d = V.meter_clean(spark, sf)
    med = FE.global_median(d, S.TARGET)
    return d.select(S.ROW_ID, S.TARGET, X.flag(F.col(S.TARGET) > med).alias(S.HIGH_FLAG),
                    med.alias("global_median"))


@register("vs_global_median", O.rounded(mf(
    "SELECT row_id, usage_kwh - (SELECT quantile_cont(usage_kwh, 0.5) FROM meter_clean) AS diff_from_median "
    "FROM meter_clean"), ["diff_from_median"]))
def vs_global_median(spark, sf):
    """Every row against one global statistic."""
    d = V.meter_clean(spark, sf)
    return d.select(S.ROW_ID, (F.col(S.TARGET) - FE.global_median(d, S.TARGET)).alias("diff_from_median"))


_ALL_FEAT_COLS = ["row_id", "date", *S.NUMERIC, *S.CATEGORICAL, *S.ENGINEERED]


@register("feat_all", O.rounded(mf("SELECT * FROM meter_features"), BASE_DOUBLES + DOUBLE_FEATS))
def feat_all(spark, sf):
    """All 22 engineered columns in one projection."""
    return V.build_meter_features(spark, sf)


@register("feat_partial", O.rounded(O.with_(
    O.CHAIN_CLEAN, "SELECT row_id, date, usage_kwh, lagging_reactive_kvarh, leading_reactive_kvarh, "
    "co2_tco2, nsm, " + ", ".join(
        f"CAST({e} AS BIGINT) AS {n}" for n, e in [
            ("year", "year(date)"), ("month", "month(date)"), ("day", "day(date)"), ("hour", "hour(date)"),
            ("day_of_week_num", "isodow(date) - 1"), ("quarter", "quarter(date)"),
            ("is_weekend", "coalesce(isodow(date) - 1 >= 5, false)")])
    + ", " + ", ".join(f"{a} AS {n}" for n, a in zip(S.CYCLIC, [x for pair in (
        O._cyc("hour(date)", 24), O._cyc("month(date)", 12), O._cyc("(isodow(date) - 1)", 7)) for x in pair]))
    + ", lagging_reactive_kvarh + leading_reactive_kvarh AS reactive_power_total, "
    "lagging_reactive_kvarh - leading_reactive_kvarh AS reactive_power_diff, "
    "lagging_reactive_kvarh / (leading_reactive_kvarh + 1e-6) AS reactive_power_ratio, "
    "co2_tco2 / (usage_kwh + 1e-6) AS co2_per_kwh, "
    "CAST(coalesce(usage_kwh > (SELECT quantile_cont(usage_kwh, 0.5) FROM meter_clean), false) AS BIGINT) "
    "AS is_high_consumption, nsm / (usage_kwh + 1e-6) AS nsm_per_kwh FROM meter_clean"),
    ["usage_kwh", "lagging_reactive_kvarh", "leading_reactive_kvarh", "co2_tco2", *S.CYCLIC,
     *S.REACTIVE, *S.INTENSITY]))
def feat_partial(spark, sf):
    """Input without power factors -> that group is skipped."""
    d = V.meter_clean(spark, sf).drop(S.LAG_PF, S.LEAD_PF, *S.CATEGORICAL)
    return FE.engineer(d, partial=True)


@register("feat_inference", O.rounded(mf(
    "SELECT * EXCLUDE (date, day_of_week) FROM (" + O.feature_select("meter_clean", inference=True) + ")"),
    BASE_DOUBLES + DOUBLE_FEATS))
def feat_inference(spark, sf):
    """Inference form (75.0 divisor, flag 0, date and weekday name dropped)."""
    return FE.engineer_inference(V.meter_clean(spark, sf))


@register("log1p_cols", O.rounded(mf(
    "SELECT row_id, " + ", ".join(f"ln(1 + {c}) AS {c}" for c in S.NUM_SKEW) + " FROM meter_features"),
    S.NUM_SKEW))
def log1p_cols(spark, sf):
    """log1p as a native expression (no UDF)."""
    return V.meter_features(spark, sf).select(S.ROW_ID, *[F.log1p(F.col(c).cast("double")).alias(c)
                                                          for c in S.NUM_SKEW])


@register("run_name", mf(
    "SELECT row_id, 'run_' || strftime(date, '%Y%m%d_%H%M%S') AS run_name FROM meter_clean"))
def run_name(spark, sf):
    """Formatted run name from a timestamp."""
    return V.meter_clean(spark, sf).select(S.ROW_ID, X.run_name("run", F.col(S.DATE)).alias("run_name"))


# ---------------------------------------------------------------- K: transformers
NUMF = S.NUM_SKEW + S.NUM_LIN


def _prep_sql(fit_src: str, apply_src: str, categories=("WEEKDAY", "WEEKEND"), label: bool = False) -> str:
    med = "med AS (SELECT " + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in NUMF) \
        + f" FROM {fit_src})"

    def imp(src):
        return (f"SELECT {src}.row_id, " + ", ".join(
            (f"CASE WHEN coalesce(CAST({src}.{c} AS DOUBLE), med.{c}) > -1 THEN "
             f"ln(1 + coalesce(CAST({src}.{c} AS DOUBLE), med.{c})) END AS {c}" if c in S.NUM_SKEW
             else f"coalesce(CAST({src}.{c} AS DOUBLE), med.{c}) AS {c}") for c in NUMF)
            + f", {src}.week_status, {src}.load_type, {src}.usage_kwh AS label FROM {src}, med")
    fit_imp = f"fit_imp AS ({imp(fit_src)})"
    app_imp = f"app_imp AS ({imp(apply_src)})"
    mm = "mm AS (SELECT " + ", ".join(f"min({c}) AS {c}__mn, max({c}) AS {c}__mx" for c in NUMF) \
        + " FROM fit_imp)"
    cols = []
    for c in NUMF:
        g = "num_skew" if c in S.NUM_SKEW else "num_lin"
        cols.append(f"CASE WHEN mm.{c}__mx = mm.{c}__mn THEN a.{c} - mm.{c}__mn "
                    f"ELSE (a.{c} - mm.{c}__mn) / (mm.{c}__mx - mm.{c}__mn) END AS {g}__{c}")
    for v in categories[1:]:
        cols.append(f"CAST(coalesce(a.week_status = '{v}', false) AS DOUBLE) AS cat_nom__week_status_{v}")
    cols.append("CASE a.load_type " + " ".join(f"WHEN '{v}' THEN {float(i)}" for i, v in enumerate(S.LOAD_ORDER))
                + " ELSE -1.0 END AS cat_ord__load_type")
    body = "SELECT a.row_id, " + ", ".join(cols) + (", a.label" if label else "") + " FROM app_imp a, mm"
    return med, fit_imp, app_imp, mm, body


def _prep_names():
    return ([f"num_skew__{c}" for c in S.NUM_SKEW] + [f"num_lin__{c}" for c in S.NUM_LIN]
            + ["cat_nom__week_status_WEEKEND", "cat_ord__load_type"])


def _prep_oracle(even_odd: bool = False, label: bool = False) -> str:
    if even_odd:
        extra = ["fit_src AS (SELECT * FROM meter_features WHERE row_id % 2 = 0)",
                 "app_src AS (SELECT * FROM meter_features WHERE row_id % 2 = 1)"]
        parts = _prep_sql("fit_src", "app_src", label=label)
    else:
        extra = []
        parts = _prep_sql("meter_features", "meter_features", label=label)
    return O.rounded(O.with_(O.CHAIN_FEATURES + extra + list(parts[:4]), parts[4]),
                     _prep_names() + (["label"] if label else []))


@register("preprocess_apply", _prep_oracle())
def preprocess_apply(spark, sf):
    """K7 (+K1, K3, K4, K5, K6): fit the 4-group transformer and apply it; 30 outputs."""
    f = V.meter_features(spark, sf)
    return V.fitted_preprocessor(spark, sf).transform(f)


@register("preprocess_transform_new", _prep_oracle(even_odd=True))
def preprocess_transform_new(spark, sf):
    """K8: fit on even row_id, apply the stored parameters to odd row_id."""
    f = V.meter_features(spark, sf)
    p = PR.fit(f.where(F.col(S.ROW_ID) % 2 == 0))
    p2 = PR.Preprocessor.from_table(p.to_table(spark))  # round trip through the parameter table
    return p2.transform(f.where(F.col(S.ROW_ID) % 2 == 1))


@register("preprocess_fit", O.rounded(O.with_(
    O.CHAIN_FEATURES + list(_prep_sql("meter_features", "meter_features")[:2]),
    " UNION ALL ".join(
        f"SELECT '{'num_skew' if c in S.NUM_SKEW else 'num_lin'}' AS \"group\", '{c}' AS feature, '{stat}' AS stat, "
        f"CAST(NULL AS VARCHAR) AS category, {e} AS value FROM {src}"
        for c in NUMF for stat, e, src in (("median", f"max({c})", "med"), ("min", f"min({c})", "fit_imp"),
                                           ("max", f"max({c})", "fit_imp")))
    + f" UNION ALL SELECT 'cat_nom', 'week_status', 'mode', {O.mode_of('week_status', 'meter_features')}, NULL"
    + " UNION ALL SELECT 'cat_nom', 'week_status', 'category', week_status, CAST(row_number() OVER (ORDER BY "
      "week_status) - 1 AS DOUBLE) FROM (SELECT DISTINCT week_status FROM meter_features WHERE week_status IS NOT NULL)"
    + f" UNION ALL SELECT 'cat_ord', 'load_type', 'mode', {O.mode_of('load_type', 'meter_features')}, NULL"
    + "".join(f" UNION ALL SELECT 'cat_ord', 'load_type', 'level', '{v}', {float(i)}"
              for i, v in enumerate(S.LOAD_ORDER))), ["value"]))
def preprocess_fit(spark, sf):
    """K7: the fitted parameters as one long table."""
    return V.fitted_preprocessor(spark, sf).to_table(spark)


@register("minmax_new_data", O.rounded(mf(
    "SELECT row_id, " + ", ".join(
        f"CASE WHEN mx_{i} = mn_{i} THEN CAST({c} AS DOUBLE) + 1 - mn_{i} "
        f"ELSE (CAST({c} AS DOUBLE) + 1 - mn_{i}) / (mx_{i} - mn_{i}) END AS {c}"
        for i, c in enumerate(S.NUM_LIN)) + " FROM meter_features, (SELECT " + ", ".join(
        f"min(CAST({c} AS DOUBLE)) AS mn_{i}, max(CAST({c} AS DOUBLE)) AS mx_{i}" for i, c in enumerate(S.NUM_LIN))
    + " FROM meter_features WHERE row_id % 2 = 0) WHERE row_id % 2 = 1"), S.NUM_LIN))
def minmax_new_data(spark, sf):
    """K4 / K8: bounds fitted on one part, applied to shifted values of the
    other; columns that were constant in the fit (year) become x - min."""
    f = V.meter_features(spark, sf)
    p = PR.fit(f.where(F.col(S.ROW_ID) % 2 == 0), num_skew=[], cat_nom=[], cat_ord=[])
    return f.where(F.col(S.ROW_ID) % 2 == 1).select(S.ROW_ID, *[
        PR.minmax(F.col(c).cast("double") + 1, p.mins[c], p.maxs[c]).alias(c) for c in S.NUM_LIN])


@register("preprocess_negative_logs", O.rounded(O.with_(O.CHAIN_FEATURES + [
    "neg AS (SELECT * REPLACE (" + ", ".join(
        f"CASE WHEN row_id % 10 = 3 THEN -5.0 ELSE {c} END AS {c}" for c in S.NUM_SKEW) + ") FROM meter_features)"]
    + list(_prep_sql("neg", "neg")[:4]), _prep_sql("neg", "neg")[4]), _prep_names()))
def preprocess_negative_logs(spark, sf):
    """K7 / K8 with values that have no logarithm: those cells are NULL, the
    column's bounds and all other rows are unaffected."""
    f = V.meter_features(spark, sf).withColumns({
        c: F.when(F.col(S.ROW_ID) % 10 == 3, F.lit(-5.0)).otherwise(F.col(c)) for c in S.NUM_SKEW})
    return PR.fit(f).transform(f)


@register("category_codes_nulls", mf(
    "SELECT row_id, " + ", ".join(
        f"CAST(CASE WHEN {c} IS NULL OR row_id % 5 = 0 THEN -1 ELSE (SELECT count(DISTINCT b.{c}) FROM meter_clean b "
        f"WHERE b.{c} < a.{c} AND b.row_id % 5 <> 0) END AS BIGINT) AS {c}" for c in S.CATEGORICAL)
    + " FROM meter_clean a"))
def category_codes_nulls(spark, sf):
    """K11 with missing values: NULL -> -1."""
    d = V.meter_clean(spark, sf).select(S.ROW_ID, *[
        F.when(F.col(S.ROW_ID) % 5 != 0, F.col(c)).alias(c) for c in S.CATEGORICAL])
    return PR.category_codes(d, S.CATEGORICAL)


@register("impute_median", O.rounded(mf(
    "SELECT row_id, " + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM meter_features)) AS {c}"
        for c in NUMF) + " FROM meter_features"), NUMF))
def impute_median(spark, sf):
    """K1: exact per-column median imputation."""
    f = V.meter_features(spark, sf)
    p = PR.fit(f, cat_nom=[], cat_ord=[])
    return f.select(S.ROW_ID, *[PR.impute(F.col(c).cast("double"), p.medians[c]).alias(c) for c in NUMF])


@register("impute_mode", mf(
    "SELECT row_id, " + ", ".join(f"coalesce({c}, {O.mode_of(c, 'meter_norm')}) AS {c}" for c in S.CATEGORICAL)
    + " FROM meter_norm"))
def impute_mode(spark, sf):
    """K2: most-frequent imputation on strings (tie -> smallest)."""
    from meterlake.operators.clean import column_modes, normalized_categoricals
    n = normalized_categoricals(V.meter_typed(spark, sf))
    m = {r["column"]: r["mode"] for r in column_modes(n, S.CATEGORICAL).collect()}   # one value per column
    return n.select(S.ROW_ID, *[F.coalesce(F.col(c), F.lit(m.get(c))).alias(c) for c in S.CATEGORICAL])


@register("minmax_scale", O.rounded(mf(
    "SELECT row_id, " + ", ".join(
        f"CASE WHEN mx_{i} = mn_{i} THEN CAST({c} AS DOUBLE) - mn_{i} ELSE (CAST({c} AS DOUBLE) - mn_{i}) / (mx_{i} - mn_{i}) END AS {c}"
        for i, c in enumerate(S.NUM_LIN)) + " FROM meter_features, (SELECT " + ", ".join(
        f"min(CAST({c} AS DOUBLE)) AS mn_{i}, max(CAST({c} AS DOUBLE)) AS mx_{i}" for i, c in enumerate(S.NUM_LIN))
    + " FROM meter_features)"), S.NUM_LIN))
def minmax_scale(spark, sf):
    """K4: min-max to [0, 1]; constant column -> x - min (year/month/quarter here)."""
    f = V.meter_features(spark, sf)
    p = PR.fit(f, num_skew=[], cat_nom=[], cat_ord=[])
    return f.select(S.ROW_ID, *[F.coalesce(PR.minmax(F.col(c).cast("double"), p.mins[c], p.maxs[c]),
                                           F.lit(None)).alias(c) for c in S.NUM_LIN])


@register("onehot_drop_first", mf(
    "SELECT row_id, CAST(coalesce(week_status = 'WEEKEND', false) AS DOUBLE) AS cat_nom__week_status_WEEKEND "
    "FROM meter_features"))
def onehot_drop_first(spark, sf):
    """K5: alphabetical categories, first dropped, unknown -> zeros."""
    f = V.meter_features(spark, sf)
    p = PR.fit(f, num_skew=[], num_lin=[], cat_ord=[])
    return f.select(S.ROW_ID, *PR.onehot_drop_first(F.col(S.WEEK_STATUS), S.WEEK_STATUS,
                                                     p.categories[S.WEEK_STATUS]))


@register("ordinal_encode", mf(
    "SELECT row_id, CAST(CASE load_type " + " ".join(f"WHEN '{v}' THEN {float(i)}" for i, v in enumerate(S.LOAD_ORDER))
    + " ELSE -1.0 END AS DOUBLE) AS cat_ord__load_type FROM meter_features"))
def ordinal_encode(spark, sf):
    """K6: LIGHT < MEDIUM < MAXIMUM -> 0, 1, 2; unknown -> -1."""
    f = V.meter_features(spark, sf)
    return f.select(S.ROW_ID, PR.ordinal(F.col(S.LOAD_TYPE), S.LOAD_ORDER).alias("cat_ord__load_type"))


@register("split_80_20", mf(
    "SELECT CASE WHEN ((row_id * 2654435761 + 42) % 1000 + 1000) % 1000 < 800 THEN 'train' ELSE 'test' END "
    "AS part, CAST(count(*) AS BIGINT) AS n, CAST(sum(row_id) AS BIGINT) AS id_sum FROM meter_clean GROUP BY 1"))
def split_80_20(spark, sf):
    """K9: deterministic seeded 80/20 split (sizes and id checksums)."""
    d = V.meter_clean(spark, sf)
    tr, te = PR.split_80_20(d)
    def summ(x, name):
        return x.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"), F.sum(S.ROW_ID).alias("id_sum"))
    return summ(tr, "train").unionByName(summ(te, "test"))


@register("category_codes", mf(
    "SELECT row_id, " + ", ".join(
        f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS BIGINT) AS {c}" for c in S.CATEGORICAL)
    + " FROM meter_clean"))
def category_codes(spark, sf):
    """Alphabetical dense index from 0."""
    return PR.category_codes(V.meter_clean(spark, sf), S.CATEGORICAL)


@register("onehot_sparse", """WITH codes AS (SELECT l_orderkey, dense_rank() OVER (ORDER BY l_orderkey) - 1 AS code
      FROM (SELECT DISTINCT l_orderkey FROM lineitem))
    SELECT l.l_orderkey, l.l_linenumber, (SELECT count(*) - 1 FROM codes)::BIGINT AS size,
      CASE WHEN code > 0 THEN code - 1 END::BIGINT AS at, CASE WHEN code > 0 THEN 1 ELSE 0 END::BIGINT AS entries
    FROM lineitem l JOIN codes USING (l_orderkey)""")
def onehot_sparse(spark, sf):
    """K5 on a column of more than 10,000 categories: sparse one-hot rows."""
    d = V.table(spark, sf, "lineitem")
    v = PR.onehot_sparse(d, "l_orderkey", keep=("l_orderkey", "l_linenumber"))
    return v.select("l_orderkey", "l_linenumber", F.col("onehot.size").cast("bigint").alias("size"),
                    F.get("onehot.indices", F.lit(0)).alias("at"), F.size("onehot.values").alias("entries"))


@register("category_codes_many", """SELECT l_orderkey, l_linenumber,
    dense_rank() OVER (ORDER BY l_orderkey) - 1 AS order_code, dense_rank() OVER (ORDER BY l_partkey) - 1 AS part_code
    FROM lineitem""")
def category_codes_many(spark, sf):
    """K11 on columns with as many categories as the data has keys."""
    d = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_orderkey").alias("order_code"),
                                              F.col("l_partkey").alias("part_code"))
    return PR.category_codes(d, ["order_code", "part_code"], keep=("l_orderkey", "l_linenumber"))


@register("standard_scale", O.rounded(mf(
    "SELECT row_id, " + ", ".join(
        f"CASE WHEN s_{i} > 0 THEN (CAST({c} AS DOUBLE) - m_{i}) / s_{i} ELSE 0.0 END AS {c}"
        for i, c in enumerate(S.NUMERIC)) + " FROM meter_clean, (SELECT " + ", ".join(
        f"avg({c}) AS m_{i}, stddev_pop({c}) AS s_{i}" for i, c in enumerate(S.NUMERIC)) + " FROM meter_clean)"),
    S.NUMERIC))
def standard_scale(spark, sf):
    """Mean 0, population std 1."""
    return PR.standard_scale(V.meter_clean(spark, sf), S.NUMERIC)


@register("project_features", O.rounded(mf(
    "SELECT * EXCLUDE (date, usage_kwh, day_of_week) FROM meter_features"),
    [c for c in BASE_DOUBLES if c != S.TARGET] + DOUBLE_FEATS))
def project_features(spark, sf):
    """B1: exclude date, target and weekday name (absent names are ignored)."""
    return V.meter_features(spark, sf).drop(*S.EXCLUDE_FROM_FEATURES, "not_a_column")
