"""Registered queries: model fitting, scoring and evaluation (L1-L9, K10,
A6, M1, M5, N4, N5, F3).  Model-dependent results get the rows-only check
(no oracle SQL) except the one-feature regression, which is an aggregate.

Training data is the feature table of the meter view: the fitted 4-group
transformer applied to ``meter_features`` (30 columns) plus ``label``.
Fitted models are kept per session so the evaluation queries reuse them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake import schema as S
from meterlake.operators import compare as G
from meterlake.operators import evaluate as EV
from meterlake.operators import ledger as L
from meterlake.operators import models as MD
from meterlake.operators import prep as PR
from meterlake.operators import score as SC
from meterlake.plans import oracle as O
from meterlake.plans import views as V
from meterlake.plans.registry import register
from meterlake.session import scratch_path

_CACHE: dict[tuple, object] = {}
M_ALL = ["mse", "rmse", "mae", "r2_score", "mape"]


def _memo(spark, sf, name, fn):
    key = V.source_key(spark, sf, f"model:{name}")
    if key not in _CACHE:
        _CACHE[key] = fn()
    return _CACHE[key]


def prepared(spark, sf):
    """(preprocessor, feature table with label, feature names) — materialized once."""
    def build():
        f = V.meter_features(spark, sf)
        p = V.fitted_preprocessor(spark, sf)
        t = f.select(S.ROW_ID, *p.columns(), F.col(S.TARGET).cast("double").alias("label"))
        t = V.materialize(spark, lambda: t.where(F.col("label").isNotNull()), "feature_table", sf)
        return p, t, p.output_names()
    return _memo(spark, sf, "prepared", build)


def split(spark, sf):
    _p, t, _n = prepared(spark, sf)
    return PR.split_80_20(t)


def rulefit(spark, sf):
    def build():
        _p, t, names = prepared(spark, sf)
        return MD.fit_rulefit(t, names, "label", max_rules=30, tree_size=4, seed=42)
    return _memo(spark, sf, "rulefit", build)


@register("fit_line", O.rounded(
    "SELECT regr_slope(p_retailprice, p_size) AS slope, regr_intercept(p_retailprice, p_size) AS intercept, "
    "regr_r2(p_retailprice, p_size) AS r2, CAST(regr_count(p_retailprice, p_size) AS BIGINT) AS n FROM part",
    ["slope", "intercept", "r2"]))
def fit_line(spark, sf):
    """L1 one-feature: p_retailprice on p_size as one aggregate."""
    return MD.fit_line(V.table(spark, sf, "part"), "p_size", "p_retailprice")


def _test_metrics(spark, sf, model, name):
    _tr, te = split(spark, sf)
    pred = model.transform(te) if hasattr(model, "nodes") or isinstance(model, SC.RuleModel) else MD.predict_ml(model, te)
    return EV.metrics(pred, "label", "prediction").withColumn("model", F.lit(name))


_SPLIT = "((row_id * 2654435761 + 42) % 1000 + 1000) % 1000"
_ROWS = "(SELECT * FROM meter_features WHERE usage_kwh IS NOT NULL)"


def _facts_sql():
    train = f"(SELECT count(*) FROM {_ROWS} WHERE {_SPLIT} < 800)"
    test = f"(SELECT count(*) FROM {_ROWS} WHERE {_SPLIT} >= 800)"
    every = f"(SELECT count(*) FROM {_ROWS})"
    facts = [("linear", "train_rows", train), ("linear", "residuals_sum_to_zero", "1"),
             ("linear", "residuals_orthogonal_to_features", "1"), ("forest", "test_rows", test),
             ("forest", "importances_sum_to_one", "1"), ("forest", "better_than_mean", "1"),
             ("pca", "explained_sums_to_one", "1"), ("pca", "k_is_least_above_95_percent", "1"),
             ("rulefit", "rows", every), ("rulefit", "at_most_30_rules", "1"),
             ("rulefit", "supports_recompute", "1"), ("rulefit", "better_than_mean", "1"),
             ("drift", "rmse_rises", "1"), ("drift", "r2_falls", "1")]
    return O.with_(O.CHAIN_FEATURES, " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{f}' AS fact, CAST({v} AS BIGINT) AS value" for m, f, v in facts))


@register("model_facts", _facts_sql())
def model_facts(spark, sf):
    """Checkable facts of the fitted models (L1, L3, L5, L7, K10, N5): normal
    equations, importances, explained variance, rule supports and errors
    against the mean predictor; counts come from the source in the oracle."""
    _p, t, names = prepared(spark, sf)
    tr, te = split(spark, sf)
    e = MD.predict_ml(MD.fit_linear(tr, names), tr).select("*", (F.col("label") - F.col("prediction")).alias("e"))
    scale = e.agg(F.sum(F.abs("label")).alias("y"), F.count("*").alias("n"), F.sum("e").alias("e"),
                  *[F.sum(F.col("e") * F.col(c)).alias(f"x{i}") for i, c in enumerate(names)]).first()
    small = 1e-6 * max(scale["y"], 1.0)
    out = [("linear", "train_rows", scale["n"]), ("linear", "residuals_sum_to_zero", abs(scale["e"]) < small),
           ("linear", "residuals_orthogonal_to_features",
            all(abs(scale[f"x{i}"]) < small for i in range(len(names))))]
    fm = EV.metrics(MD.predict_ml(forest(spark, sf), te), "label", "prediction").first()
    imp = forest(spark, sf).stages[-1].featureImportances.toArray().sum()
    out += [("forest", "test_rows", fm["n"]), ("forest", "importances_sum_to_one", abs(imp - 1) < 1e-9),
            ("forest", "better_than_mean", fm["r2_score"] > 0)]
    _m, k, ev = MD.fit_pca95(t, names)
    out += [("pca", "explained_sums_to_one", abs(sum(ev) - 1) < 1e-9),
            ("pca", "k_is_least_above_95_percent", sum(ev[:k]) > 0.95 >= sum(ev[:k - 1]))]
    model, table = rulefit(spark, sf)
    rules = table.where("kind = 'rule'").collect()  # at most 30
    again = t.agg(F.count("*").alias("n"), *[F.avg(F.coalesce(F.expr(r["condition"]), F.lit(False)).cast("double"))
                                             .alias(r["rule_id"]) for r in rules]).first()
    base, drift = _eval(spark, sf, 0.0).first(), _eval(spark, sf, 0.25).first()
    out += [("rulefit", "rows", again["n"]), ("rulefit", "at_most_30_rules", len(rules) <= 30),
            ("rulefit", "supports_recompute", all(abs(again[r["rule_id"]] - r["support"]) < 1e-9 for r in rules)),
            ("rulefit", "better_than_mean", base["r2_score"] > 0),
            ("drift", "rmse_rises", drift["rmse"] > base["rmse"]),
            ("drift", "r2_falls", drift["r2_score"] < base["r2_score"])]
    return spark.createDataFrame([(m, f, int(v)) for m, f, v in out], "model string, fact string, value long")


@register("model_sweep")
def model_sweep(spark, sf):
    """The eight model kinds on one split, a ledger run each, compared
    by RMSE."""
    _p, t, names = prepared(spark, sf)
    _tr, te = split(spark, sf)
    model, _table = rulefit(spark, sf)
    parts = [fit_linear(spark, sf), fit_forest(spark, sf), fit_gbt(spark, sf), fit_knn(spark, sf),
             fit_pca_linear(spark, sf).drop("k"), fit_pca_forest(spark, sf).drop("k"),
             fit_pca_gbt(spark, sf).drop("k"),
             EV.metrics(model.transform(te), "label", "prediction").withColumn("model", F.lit("rulefit"))]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    runs = L.as_runs(every.withColumn("experiment", F.lit("sweep")), "experiment", "model", M_ALL,
                     param_cols=[], tag_cols=["n"])
    path = scratch_path(spark, "sweep_ledger")
    L.run_append(runs, path)
    return L.run_compare(L.read_runs(spark, path))


@register("fit_linear")
def fit_linear(spark, sf):
    """L1: OLS on the 80 % split, metrics on the 20 %."""
    _p, _t, names = prepared(spark, sf)
    tr, _te = split(spark, sf)
    return _test_metrics(spark, sf, MD.fit_linear(tr, names), "linear")


def forest(spark, sf):
    def build():
        _p, _t, names = prepared(spark, sf)
        tr, _te = split(spark, sf)
        return MD.fit_forest(tr, names, num_trees=100, max_depth=20, min_leaf=2, seed=42)
    return _memo(spark, sf, "forest", build)


@register("fit_forest")
def fit_forest(spark, sf):
    """L3: random forest, 100 trees, depth 20, min leaf 2, sqrt features, seed 42."""
    return _test_metrics(spark, sf, forest(spark, sf), "random_forest")


@register("fit_gbt")
def fit_gbt(spark, sf):
    """L4: gradient boosting, 100 rounds, lr 0.1, depth 6, row/col sample 0.8."""
    _p, _t, names = prepared(spark, sf)
    tr, _te = split(spark, sf)
    return _test_metrics(spark, sf, MD.fit_gbt(tr, names), "gbt")


@register("fit_gbt_l2")
def fit_gbt_l2(spark, sf):
    """L4: second-order boosting, L2 leaf penalty 1, row and column samples of
    0.8 per tree, depth 6; 20 rounds at step 0.3."""
    from meterlake.operators import boost as B
    _p, _t, names = prepared(spark, sf)
    tr, _te = split(spark, sf)
    model = _memo(spark, sf, "gbt_l2", lambda: B.fit_gbt_l2(tr, names, rounds=20, step=0.3))
    return _test_metrics(spark, sf, model, "gbt_l2")


FIRST_TREE = dict(rounds=1, max_depth=2, subsample=0.8, col_sample=0.8, l2=1.0, seed=42)


def _first_tree_sql() -> str:
    """A tree of depth 2 grown in SQL: bins, histograms and gains per level."""
    from meterlake.operators.boost import BINS, SAMPLE_OF, SCALE, sampled_columns
    from meterlake.plans.feature_queries import _prep_names, _prep_sql
    med, fit_imp, app_imp, mm, feat_body = _prep_sql("meter_features", "meter_features", label=True)
    names = _prep_names()
    used = sampled_columns(len(names), 0, FIRST_TREE["col_sample"], FIRST_TREE["seed"])
    ends = ", ".join(f"min({names[j]}) AS a{j}, max({names[j]}) AS z{j}" for j in used)
    bins = ", ".join(f"CASE WHEN z{j} <= a{j} THEN 0 ELSE least(greatest(floor(({names[j]} - a{j}) / ((z{j} - a{j}) / "
                     f"{BINS})), 0), {BINS - 1}) END::BIGINT AS c{j}" for j in used)
    sampled = (f"('0x' || substr(md5('{FIRST_TREE['seed']}:0:' || row_id::VARCHAR), 1, 8))::BIGINT % {SAMPLE_OF} < "
               f"{round(FIRST_TREE['subsample'] * SAMPLE_OF)}")
    part = lambda g, h: f"(({g}) / {SCALE}.0) * (({g}) / {SCALE}.0) / (({h}) + 1.0)"
    ctes = [med, fit_imp, app_imp, mm, f"feat AS ({feat_body})",
            f"tr AS (SELECT * FROM feat WHERE label IS NOT NULL AND {_SPLIT} < 800)",
            f"ends AS (SELECT floor(avg(label) * 1e6 + 0.5) / 1e6 AS base, {ends} FROM tr)",
            f"cut AS (SELECT row_id, round_even((base - label) * {SCALE}, 0)::BIGINT AS g, {bins} FROM tr, ends WHERE {sampled})",
            f"long AS (UNPIVOT cut ON {', '.join(f'c{j}' for j in used)} INTO NAME f VALUE k)",
            "pairs AS (SELECT row_id, g, substr(f, 2)::BIGINT AS j, k FROM long)"]

    def best(rows: str) -> str:  # (node, j, k) of each node's split
        return f"""SELECT node, j, k FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, j, k) AS rn
          FROM (SELECT *, {part('gl', 'hl')} + {part('gt - gl', 'ht - hl')} - {part('gt', 'ht')} AS gain
            FROM (SELECT node, j, k, sum(g) OVER c AS gl, sum(h) OVER c AS hl, sum(g) OVER t AS gt, sum(h) OVER t AS ht
              FROM (SELECT node, j, k, sum(g) AS g, count(*) AS h FROM {rows} GROUP BY node, j, k)
              WINDOW c AS (PARTITION BY node, j ORDER BY k), t AS (PARTITION BY node, j)))
          WHERE hl >= 1 AND ht - hl >= 1 AND gain > 0) WHERE rn = 1"""

    def down(rows: str, split: str) -> str:  # rows to the children of their node
        return f"""SELECT p.row_id, p.g, 2 * p.node + 1 + (x.k > s.k)::BIGINT AS node FROM (SELECT DISTINCT row_id, g, node FROM {rows}) p
          JOIN {split} s ON s.node = p.node JOIN pairs x ON x.row_id = p.row_id AND x.j = s.j"""

    ctes += ["r0 AS (SELECT row_id, g, j, k, 0::BIGINT AS node FROM pairs)", f"s0 AS ({best('r0')})",
             f"d1 AS ({down('r0', 's0')})", "r1 AS (SELECT p.row_id, p.g, p.node, x.j, x.k FROM d1 p JOIN pairs x USING (row_id))",
             f"s1 AS ({best('r1')})", f"d2 AS ({down('r1', 's1')})",
             "every AS (SELECT row_id, g, 0::BIGINT AS node FROM cut UNION ALL SELECT row_id, g, node FROM d1 "
             "UNION ALL SELECT row_id, g, node FROM d2)",
             f"sums AS (SELECT node, sum(g) / {SCALE}.0 AS g, count(*)::DOUBLE AS h FROM every GROUP BY node)",
             "splits AS (FROM s0 UNION ALL FROM s1)"]
    name = "CASE s.j " + " ".join(f"WHEN {j} THEN '{names[j]}'" for j in used) + " END"
    body = (f"SELECT CAST(n.node AS BIGINT) AS node, {name} AS feature, CAST(s.k AS BIGINT) AS bin, n.g::DOUBLE AS g, n.h, "
            "CASE WHEN s.j IS NULL THEN -n.g / (n.h + 1.0) ELSE 0 END::DOUBLE AS value "
            "FROM sums n LEFT JOIN splits s ON s.node = n.node")
    return O.with_(O.CHAIN_FEATURES + ctes, body)


@register("gbt_l2_first_tree", O.rounded(_first_tree_sql(), ["g", "h", "value"]))
def gbt_l2_first_tree(spark, sf):
    """L4: the first tree, depth 2: splits, gradient sums and leaf values
    -G / (H + 1)."""
    from meterlake.operators import boost as B
    _p, _t, names = prepared(spark, sf)
    tr, _te = split(spark, sf)
    return B.fit_gbt_l2(tr, names, **FIRST_TREE).nodes(spark).select("node", "feature", "bin", "g", "h", "value")


@register("feature_importance")
def feature_importance(spark, sf):
    """Forest importances, sorted."""
    _p, _t, names = prepared(spark, sf)
    return MD.feature_importance(forest(spark, sf), names)


@register("top_features")
def top_features(spark, sf):
    """top-10 features by importance."""
    _p, _t, names = prepared(spark, sf)
    return MD.top_k(MD.feature_importance(forest(spark, sf), names), "importance", 10, "feature")


@register("fit_rulefit")
def fit_rulefit(spark, sf):
    """RuleFit (max 30 rules, mean tree size 4, exponential sizes, seed 42); in-sample metrics."""
    _p, t, _n = prepared(spark, sf)
    model, table = rulefit(spark, sf)
    m = EV.metrics(model.transform(t), "label", "prediction")
    return m.withColumn("n_rules", F.lit(sum(1 for _ in model.rules)))


@register("rulefit_kkt", O.with_(O.CHAIN_FEATURES, f"""SELECT CAST(count(*) AS BIGINT) AS rows,
    CAST(0 AS BIGINT) AS zero_over_penalty, CAST(0 AS BIGINT) AS kept_off_penalty, CAST(1 AS BIGINT) AS centred
    FROM {_ROWS}"""))
def rulefit_kkt(spark, sf):
    """The chosen point of the penalty path is optimal: residuals against
    every rule of the pool, from a scan of its own."""
    _p, t, _n = prepared(spark, sf)
    return MD.kkt(t, rulefit(spark, sf)[0])


# A small design whose sums of products SQL recomputes.
FIXED_DESIGN = ["`num_lin__hour` > 0.5", "`cat_ord__load_type` <= 0.5 AND `num_skew__nsm` > 0.9",
                "`num_skew__co2_tco2` <= 0.25"]
FIXED_LINEAR = [("num_skew__lagging_reactive_kvarh", 0.1, 0.9), ("num_lin__leading_power_factor", 0.2, 0.8)]


def _design_sql() -> str:
    from meterlake.plans.feature_queries import _prep_sql
    med, fit_imp, app_imp, mm, feat_body = _prep_sql("meter_features", "meter_features", label=True)
    terms = ["1.0"] + [f"CASE WHEN {r.replace('`', '')} THEN 1.0 ELSE 0.0 END" for r in FIXED_DESIGN]
    terms += [f"least(greatest({c}, {lo}), {hi})" for c, lo, hi in FIXED_LINEAR] + ["label"]
    made = ", ".join(f"CAST({t} AS DOUBLE) AS z{i}" for i, t in enumerate(terms))
    sums = " UNION ALL ".join(f"SELECT {i} AS a, {j} AS b, sum(z{i} * z{j}) AS total FROM z"
                              for i in range(len(terms)) for j in range(len(terms)))
    return O.with_(O.CHAIN_FEATURES + [med, fit_imp, app_imp, mm, f"feat AS ({feat_body})",
                                       f"z AS (SELECT {made} FROM feat WHERE label IS NOT NULL)"],
                   f"SELECT CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b, total FROM ({sums})")


@register("rule_sums", O.rounded(_design_sql(), ["total"]))
def rule_sums(spark, sf):
    """Sums of products of [1, rules, winsorised terms, label] in one pass,
    the statistics that the penalty path is solved on."""
    from meterlake.operators.gram import reduced
    _p, t, names = prepared(spark, sf)
    g = reduced(t, [*names, "label"], MD.rule_design(names, FIXED_DESIGN, FIXED_LINEAR))[0]
    return spark.createDataFrame([(i, j, float(v)) for i, row in enumerate(g) for j, v in enumerate(row)],
                                 "a int, b int, total double")


@register("rule_table")
def rule_table(spark, sf):
    """Selected rules and linear terms with coefficient, support, importance."""
    return rulefit(spark, sf)[1]


@register("top_rules")
def top_rules(spark, sf):
    """top-10 rules by importance."""
    t = rulefit(spark, sf)[1].where(F.col("kind") == "rule")
    return MD.top_k(t, "importance", 10, "rule_id")


@register("pca_95")
def pca_95(spark, sf):
    """Components kept for 95 % variance and the cumulative curve."""
    _p, t, names = prepared(spark, sf)
    _m, k, ev = MD.fit_pca95(t, names)
    rows = []
    acc = 0.0
    for i, v in enumerate(ev):
        acc += v
        rows.append((i + 1, float(v), float(acc), int(i + 1 <= k)))
    return spark.createDataFrame(rows, "component int, explained double, cumulative double, kept int")


def _variance_sql() -> str:
    from meterlake.plans.feature_queries import _prep_names, _prep_sql
    med, fit_imp, app_imp, mm, feat_body = _prep_sql("meter_features", "meter_features", label=True)
    names = _prep_names()
    total = " + ".join(f"var_samp({c})" for c in names)
    return O.with_(O.CHAIN_FEATURES + [med, fit_imp, app_imp, mm, f"feat AS ({feat_body})"],
                   f"SELECT CAST(count(*) AS BIGINT) AS rows, {total} AS total_variance, CAST({len(names)} AS BIGINT) AS "
                   "components, CAST(1 AS BIGINT) AS uncorrelated, CAST(1 AS BIGINT) AS same_k "
                   "FROM feat WHERE label IS NOT NULL")


@register("pca_variance", O.rounded(_variance_sql(), ["total_variance"]))
def pca_variance(spark, sf):
    """Variance of every component, and covariances between them, over the
    projected rows: their sum is the total variance of the features."""
    _p, t, names = prepared(spark, sf)
    return MD.pca_check(t, names)


@register("fit_pca_linear")
def fit_pca_linear(spark, sf):
    """Centre -> PCA 95 % -> linear regression."""
    _p, _t, names = prepared(spark, sf)
    tr, _te = split(spark, sf)
    model, k = MD.fit_pca_regressor(tr, names, "linear")
    return _test_metrics(spark, sf, model, "pca_linear").withColumn("k", F.lit(k))


@register("fit_pca_forest")
def fit_pca_forest(spark, sf):
    """Centre -> PCA 95 % -> random forest."""
    _p, _t, names = prepared(spark, sf)
    tr, _te = split(spark, sf)
    model, k = MD.fit_pca_regressor(tr, names, "forest")
    return _test_metrics(spark, sf, model, "pca_forest").withColumn("k", F.lit(k))


@register("fit_pca_gbt")
def fit_pca_gbt(spark, sf):
    """Centre -> PCA 95 % -> gradient boosting."""
    _p, _t, names = prepared(spark, sf)
    tr, _te = split(spark, sf)
    model, k = MD.fit_pca_regressor(tr, names, "gbt")
    return _test_metrics(spark, sf, model, "pca_gbt").withColumn("k", F.lit(k))


@register("train_job")
def train_job(spark, sf):
    """Fit RuleFit -> in-sample evaluate -> save -> append a ledger run."""
    _p, t, _n = prepared(spark, sf)
    model, table = rulefit(spark, sf)
    mpath = scratch_path(spark, "rulefit_model")
    MD.save_rule_model(model, mpath)
    metrics = EV.metrics(model.transform(t), "label", "prediction").withColumn("experiment", F.lit("rulefit"))
    metrics = metrics.withColumn("run", F.lit("rulefit_train")).withColumn("n_rules", F.lit(len(model.rules)))
    runs = L.as_runs(metrics, "experiment", "run", ["mse", "rmse", "mae", "r2_score", "mape"],
                     param_cols=["n_rules"], tag_cols=["n"])
    path = scratch_path(spark, "ledger")
    L.run_append(runs, path)
    return L.run_compare(L.read_runs(spark, path))


@register("model_roundtrip", O.with_(O.CHAIN_FEATURES, " UNION ALL ".join(
    f"SELECT '{m}' AS \"table\", n AS rows_a, n AS rows_b, CAST(0 AS BIGINT) AS only_in_a, CAST(0 AS BIGINT) AS "
    f"only_in_b, CAST(1 AS BIGINT) AS equal FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM {_ROWS})"
    for m in ("rule_model", "linear_pipeline"))))
def model_roundtrip(spark, sf):
    """Save / load the rule model and a fitted pipeline; scores must be identical."""
    from pyspark.ml import PipelineModel
    _p, t, names = prepared(spark, sf)
    model, _table = rulefit(spark, sf)
    path = scratch_path(spark, "rule_model")
    MD.save_rule_model(model, path)
    again = MD.load_rule_model(spark, path)
    a = model.transform(t).select(S.ROW_ID, "prediction")
    b = again.transform(t).select(S.ROW_ID, "prediction")
    lin = MD.fit_linear(t, names)
    lpath = scratch_path(spark, "linear_model")
    lin.write().overwrite().save(lpath)
    lin2 = PipelineModel.load(lpath)
    c = MD.predict_ml(lin, t).select(S.ROW_ID, "prediction")
    d = MD.predict_ml(lin2, t).select(S.ROW_ID, "prediction")
    return G.table_equal(a, b, "rule_model").unionByName(G.table_equal(c, d, "linear_pipeline"))


@register("score_batch")
def score_batch(spark, sf):
    """M1: batch scoring of every row with the trained rule model, row_id kept."""
    _p, t, _n = prepared(spark, sf)
    model, _table = rulefit(spark, sf)
    return model.transform(t).select(S.ROW_ID, "label", "prediction")


@register("score_requests")
def score_requests(spark, sf):
    """M5: requests -> validate -> rename -> features -> stored preprocessor -> model -> JSON."""
    p, t, _n = prepared(spark, sf)
    model, _table = rulefit(spark, sf)
    reqs = SC.requests_from_meter(V.meter_clean(spark, sf))
    resp, verdicts = SC.score_requests(reqs, model, preprocessor=p)
    return resp.join(verdicts.select("request_id", "accepted"), "request_id", "right")


def _eval(spark, sf, shift):
    p, t, names = prepared(spark, sf)
    model, _table = rulefit(spark, sf)
    x = EV.drift_shift(t, names, shift) if shift else t
    return EV.metrics(model.transform(x), "label", "prediction")


@register("evaluate_baseline")
def evaluate_baseline(spark, sf):
    """Stored preprocessor + model on the feature table -> MAE, RMSE, R^2 (+MSE, MAPE)."""
    return _eval(spark, sf, 0.0).withColumn("scenario", F.lit("baseline"))


@register("evaluate_drift")
def evaluate_drift(spark, sf):
    """N5 + N6: every scaled feature + 0.25 std; metrics and degradation vs baseline."""
    base, drift = _eval(spark, sf, 0.0), _eval(spark, sf, 0.25)
    return EV.degradation(base, drift)


# ---------------------------------------------------------------- C3 / L2
def _knn_sql(body: str) -> str:
    from meterlake.plans.feature_queries import _prep_names, _prep_sql
    names = _prep_names()
    med, fit_imp, app_imp, mm, feat_body = _prep_sql("meter_features", "meter_features", label=True)
    split = "((row_id * 2654435761 + 42) % 1000 + 1000) % 1000"
    d2 = " + ".join(f"(te.{c} - tr.{c}) * (te.{c} - tr.{c})" for c in names)
    ctes = [med, fit_imp, app_imp, mm, f"feat AS ({feat_body})",
            f"tr AS (SELECT * FROM feat WHERE label IS NOT NULL AND {split} < 800)",
            f"te AS (SELECT * FROM feat WHERE label IS NOT NULL AND {split} >= 800)",
            f"nb AS (SELECT te.row_id AS test_id, te.label AS y, tr.label AS label, row_number() OVER "
            f"(PARTITION BY te.row_id ORDER BY {d2}, tr.row_id) AS rn FROM te, tr)",
            "knn AS (SELECT test_id AS row_id, avg(label) AS prediction, CAST(count(*) AS BIGINT) AS neighbours, "
            "any_value(y) AS y FROM nb WHERE rn <= 5 GROUP BY test_id)"]
    return O.with_(O.CHAIN_FEATURES + ctes, body)


def knn_predictions(spark, sf, block_rows=None):
    from meterlake.operators.knn import BLOCK_ROWS, knn_regress
    _p, t, names = prepared(spark, sf)
    tr, te = split(spark, sf)
    return knn_regress(tr, te, names, "label", k=5, block_rows=block_rows or BLOCK_ROWS), te


@register("knn_exact", O.rounded(_knn_sql("SELECT row_id, prediction, neighbours FROM knn"), ["prediction"]))
def knn_exact(spark, sf):
    """Exact 5-nearest-neighbour regression of the 20 % split on the 80 %
    (Euclidean on the 30 transformed features, ties by train row_id)."""
    return knn_predictions(spark, sf)[0]


@register("knn_multi_block", O.rounded(_knn_sql("SELECT row_id, prediction, neighbours FROM knn"), ["prediction"]))
def knn_multi_block(spark, sf):
    """C3 over many small cells and blocks: the way a large training set goes."""
    return knn_predictions(spark, sf, block_rows=500)[0]


_TESTS = f"SELECT CAST(count(*) AS BIGINT) AS n FROM {_ROWS} WHERE {_SPLIT} >= 800"


@register("knn_visits", O.with_(O.CHAIN_FEATURES, f"SELECT n AS test_rows, CAST(1 AS BIGINT) AS below_half FROM ({_TESTS})"))
def knn_visits(spark, sf):
    """Blocks of ``knn_multi_block`` that a test row was compared with:
    on average fewer than half of all."""
    from meterlake.operators.knn import knn_search
    _p, _t, names = prepared(spark, sf)
    found = knn_search(*split(spark, sf), names, "label", k=5, block_rows=500)
    per = found.asked.groupBy("test_id").agg(F.count(F.lit(1)).alias("visited"))
    return per.agg(F.count(F.lit(1)).alias("test_rows"),
                   F.coalesce(F.avg("visited") < 0.5 * found.blocks, F.lit(False)).cast("int").alias("below_half"))


@register("knn_lsh", O.with_(O.CHAIN_FEATURES, f"SELECT n AS test_rows, CAST(1 AS BIGINT) AS recall_above_90 FROM ({_TESTS})"))
def knn_lsh(spark, sf):
    """Approximate neighbours by random-projection buckets; their share of
    the exact ones (``knn_exact``, itself checked in SQL) joined pair by pair."""
    from meterlake.operators.knn import knn_candidates, knn_lsh as approximate
    _p, _t, names = prepared(spark, sf)
    tr, te = split(spark, sf)
    exact = knn_candidates(tr, te, names, "label", k=5).select("test_id", "train_id")
    found = approximate(tr, te, names, "label", k=5).select("test_id", "train_id", F.lit(1).alias("hit"))
    both = exact.join(found, ["test_id", "train_id"], "left")
    return both.agg(F.count_distinct("test_id").alias("test_rows"),
                    (F.sum("hit") >= 0.9 * F.count(F.lit(1))).cast("int").alias("recall_above_90"))


@register("fit_knn", O.rounded(_knn_sql(
    "SELECT CAST(count(*) AS BIGINT) AS n, avg((y - prediction) * (y - prediction)) AS mse, "
    "sqrt(avg((y - prediction) * (y - prediction))) AS rmse, avg(abs(y - prediction)) AS mae, "
    "1 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(*)) AS r2_score, "
    "avg(abs((y - prediction) / (y + 1e-10))) * 100 AS mape, 'knn' AS model FROM knn"),
    ["mse", "rmse", "mae", "r2_score", "mape"]))
def fit_knn(spark, sf):
    """L2: k-NN regressor (k = 5, uniform weights) evaluated on the 20 % split."""
    pred, te = knn_predictions(spark, sf)
    j = pred.join(te.select(S.ROW_ID, "label"), S.ROW_ID)
    return EV.metrics(j, "label", "prediction").withColumn("model", F.lit("knn"))


# ---------------------------------------------------------------- fixed models
# A literal rule model over the transformed features, so that SQL
# recomputes scores, drift and supports from the source tables.
FIXED_MODEL = SC.RuleModel(
    intercept=20.0,
    rules=[("f1", FIXED_DESIGN[0], 12.0), ("f2", FIXED_DESIGN[1], -7.5), ("f3", FIXED_DESIGN[2], 5.0)],
    linear=[("num_skew__lagging_reactive_kvarh", 30.0), ("num_lin__leading_power_factor", -4.0)])


def _fixed_sql(body: str, extra: list[str] | None = None) -> str:
    """``body`` over feat (row_id, features, label), the transformed feature table."""
    from meterlake.plans.feature_queries import _prep_sql
    med, fit_imp, app_imp, mm, feat_body = _prep_sql("meter_features", "meter_features", label=True)
    return O.with_(O.CHAIN_FEATURES + [med, fit_imp, app_imp, mm,
                                       f"feat AS (SELECT * FROM ({feat_body}) WHERE label IS NOT NULL)", *(extra or [])], body)


def _fixed_prediction() -> str:
    terms = [f"{c!r} * CASE WHEN {cond.replace('`', '')} THEN 1.0 ELSE 0.0 END" for _, cond, c in FIXED_MODEL.rules]
    terms += [f"{c!r} * {x}" for x, c in FIXED_MODEL.linear]
    return f"CAST({FIXED_MODEL.intercept!r} AS DOUBLE) + " + " + ".join(terms)


@register("score_batch_fixed", O.rounded(_fixed_sql(
    f"SELECT row_id, label, {_fixed_prediction()} AS prediction FROM feat"), ["label", "prediction"]))
def score_batch_fixed(spark, sf):
    """M1: batch scoring of every row with a literal rule model."""
    _p, t, _n = prepared(spark, sf)
    return FIXED_MODEL.transform(t).select(S.ROW_ID, "label", "prediction")


def _drift_sql() -> str:
    from meterlake.plans.feature_queries import _prep_names
    names = _prep_names()
    moved = ", ".join(f"feat.{c} + 0.25 * sds.{c} AS {c}" for c in names)
    scored = [f"sds AS (SELECT {', '.join(f'stddev_samp({c}) AS {c}' for c in names)} FROM feat)",
              f"moved AS (SELECT label, {moved} FROM feat, sds)"]
    for name, src in (("base", "feat"), ("drift", "moved")):
        scored.append(
            f"{name} AS (SELECT sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, 1 - sum(e * e) / (var_pop(label) * count(*)) "
            f"AS r2_score FROM (SELECT label, label - ({_fixed_prediction()}) AS e FROM {src}))")
    return _fixed_sql(" UNION ALL ".join(
        f"SELECT '{m}' AS metric, b.{m} AS base, d.{m} AS drifted, (d.{m} - b.{m}) / b.{m} * 100 AS change_pct "
        f"FROM base b, drift d" for m in ("rmse", "mae", "r2_score")), scored)


@register("evaluate_fixed", O.rounded(_drift_sql(), ["base", "drifted", "change_pct"]))
def evaluate_fixed(spark, sf):
    """A literal rule model evaluated as it is and with every feature
    moved by 0.25 of its deviation."""
    _p, t, names = prepared(spark, sf)
    base, drift = (EV.metrics(FIXED_MODEL.transform(x), "label", "prediction") for x in (t, EV.drift_shift(t, names, 0.25)))
    return EV.degradation(base, drift)


@register("rule_table_fixed", O.rounded(_fixed_sql(" UNION ALL ".join(
    f"SELECT '{i}' AS rule_id, {c!r}::DOUBLE AS coefficient, s AS support, abs({c!r}) * sqrt(s * (1 - s)) AS importance FROM "
    f"(SELECT avg(CASE WHEN {cond.replace('`', '')} THEN 1.0 ELSE 0.0 END) AS s FROM feat)"
    for i, cond, c in FIXED_MODEL.rules)), ["coefficient", "support", "importance"]))
def rule_table_fixed(spark, sf):
    """Support and importance of literal rules, supports from the one-pass
    sums that the rule ensemble is fitted on."""
    from meterlake.operators.gram import moments_of, reduced
    _p, t, names = prepared(spark, sf)
    _n, mean, _s = moments_of(reduced(t, [*names, "label"], MD.rule_design(names, FIXED_DESIGN, []))[0])
    return spark.createDataFrame(
        [(i, float(c), float(s), abs(c) * float(s * (1 - s)) ** 0.5) for (i, _, c), s in zip(FIXED_MODEL.rules, mean)],
        "rule_id string, coefficient double, support double, importance double")


_X1, _X2 = "num_skew__lagging_reactive_kvarh", "num_lin__leading_power_factor"


@register("fit_linear_two", O.rounded(_fixed_sql(
    "SELECT (b1) AS coef_1, (b2) AS coef_2, my - b1 * m1 - b2 * m2 AS intercept FROM (SELECT *, "
    "(c1y * v2 - c2y * c12) / (v1 * v2 - c12 * c12) AS b1, (c2y * v1 - c1y * c12) / (v1 * v2 - c12 * c12) AS b2 FROM "
    f"(SELECT avg(label) AS my, avg({_X1}) AS m1, avg({_X2}) AS m2, var_pop({_X1}) AS v1, var_pop({_X2}) AS v2, "
    f"covar_pop({_X1}, {_X2}) AS c12, covar_pop({_X1}, label) AS c1y, covar_pop({_X2}, label) AS c2y FROM feat))"),
    ["coef_1", "coef_2", "intercept"]))
def fit_linear_two(spark, sf):
    """L1 on two features: the fitted coefficients, against the closed form."""
    _p, t, _n = prepared(spark, sf)
    lr = MD.fit_linear(t, [_X1, _X2]).stages[-1]
    a, b = (float(x) for x in lr.coefficients.toArray())
    return spark.createDataFrame([(a, b, float(lr.intercept))], "coef_1 double, coef_2 double, intercept double")
