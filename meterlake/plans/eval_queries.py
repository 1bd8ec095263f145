"""Registered queries: metrics and drift (N1-N3, N6), run ledger (O1-O4,
F5, F6), table comparison (G1).  Predictions for the metric queries are the
lineitem stand-ins of FIXTURES.md: y = l_extendedprice,
y_hat = l_quantity * 2100, model = l_returnflag."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake import schema as S
from meterlake.operators import compare as G
from meterlake.operators import evaluate as EV
from meterlake.operators import ledger as L
from meterlake.plans import oracle as O
from meterlake.plans import views as V
from meterlake.plans.registry import register
from meterlake.session import scratch_path

PRED = "SELECT l_returnflag AS model, l_linestatus, l_shipdate, l_extendedprice AS y, l_quantity * 2100 AS y_hat FROM lineitem"
M_FULL = ["mse", "rmse", "mae", "r2_score", "mape"]


def preds(spark, sf):
    li = V.table(spark, sf, "lineitem")
    return li.select(F.col("l_returnflag").alias("model"), "l_linestatus", "l_shipdate",
                     F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2100).alias("y_hat"))


def _metric_sql(group: str = "", yhat: str = "y_hat", src: str = f"({PRED})") -> str:
    sel = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return (f"SELECT {sel}CAST(count(y - {yhat}) AS BIGINT) AS n, avg((y - {yhat}) * (y - {yhat})) AS mse, "
            f"sqrt(avg((y - {yhat}) * (y - {yhat}))) AS rmse, avg(abs(y - {yhat})) AS mae, "
            f"1 - sum((y - {yhat}) * (y - {yhat})) / (var_pop(y) * count(*)) AS r2_score, "
            f"avg(abs((y - {yhat}) / (y + 1e-10))) * 100 AS mape FROM {src}{gb}")


@register("metrics_basic", O.rounded(
    f"SELECT avg(abs(y - y_hat)) AS mae, sqrt(avg((y - y_hat) * (y - y_hat))) AS rmse, "
    f"1 - sum((y - y_hat) * (y - y_hat)) / (var_pop(y) * count(*)) AS r2 FROM ({PRED})",
    ["mae", "rmse", "r2"]))
def metrics_basic(spark, sf):
    """MAE, RMSE, R^2 in one pass."""
    return EV.metrics(preds(spark, sf), "y", "y_hat", full=False)


@register("metrics_full", O.rounded(_metric_sql("model"), M_FULL))
def metrics_full(spark, sf):
    """MSE, RMSE, MAE, R^2, MAPE per model."""
    return EV.metrics(preds(spark, sf), "y", "y_hat", by=["model"])


_NULL_PRED = ("(SELECT l_returnflag AS model, l_extendedprice AS y, CASE WHEN l_orderkey % 7 <> 0 "
              "THEN l_quantity * 2100 END AS y_hat FROM lineitem)")


@register("metrics_null_predictions", O.rounded(
    "SELECT a.*, b.n_unscored FROM (" + _metric_sql("model", src=_NULL_PRED + " WHERE y_hat IS NOT NULL")
    + ") a JOIN (SELECT model, CAST(count(*) - count(y_hat) AS BIGINT) AS n_unscored FROM " + _NULL_PRED
    + " GROUP BY model) b ON a.model = b.model", M_FULL))
def metrics_null_predictions(spark, sf):
    """N2 where some rows have no prediction: all metrics over the scored rows,
    and how many were left out."""
    li = V.table(spark, sf, "lineitem")
    p = li.select(F.col("l_returnflag").alias("model"), F.col("l_extendedprice").alias("y"),
                  F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity") * 2100).alias("y_hat"))
    return EV.metrics(p, "y", "y_hat", by=["model"], unscored=True)


@register("drift_shift", O.rounded(O.with_(
    O.CHAIN_CLEAN, "SELECT row_id, " + ", ".join(
        f"{c} + 0.2 * (SELECT stddev_samp(CAST({c} AS DOUBLE)) FROM meter_clean) AS {c}" for c in S.NUMERIC)
    + " FROM meter_clean"), S.NUMERIC))
def drift_shift(spark, sf):
    """Every numeric column += 0.2 * sample std."""
    d = V.meter_clean(spark, sf).select(S.ROW_ID, *S.NUMERIC)
    return EV.drift_shift(d, S.NUMERIC, 0.2)


def _degr_sql():
    drifted = (f"(SELECT *, y_hat + 0.25 * stddev_samp(y_hat) OVER () AS y_hat_d FROM ({PRED}))")
    base = _metric_sql("model", "y_hat", drifted)
    drift = _metric_sql("model", "y_hat_d", drifted)
    parts = [f"SELECT b.model, '{m}' AS metric, b.{m} AS base, d.{m} AS drifted, "
             f"(d.{m} - b.{m}) / b.{m} * 100 AS change_pct FROM ({base}) b JOIN ({drift}) d ON b.model = d.model"
             for m in ("rmse", "mae", "r2_score")]
    return O.rounded(" UNION ALL ".join(parts), ["base", "drifted", "change_pct"])


@register("degradation", _degr_sql())
def degradation(spark, sf):
    """Metric change when every prediction shifts by 0.25 * std."""
    p = preds(spark, sf)
    pd_ = EV.drift_shift(p, ["y_hat"], 0.25)
    return EV.degradation(EV.metrics(p, "y", "y_hat", ["model"]),
                          EV.metrics(pd_, "y", "y_hat", ["model"]), ["model"])


# ---------------------------------------------------------------- ledger
def _runs(spark, sf):
    m = (preds(spark, sf).groupBy("l_linestatus", "model")
         .agg(*EV.metric_aggs(F.col("y"), F.col("y_hat")), F.max("l_shipdate").alias("start_time")))
    return L.as_runs(m, "l_linestatus", "model", M_FULL, param_cols=["n"], tag_cols=["model"],
                     start_time="start_time")


def _ledger(spark, sf):
    path = scratch_path(spark, "run_ledger")
    for _attempt in range(2):  # a retried commit counts once
        L.run_append(_runs(spark, sf), path)
    return spark, path


RUNS_SQL = ("runs AS (SELECT l_linestatus AS experiment, md5(l_linestatus || '/' || model) AS run_id, "
            "'run_' || model AS run_name, max(l_shipdate) AS start_time, CAST(count(*) AS BIGINT) AS n, "
            "avg((y - y_hat) * (y - y_hat)) AS mse, sqrt(avg((y - y_hat) * (y - y_hat))) AS rmse, "
            "avg(abs(y - y_hat)) AS mae, 1 - sum((y - y_hat) * (y - y_hat)) / (var_pop(y) * count(*)) AS r2_score, "
            "avg(abs((y - y_hat) / (y + 1e-10))) * 100 AS mape "
            f"FROM ({PRED}) GROUP BY l_linestatus, model)")


def flat(runs):
    return runs.select("experiment", "run_id", "run_name", "start_time",
                       F.col("params")["n"].cast("bigint").alias("n"),
                       *[F.col("metrics")[k].alias(k) for k in M_FULL])


@register("run_append", O.rounded(
    f"WITH {RUNS_SQL} SELECT experiment, run_id, run_name, start_time, n, {', '.join(M_FULL)} FROM runs", M_FULL))
def run_append(spark, sf):
    """O1: append run records (MAP params/metrics/tags) partitioned by experiment; read back flat."""
    spark, path = _ledger(spark, sf)
    return flat(L.read_runs(spark, path))


@register("run_search", O.rounded(
    f"WITH {RUNS_SQL} SELECT experiment, run_id, run_name, start_time, n, {', '.join(M_FULL)} FROM runs "
    "WHERE experiment = 'F'", M_FULL))
def run_search(spark, sf):
    """O2: runs of one experiment via partition pruning."""
    spark, path = _ledger(spark, sf)
    return flat(L.run_search(spark, path, "F"))


@register("run_compare", O.rounded(
    f"WITH {RUNS_SQL} SELECT experiment, run_id, run_name, rmse, mae, r2_score FROM runs",
    ["rmse", "mae", "r2_score"]))
def run_compare(spark, sf):
    """O3: comparison table sorted by RMSE."""
    spark, path = _ledger(spark, sf)
    return L.run_compare(L.read_runs(spark, path))


@register("best_run", O.rounded(
    f"WITH {RUNS_SQL} SELECT experiment, arg_min(run_id, (rmse, run_id)) AS run_id, "
    "arg_min(run_name, (rmse, run_id)) AS run_name, min(rmse) AS rmse FROM runs GROUP BY experiment", ["rmse"]))
def best_run(spark, sf):
    """Best run per experiment by RMSE."""
    spark, path = _ledger(spark, sf)
    return L.best_run(L.read_runs(spark, path), "rmse")


@register("latest_run", f"WITH {RUNS_SQL} SELECT experiment, arg_max(run_id, (start_time, run_id)) AS run_id, "
          "arg_max(run_name, (start_time, run_id)) AS run_name, max(start_time) AS start_time "
          "FROM runs GROUP BY experiment")
def latest_run(spark, sf):
    """Newest run per experiment."""
    spark, path = _ledger(spark, sf)
    return L.latest_run(L.read_runs(spark, path))


# ---------------------------------------------------------------- G1
@register("table_equal", O.with_(
    O.CHAIN_FEATURES, "SELECT 'meter_features' AS \"table\", CAST(count(*) AS BIGINT) AS rows_a, "
    "CAST(count(*) AS BIGINT) AS rows_b, CAST(0 AS BIGINT) AS only_in_a, CAST(0 AS BIGINT) AS only_in_b, "
    "CAST(1 AS BIGINT) AS equal FROM meter_features"))
def table_equal(spark, sf):
    """G1: two runs of the feature stage compared exactly (stored table vs fresh plan)."""
    return G.table_equal(V.meter_features(spark, sf), V.build_meter_features(spark, sf), "meter_features")


_RULED = [c for c in S.NUMERIC]


@register("cell_diff", O.with_(O.CHAIN_CLEAN, " UNION ALL ".join(
    f"SELECT f.row_id, '{c}' AS \"column\", {O.normalize_double(f'CAST(f.{c} AS DOUBLE)')} AS value_a, "
    f"{O.normalize_double(f'CAST(r.{c} AS DOUBLE)')} AS value_b FROM meter_filled f JOIN meter_ruled r "
    f"ON f.row_id = r.row_id WHERE f.{c} IS DISTINCT FROM r.{c}" for c in _RULED)))
def cell_diff(spark, sf):
    """G1 keyed: every cell the quality rules changed (full outer join, null-safe compare)."""
    from meterlake.operators.clean import clean_rules
    filled = V.meter_filled(spark, sf).select(S.ROW_ID, *_RULED)
    ruled = clean_rules(filled)
    return G.cell_diff(filled, ruled, S.ROW_ID, _RULED, as_type="double")
