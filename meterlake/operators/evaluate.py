"""Evaluation N1-N6: regression metrics (optionally per model), drift shift
and degradation.  Each metric set is one partial-aggregated pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAPE_EPS = 1e-10


def metric_aggs(y: Column, yhat: Column, full: bool = True) -> list[Column]:
    """One pass over the scored rows (label and prediction present): MSE, RMSE,
    MAE, R^2 (1 - SSE / (n * var_pop(y))) [, MAPE]; ``n`` counts them."""
    e = y - yhat
    y = F.when(e.isNotNull(), y)
    n = F.count(e)
    sse = F.sum(e * e)
    mse = F.try_divide(sse, n)
    # ANSI-safe: a constant label (zero variance) or empty input gives NULL, not an error
    r2 = 1 - F.try_divide(sse, F.var_pop(y) * n)
    out = [F.count(e).alias("n"), mse.alias("mse"), F.sqrt(mse).alias("rmse"),
           F.avg(F.abs(e)).alias("mae"), r2.alias("r2_score")]
    if full:
        out.append((F.avg(F.abs(F.try_divide(e, y + F.lit(MAPE_EPS)))) * 100).alias("mape"))
    return out


def metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = (),
            full: bool = True, unscored: bool = False) -> DataFrame:
    """N1 (``full=False``: MAE, RMSE, R^2) / N2 (+ MSE, MAPE); one row per ``by``
    group.  ``unscored`` adds the number of rows without label or prediction."""
    y, yh = F.col(label).cast("double"), F.col(prediction).cast("double")
    aggs = metric_aggs(y, yh, full)
    if unscored:
        aggs.append((F.count("*") - F.count(y - yh)).alias("n_unscored"))
    res = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    if not full:
        res = res.select(*by, "mae", "rmse", F.col("r2_score").alias("r2"))
    return res


def drift_shift(df: DataFrame, cols: Sequence[str], fraction: float = 0.2) -> DataFrame:
    """Every listed numeric column += fraction * its sample std.

    The stds come from one aggregate used as a scalar subquery (no join)."""
    cols = list(cols)
    st = df.agg(F.struct(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in cols])
                .alias("s")).scalar()
    return df.select(*[(F.col(c) + F.lit(float(fraction)) * st.getField(c)).alias(c) if c in cols
                       else F.col(c) for c in df.columns])


def degradation(base: DataFrame, drifted: DataFrame, keys: Sequence[str] = (),
                metrics_cols: Sequence[str] = ("rmse", "mae", "r2_score")) -> DataFrame:
    """(drift - base) / base * 100 per metric, long rows."""
    keys = list(keys)
    b = base.select(*keys, *[F.col(m).alias(f"base_{m}") for m in metrics_cols])
    d = drifted.select(*keys, *[F.col(m).alias(f"drift_{m}") for m in metrics_cols])
    j = b.join(d, keys) if keys else b.unionByName(d, allowMissingColumns=True).agg(
        *[F.max(f"base_{m}").alias(f"base_{m}") for m in metrics_cols],
        *[F.max(f"drift_{m}").alias(f"drift_{m}") for m in metrics_cols])
    rows = [F.struct(F.lit(m).alias("metric"), F.col(f"base_{m}").alias("base"),
                     F.col(f"drift_{m}").alias("drifted"),
                     (F.try_divide(F.col(f"drift_{m}") - F.col(f"base_{m}"), F.col(f"base_{m}")) * 100)
                     .alias("change_pct")) for m in metrics_cols]
    return j.select(*keys, F.inline(F.array(*rows)))
