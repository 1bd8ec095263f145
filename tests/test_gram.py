"""One-pass statistics: sums, the lasso on them, correlations of wide tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from meterlake.operators import gram as G
from meterlake.operators import models as MD


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 6))
    x[:, 3] = x[:, 0] + 0.1 * x[:, 3]          # correlated
    x[:, 5] = 2.5                              # constant
    y = 3 * x[:, 0] - 2 * x[:, 1] + 0.5 * rng.normal(size=600) + 7
    pdf = pd.DataFrame(np.column_stack([x, y]), columns=[*"abcdef", "y"])
    return spark.createDataFrame(pdf).repartition(5), pdf


def test_sums_match_numpy_whatever_the_partitions(table, spark):
    df, pdf = table
    g = G.reduced(df, list(pdf.columns), G.centred_gram)[0]
    one = np.column_stack([np.ones(600), pdf.to_numpy()])
    assert np.allclose(g, one.T @ one, rtol=1e-12)
    n, mean, s = G.moments_of(g)
    assert n == 600 and np.allclose(mean, pdf.mean()) and np.allclose(s / 599, pdf.cov())
    assert G.reduced(df.limit(0), list(pdf.columns), G.centred_gram)[0].sum() == 0


@pytest.mark.parametrize("lam", [2.0, 0.3, 0.02])
def test_lasso_equals_a_fit_over_the_rows(table, lam):
    df, pdf = table
    stats = G.LassoStatistics(G.reduced(df, list(pdf.columns), G.centred_gram)[0])
    b = stats.solve(lam)
    g = stats.gradient(b)
    assert (np.abs(g[b == 0]) <= lam + 1e-8).all() and np.allclose(g[b != 0], lam * np.sign(b[b != 0]), atol=1e-8)
    coef, intercept = stats.coefficients(b)
    assert coef[5] == 0.0  # a constant column is out
    vec = VectorAssembler(inputCols=list("abcdef"), outputCol="features").transform(df)
    m = LinearRegression(labelCol="y", elasticNetParam=1.0, regParam=lam, maxIter=500, tol=1e-12).fit(vec)
    other = m.coefficients.toArray()
    assert np.allclose(coef, other, atol=5e-3) and abs(intercept - m.intercept) < 1e-2

    def objective(w):  # the fit over the rows stops a little short of it
        z = w * stats.sd[:-1]
        return z @ stats.c @ z / 2 - stats.r @ z + lam * np.abs(z).sum()

    assert objective(coef) <= objective(other) + 1e-12 and objective(other) - objective(coef) < 1e-4


def test_rulefit_path_reads_rows_once(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.random((500, 3))
    y = 4 * (x[:, 0] > 0.5) + 2 * (x[:, 1] <= 0.3) + x[:, 2] + rng.normal(0, 0.05, 500)
    df = spark.createDataFrame(pd.DataFrame(np.column_stack([x, y]), columns=["a", "b", "c", "label"])).cache()
    calls = []
    whole = MD.reduced
    monkeypatch.setattr(MD, "reduced", lambda *a: calls.append(1) or whole(*a))
    model, rules = MD.fit_rulefit(df, ["a", "b", "c"], max_rules=6, n_trees=20)
    assert len(calls) == 1 and 1 <= len(model.rules) <= 6
    check = MD.kkt(df, model).first()
    assert (check.rows, check.zero_over_penalty, check.kept_off_penalty, check.centred) == (500, 0, 0, 1)
    for r in rules.where("kind = 'rule'").collect():
        assert abs(df.where(F.expr(r.condition)).count() / 500 - r.support) < 1e-12
    err = model.transform(df).agg(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).first()[0]
    assert err < 0.2 * np.var(y)


def test_pca_is_fitted_once_and_sliced(table, monkeypatch):
    df, pdf = table
    fits = []
    whole = MD.PCA.fit
    monkeypatch.setattr(MD.PCA, "fit", lambda self, *a, **k: fits.append(1) or whole(self, *a, **k))
    model, k, ev = MD.fit_pca95(df, list("abcde"))
    assert len(fits) == 1 and len(model.transform(df).first()["features"]) == k
    r = MD.pca_check(df, list("abcde")).first()
    assert abs(r.total_variance - pdf[list("abcde")].var().sum()) < 1e-9 and r.uncorrelated == r.same_k == 1


def test_pairwise_correlation_with_missing_values(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(1e6, 3.0, size=(400, 7)) + rng.normal(size=(400, 1))
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 5] = 4.0
    x[1:, 6] = np.nan
    pdf = pd.DataFrame(x, columns=list("abcdefg"))
    df = spark.createDataFrame(pdf).repartition(4)
    df = df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in df.columns])
    assert np.allclose(G.pairwise_corr(df, list("abcde")), pdf[list("abcde")].corr(min_periods=2), atol=1e-9)
    r = G.pairwise_corr(df, list("abcdefg"))
    assert np.isnan(r[5]).all() and np.isnan(r[6]).all() and np.isnan(G.pairwise_corr(df.limit(0), ["a", "b"])).all()
