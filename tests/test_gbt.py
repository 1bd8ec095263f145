"""Boosted trees on histograms: MLlib's own trees, by one task or by passes."""

import numpy as np
from pyspark.sql import functions as F

from meterlake.operators import gbt as GB
from meterlake.operators import models as MD


def table(spark, n, parts=3):
    x = [(F.pmod(F.xxhash64("id", F.lit(s)), F.lit(m)) / m).alias(c) for s, m, c in ((1, 1000, "a"), (2, 9, "b"), (3, 400, "c"))]
    return spark.range(0, n, 1, parts).select("id", *x).withColumn(
        "label", F.when(F.col("a") > 0.5, 4 * F.col("b")).otherwise(F.col("c") * F.col("c") - 2) + F.sin("id"))


def test_trees_are_mllibs(spark, monkeypatch):
    """With all rows and columns nothing is drawn: the same predictions, and the same rules."""
    df = table(spark, 2_000)
    args = dict(cols=list("abc"), rounds=6, max_depth=4, subsample=1.0, col_sample="all")
    theirs = MD.predict_ml(MD.fit_gbt(df, **args), df).select("id", F.col("prediction").alias("p"))
    rules = MD.fit_rulefit(df, list("abc"), n_trees=6)[0]
    monkeypatch.setattr(MD, "SMALL_ROWS", 100)
    model = MD.fit_gbt(df, **args)
    assert isinstance(model.stages[-1], GB.Boosted) and len(model.stages[-1].trees) == 6
    both = MD.predict_ml(model, df).join(theirs, "id").select("prediction", "p").toPandas()
    assert len(both) == 2_000 and np.allclose(both["prediction"], both["p"])
    again = MD.fit_rulefit(df, list("abc"), n_trees=6)[0]
    assert again.pool == rules.pool and [r[1] for r in again.rules] == [r[1] for r in rules.rules]


def test_passes_grow_the_trees_of_one_task(spark, monkeypatch):
    """Also over the trees after which predictions are written down."""
    rows = GB.rows_of(MD.assemble(table(spark, 1_500), list("abc")), "features", "label", 42)
    monkeypatch.setattr(GB, "KEEP", 2)
    one, many = (GB.fit_boosted(rows, 5, 0.1, 3, 0.8, 0.6, 42, local_rows=n) for n in (10_000, 100))
    assert len(one.trees) == len(many.trees) == 5
    for a, b in zip(one.trees, many.trees):
        assert len(a.feature) > 3 and all((x == y).all() for x, y in zip((a.feature, a.cut, a.left, a.value), (b.feature, b.cut, b.left, b.value)))


def test_pca_boosting_takes_the_same_way(spark, monkeypatch):
    monkeypatch.setattr(MD, "SMALL_ROWS", 100)
    df = table(spark, 600)
    model, k = MD.fit_pca_regressor(df, list("abc"), "gbt", rounds=3, max_depth=2)
    assert isinstance(model.stages[-1], GB.Boosted)
    rows = MD.predict_ml(model, df)
    assert rows.count() == 600 and {"id", "a", "b", "c", "label", "prediction"} <= set(rows.columns)
