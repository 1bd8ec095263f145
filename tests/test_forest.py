"""The histogram forest: every tree on a bootstrap of all rows, whole to its depth."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.operators import evaluate as EV
from meterlake.operators import forest as FO
from meterlake.operators import models as MD


def table(spark, n, parts=3):
    x = [(F.pmod(F.xxhash64("id", F.lit(s)), F.lit(1000)) / 1000).alias(c) for s, c in enumerate("abc")]
    return spark.range(0, n, 1, parts).select("id", *x).withColumn(
        "label", F.when(F.col("a") > 0.5, 4 * F.col("b")).otherwise(F.col("c") - 2) + F.col("id") % 3 / 10)


def test_large_tables_are_fitted_whole_without_the_driver(spark, monkeypatch):
    """Leaves hold the means of their rows, no deeper than asked, and quality is MLlib's."""
    monkeypatch.setattr(MD, "SMALL_NODES", 30_000)
    df = table(spark, 3_000)
    model = MD.fit_forest(df, list("abc"), num_trees=12, max_depth=7)
    forest = model.stages[-1]
    assert isinstance(forest, FO.Forest) and len(forest.tops) == 12
    assert abs(forest.featureImportances.toArray().sum() - 1) < 1e-9
    rows = MD.predict_ml(model, df)
    assert sorted(rows.columns) == sorted(["id", "a", "b", "c", "label", "prediction"])
    ours = EV.metrics(rows, "label", "prediction").first()
    monkeypatch.setattr(MD, "SMALL_NODES", 100_000)
    theirs = EV.metrics(MD.predict_ml(MD.fit_forest(df, list("abc"), num_trees=12, max_depth=7), df), "label", "prediction").first()
    assert ours["n"] == 3_000 and abs(ours["r2_score"] - theirs["r2_score"]) < 0.02 and ours["r2_score"] > 0.95


@pytest.mark.parametrize("local", [100_000, 500])
def test_trees_cover_their_bootstrap_and_score_as_their_mean(spark, monkeypatch, local):
    """Also where the upper levels are grown in passes over all rows."""
    monkeypatch.setattr(FO, "BLOCK", 512)
    df = MD.assemble(table(spark, 2_000, 2), list("abc"))
    forest = FO.fit_forest(df, "features", "label", 4, 6, 5, 7, local_rows=local)
    assert (max(len(t.feature) for t in forest.tops) > 1) == (local == 500)
    kinds = ("i2", "u1", "i4", "f8")
    cells: dict = {}
    for r in forest.branches(spark).collect():
        cells.setdefault(r["tree"], {})[r["cell"]] = FO.Nodes(*(np.frombuffer(bytes(r[c]), k) for c, k in zip(("feature", "cut", "left", "value"), kinds)), None)
    trees = [FO._joined(t, cells.get(i, {})) for i, t in enumerate(forest.tops)]
    rows = FO.vectors(df, "features", F.col("label").alias("y")).cache()
    blocks = FO.stored_blocks(rows, forest.cuts, forest.mean, forest.unit).collect()
    for i, t in enumerate(trees):
        w, s = np.zeros(len(t.feature)), np.zeros(len(t.feature))
        for b in blocks:  # as they were dealt in the fit: the same rows in the same blocks
            y = np.frombuffer(b["y"])
            at = t.reached(np.frombuffer(b["bins"], np.uint8).reshape(len(y), 3))
            weight = FO.weights(7, i, b["part"], b["block"], len(y))
            w += np.bincount(at, weight, len(w))
            s += np.bincount(at, weight * y, len(w))
        leaf = np.flatnonzero((t.feature < 0) & (w > 0))
        assert len(leaf) > 10 and w[leaf].min() >= 5 and FO._depth_of(t).max() <= 6
        assert np.allclose(s[leaf] / w[leaf], t.value[leaf])
    got = forest.transform(df).select("a", "b", "c", "prediction").toPandas()
    bins = FO.binned(got[list("abc")].to_numpy(), forest.cuts)
    want = sum(t.value[t.reached(bins)] for t in trees) / 4 * forest.unit + forest.mean
    assert len(got) == 2_000 and np.allclose(got["prediction"], want)


def test_branch_takes_the_best_split_of_all_rows():
    rng = np.random.default_rng(1)
    bins, w = rng.integers(0, 9, (400, 3)).astype(np.uint8), rng.poisson(1.0, 400)
    y = np.rint(10 * bins[:, 1] + rng.normal(size=400) * 5)
    live = w > 0
    one = FO.grown(bins[live], y[live], w[live], 1, 3, 2, rng)

    def left_over(j, b):
        parts = [(bins[:, j] <= b) & live, (bins[:, j] > b) & live]
        return sum((w[p] * (y[p] - np.average(y[p], weights=w[p])) ** 2).sum() for p in parts)

    best = min((left_over(j, b), j, b) for j in range(3) for b in range(8))
    assert (int(one.feature[0]), int(one.cut[0])) == best[1:] and len(one.feature) == 3


def test_thresholds_are_mllibs():
    assert FO.cut_points(np.array([3.0, 1.0, 1.0, np.nan, 2.0])).tolist() == [1.5, 2.5]
    assert len(FO.cut_points(np.arange(1000.0))) == 31
    assert FO.cut_points(np.zeros(5)).size == 0
    assert FO.binned(np.array([[1.5], [1.6], [np.nan]]), [np.array([1.5, 2.5])]).ravel().tolist() == [0, 1, 2]


def test_missing_labels_are_an_error(spark):
    df = MD.assemble(table(spark, 100).withColumn("label", F.when(F.col("id") > 5, F.col("label"))), list("abc"))
    with pytest.raises(ValueError):
        FO.fit_forest(df, "features", "label", 2, 3, 2, 1)
