"""Boosting with an L2 leaf penalty against NumPy and against its own export."""

import hashlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterlake.operators import boost as B

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.random((500, 3)), 2)
    y = 10 * (x[:, 0] > 0.4) + 5 * x[:, 1] + rng.normal(0, 0.1, 500)
    pdf = pd.DataFrame(np.column_stack([x, y]), columns=[*FEATS, "label"])
    pdf.insert(0, "row_id", np.arange(500))
    return spark.createDataFrame(pdf), pdf


def test_same_model_on_any_partitioning_and_error_falls(rows):
    df, pdf = rows
    one = B.fit_gbt_l2(df.coalesce(1), FEATS, rounds=3, max_depth=3, step=0.5, col_sample=1.0)
    many = B.fit_gbt_l2(df.repartition(7), FEATS, rounds=3, max_depth=3, step=0.5, col_sample=1.0)
    for a, b in zip(one.trees, many.trees):
        assert all(np.array_equal(getattr(a, f), getattr(b, f)) for f in ("feature", "bin", "g", "h", "value"))
    out = one.transform(df.select("row_id", *FEATS, "label"))
    assert out.columns == ["row_id", *FEATS, "label", "prediction"]
    err = out.agg(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).first()[0]
    assert err < 0.15 * pdf["label"].var()


def test_leaf_values_from_exported_splits(spark, rows, tmp_path):
    """First tree: DuckDB walks the exported splits over the rows and computes
    -G / (H + 1) of every leaf."""
    df, pdf = rows
    m = B.fit_gbt_l2(df, FEATS, rounds=1, max_depth=3, subsample=1.0, col_sample=1.0)
    nodes = m.nodes(spark).toPandas()
    base = m.base
    con = duckdb.connect()
    con.register("readings", pdf)
    con.register("nodes", nodes)
    got = con.execute(f"""
        WITH RECURSIVE walk AS (SELECT row_id, a, b, c, label, 0 AS node FROM readings UNION ALL
          SELECT r.row_id, a, b, c, label, 2 * r.node + CASE WHEN CASE n.feature WHEN 'a' THEN a WHEN 'b' THEN b ELSE c END
            < n.threshold - 1e-12 THEN 1 ELSE 2 END FROM walk r JOIN nodes n ON n.node = r.node AND n.feature IS NOT NULL)
        SELECT n.node, n.value, -sum({base} - label) / (count(*) + 1.0), n.h, count(*) FROM walk JOIN nodes n USING (node)
        WHERE n.feature IS NULL GROUP BY ALL""").fetchall()
    assert len(got) >= 4
    for _, value, want, h, n in got:
        assert abs(value - want) < 1e-4 and h == n


def test_first_split_is_the_best_of_all(rows):
    df, pdf = rows
    m = B.fit_gbt_l2(df, FEATS, rounds=1, max_depth=1, subsample=1.0, col_sample=1.0, l2=2.0)
    g = m.base - pdf["label"].to_numpy()
    best = None
    for j, c in enumerate(FEATS):
        x = pdf[c].to_numpy()
        k = np.clip(np.floor((x - m.low[j]) / m.width[j]), 0, B.BINS - 1)
        for cut in np.unique(k)[:-1]:
            down = k <= cut
            gain = (g[down].sum() ** 2 / (down.sum() + 2) + g[~down].sum() ** 2 / ((~down).sum() + 2))
            if best is None or gain > best[0] + 1e-6:
                best = (gain, j, int(cut))
    assert (m.trees[0].feature[0], m.trees[0].bin[0]) == best[1:]


def test_odd_rows(spark, rows):
    df, _ = rows
    odd = df.withColumn("b", F.when(F.col("row_id") % 5 > 0, F.col("b"))).withColumn("c", F.lit(3.0)).withColumn(
        "label", F.when(F.col("row_id") % 9 > 0, F.col("label")))
    m = B.fit_gbt_l2(odd, FEATS, rounds=2, max_depth=2)
    assert all(t.feature.max() < 2 for t in m.trees)  # the constant column is never split
    assert m.trees[0].h[0] <= odd.where("label IS NOT NULL").count()
    assert m.transform(odd).where("prediction IS NULL").count() == 0
    none = B.fit_gbt_l2(odd.limit(0), FEATS, rounds=1, max_depth=2)
    assert none.transform(odd).agg(F.max("prediction")).first()[0] == 0.0


def test_fewer_rows_summed_than_the_levels_hold(rows, monkeypatch):
    """Below the root a pass sums the smaller child of every split; the tree is
    that of all sums."""
    df, _ = rows
    summed, passes = [], B._histograms

    def seen(*a):
        out = passes(*a)
        summed.append(sum(int(h[0].sum()) for _, h in out.values()))
        return out

    monkeypatch.setattr(B, "_histograms", seen)
    t = B.fit_gbt_l2(df, FEATS, rounds=1, max_depth=4, subsample=1.0, col_sample=1.0).trees[0]
    assert summed[0] == 500 and len(summed) == 4 and max(summed[1:]) <= 250
    for i in np.flatnonzero(t.feature >= 0):
        assert t.h[2 * i + 1] + t.h[2 * i + 2] == t.h[i] and abs(t.g[2 * i + 1] + t.g[2 * i + 2] - t.g[i]) < 1e-9


def test_samples_and_predictions_across_written_blocks(rows, monkeypatch):
    """Blocks of a few rows, trees past two rewrites: the samples are those of
    the row ids and the model that of one block."""
    df, _ = rows
    fit = lambda: B.fit_gbt_l2(df, FEATS, rounds=5, max_depth=2, step=0.5)
    one = fit()
    monkeypatch.setattr(B, "BLOCK", 7)
    monkeypatch.setattr(B, "KEEP", 2)
    many = fit()
    for t, (a, b) in enumerate(zip(one.trees, many.trees)):
        assert a.h[0] == sum(int(hashlib.md5(f"42:{t}:{i}".encode()).hexdigest()[:8], 16) % 1000 < 800 for i in range(500))
        assert np.array_equal(a.feature, b.feature) and np.array_equal(a.bin, b.bin) and np.array_equal(a.h, b.h)
        assert np.allclose(a.value, b.value, atol=1e-3)


def test_trees_take_their_own_columns():
    picks = [B.sampled_columns(10, t, 0.8, 42) for t in range(20)]
    assert all(len(p) == 8 and p == sorted(p) for p in picks) and len({tuple(p) for p in picks}) > 5
