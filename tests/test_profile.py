"""Profiling operators against hand-computed values."""

import pytest
from pyspark.sql import functions as F

from meterlake.operators import profile as P
from meterlake.operators.clean import column_modes


def test_bias_corrected_skew_kurt(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    m = P.moments(df, ["x"]).first()
    assert m.skew == pytest.approx(1.7636, abs=1e-4)          # pandas skew (S6)
    assert m.kurt == pytest.approx(3.228, abs=1e-3)           # pandas kurt


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "s string")
    assert column_modes(df, ["s"]).first()["mode"] == "a"


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "x double")
    h = {r.bin: r.n for r in P.histogram(df, "x", 10).collect()}
    assert len(h) == 10 and h[0] == 1 and h[5] == 1 and h[9] == 1


def test_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None)], "k int, s string")
    assert P.duplicate_rows(df).first().duplicate_rows == 3
    n = {r.column: r.nulls for r in P.null_counts(df).collect()}
    assert n == {"k": 0, "s": 2}


def test_iqr_and_zscore(spark):
    vals = [float(v) for v in range(1, 21)] + [100.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = P.iqr_outliers(df, ["x"]).first()
    assert (r.q1, r.q3, r.n_out) == (6.0, 16.0, 1)
    z = P.zscore_outliers(df, ["x"]).first()
    assert z.n_out == 1


def test_corr_self_is_one(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0 + 1).alias("b"))
    c = {(r.a, r.b): r.r for r in P.corr_matrix(df, ["a", "b"]).collect()}
    assert c[("a", "b")] == pytest.approx(1.0) and c[("b", "a")] == pytest.approx(1.0)


def test_constant_columns_do_not_raise(spark):
    from meterlake.operators.evaluate import metrics
    df = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "y double, p double")
    m = metrics(df, "y", "p").first()
    assert m.r2_score is None and m.rmse == 1.0
    z = P.zscore_outliers(df, ["y"]).first()
    assert z.n_out == 0
    h = P.histogram(df, "y", 5, density=True).collect()
    assert sum(r.n for r in h) == 2
    assert P.normal_overlay(df, "y", 3).count() == 3
