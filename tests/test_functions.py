"""Scalar functions and the pandas-vs-Spark traps, hand-computed."""

import math

from pyspark.sql import functions as F

from meterlake.functions import expr as X
from meterlake.functions.rules import QUALITY_RULES, apply_rule


def one(spark, col, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(col).collect()]


def test_numeric_text_nan_and_suffixes(spark):
    got = one(spark, X.to_double_or_null("x"), ["1.5", " 2.5 ", "NaN", "nan", "1.0d", "2f", "abc", "", None,
                                                 "inf", "-1e3", ".5"])
    assert got[:2] == [1.5, 2.5]
    assert got[2:9] == [None] * 7          # NaN -> NULL (S1); Spark-only suffixes rejected (S2)
    assert math.isinf(got[9]) and got[10] == -1000.0 and got[11] == 0.5


def test_timestamp_parse_explicit_format(spark):
    got = one(spark, X.to_timestamp_or_null("x"), ["2024-01-02 03:04:05", "bad", "2024", None])
    assert str(got[0]) == "2024-01-02 03:04:05" and got[1:] == [None, None, None]


def test_strip_all_whitespace_and_tokens(spark):
    got = one(spark, X.null_tokens(X.normalize_text("x")), ["\tweekday \n", " nan ", "null", "", "Light_Load"])
    assert got == ["WEEKDAY", None, None, None, "LIGHT_LOAD"]   # S4, S5


def test_truncation_toward_zero(spark):
    got = one(spark, X.truncate_to_long("x"), [85499.99, -1.5, 2.0], "double")
    assert got == [85499, -1, 2]                                # S16


def test_weekday_monday_zero_and_flag(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-01-07 10:00:00",), (None,)], "d string")
    r = df.select(X.weekday_mon0(X.to_timestamp_or_null("d")).alias("w"),
                  X.flag(X.weekday_mon0(X.to_timestamp_or_null("d")) >= 5).alias("we")).collect()
    assert [(x.w, x.we) for x in r] == [(0, 0), (6, 1), (None, 0)]


def test_quality_rules(spark):
    rules = {r.column: r for r in QUALITY_RULES}
    cases = {"co2_tco2": [(0.1, 0.02), (0.3, 0.3 / 100000), (0.01, 0.01)],
             "lagging_reactive_kvarh": [(98.0, 96.91), (150.0, 1.5), (-5.0, -5.0)],
             "nsm": [(90000.0, 900.0), (85500.0, 85500.0)],
             "usage_kwh": [(200.0, 0.2), (157.19, 0.15719)],
             "leading_power_factor": [(150.0, 1.5), (100.0, 100.0), (20000.0, 100.0)]}
    for c, pairs in cases.items():
        got = one(spark, apply_rule(rules[c], F.col("x")), [a for a, _ in pairs], "double")
        assert got == [b for _, b in pairs], c


def test_safe_ratio_and_cyclic(spark):
    df = spark.createDataFrame([(1.0, 0.0, 6)], "a double, b double, h int")
    s, c = X.cyclic(F.col("h"), 24)
    r = df.select(X.safe_ratio("a", "b").alias("r"), s.alias("s"), c.alias("c")).first()
    assert r.r == 1.0 / 1e-6 and abs(r.s - 1.0) < 1e-12 and abs(r.c) < 1e-12


def test_exclude_target_features(spark, sf):
    from meterlake.operators.features import TARGET_DERIVED, engineer
    from meterlake.plans import views as V
    cols = engineer(V.meter_clean(spark, sf), exclude_target_features=True).columns
    assert not set(TARGET_DERIVED) & set(cols) and "hour_sin" in cols
