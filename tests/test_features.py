"""Feature derivation: presence and ranges (the reference's feature tests),
on the driver's meter view."""

from pyspark.sql import functions as F

from meterlake import schema as S
from meterlake.operators.features import engineer, engineer_inference
from meterlake.plans import views as V


def test_feature_columns_and_ranges(spark, sf):
    f = engineer(V.meter_clean(spark, sf))
    assert set(S.ENGINEERED) <= set(f.columns)
    r = f.agg(F.min("month").alias("m0"), F.max("month").alias("m1"), F.min("hour").alias("h0"),
              F.max("hour").alias("h1"), F.min("day_of_week_num").alias("d0"), F.max("day_of_week_num").alias("d1"),
              *[F.max(F.abs(c)).alias(c) for c in S.CYCLIC],
              F.countDistinct("is_weekend").alias("we"), F.countDistinct(S.HIGH_FLAG).alias("hc")).first()
    assert 1 <= r.m0 <= r.m1 <= 12 and 0 <= r.h0 <= r.h1 <= 23 and 0 <= r.d0 <= r.d1 <= 6
    assert all(r[c] <= 1.0 + 1e-12 for c in S.CYCLIC)
    assert r.we == 2 and r.hc == 2


def test_high_flag_is_strictly_above_median(spark, sf):
    f = engineer(V.meter_clean(spark, sf))
    share = f.agg(F.avg(S.HIGH_FLAG)).first()[0]
    assert 0.4 < share <= 0.5


def test_inference_form(spark, sf):
    f = engineer_inference(V.meter_clean(spark, sf))
    assert S.DATE not in f.columns and S.DAY_OF_WEEK not in f.columns
    r = f.agg(F.max(S.HIGH_FLAG).alias("hc"),
              F.max(F.abs(F.col("co2_per_kwh") - F.col(S.CO2) / 75.0)).alias("d")).first()
    assert r.hc == 0 and r.d == 0.0
