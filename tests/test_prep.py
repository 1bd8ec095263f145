"""Fitted transformers: constant columns, unknown categories, round trip."""


from meterlake.operators import prep as PR


def test_minmax_constant_onehot_unknown_ordinal(spark):
    fit_df = spark.createDataFrame(
        [(1, 1.0, 5.0, "WEEKDAY", "LIGHT_LOAD"), (2, 3.0, 5.0, "WEEKEND", "MAXIMUM_LOAD"),
         (3, None, 5.0, "WEEKDAY", "MEDIUM_LOAD")],
        "row_id long, a double, c double, week_status string, load_type string")
    p = PR.fit(fit_df, num_skew=[], num_lin=["a", "c"])
    assert p.medians["a"] == 2.0 and p.categories["week_status"] == ["WEEKDAY", "WEEKEND"]
    new = spark.createDataFrame([(9, None, 7.0, "HOLIDAY", "UNKNOWN_LOAD")],
                                "row_id long, a double, c double, week_status string, load_type string")
    r = p.transform(new).first().asDict()
    assert r["num_lin__a"] == 0.5                 # imputed median, scaled
    assert r["num_lin__c"] == 2.0                 # constant column has scale 1: x - min
    assert r["cat_nom__week_status_WEEKEND"] == 0.0
    assert r["cat_ord__load_type"] == -1.0
    again = PR.Preprocessor.from_table(p.to_table(spark))
    assert again.transform(new).first().asDict() == r


def test_split_deterministic(spark):
    df = spark.range(1000).withColumnRenamed("id", "row_id")
    a, b = PR.split_80_20(df)
    a2, _ = PR.split_80_20(df.repartition(7))
    assert a.count() + b.count() == 1000
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in a2.collect())


def test_standard_scale_population(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0)], "row_id long, x double")
    got = sorted(r.x for r in PR.standard_scale(df, ["x"]).collect())
    assert got == [-1.0, 1.0]
