"""What a tree task holds: rows of its partition, histograms of its nodes."""

from pyspark.sql import functions as F

from meterlake.operators import models as MD


def table(spark, n, parts):
    return spark.range(0, n, 1, parts).select(
        (F.col("id") % 11).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
        (F.col("id") % 11 + F.col("id") % 3).cast("double").alias("label"))


def test_training_rows_are_dealt_into_bounded_partitions(spark):
    big = MD.dealt(table(spark, 5_000, 1), 500)
    sizes = [r[1] for r in big.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 5_000 and max(sizes) <= 600
    small = table(spark, 300, 2)
    assert MD.dealt(small, 500) is small


def test_tree_fits_read_bounded_partitions(spark, monkeypatch):
    """All three tree fits take their rows from the dealt table."""
    seen, real = [], MD.dealt
    monkeypatch.setattr(MD, "dealt", lambda df: seen.append(real(df, 100)) or seen[-1])
    df = table(spark, 1_000, 1)
    MD.fit_forest(df, ["a", "b"], num_trees=2, max_depth=2)
    MD.fit_gbt(df, ["a", "b"], rounds=2, max_depth=2)
    MD.fit_pca_regressor(df, ["a", "b"], "gbt", rounds=2, max_depth=2)
    MD.fit_rulefit(df, ["a", "b"], n_trees=2, exp_rand_tree_size=False)
    assert [d.rdd.getNumPartitions() for d in seen] == [10] * 4


def test_forest_histograms_leave_room_for_every_core(spark):
    model = MD.fit_forest(table(spark, 200, 1), ["a", "b"], num_trees=2, max_depth=2)
    assert model.stages[-1].getOrDefault("maxMemoryInMB") <= 128


def test_forest_in_parts_scores_as_the_mean_of_its_trees(spark, monkeypatch):
    """The driver holds a few trees at a time; nothing is lost of the others."""
    df = table(spark, 400, 1)
    monkeypatch.setattr(MD, "FOREST_NODES", 1_200)
    model = MD.fit_forest(df, ["a", "b"], num_trees=7, max_depth=4)
    parts = model.stages[-1].parts
    assert [n for _, n in parts] == [3, 3, 1]
    got = {r[0]: r[1] for r in MD.predict_ml(model, df).groupBy("a", "b").agg(F.max("prediction")).select(
        F.struct("a", "b"), "max(prediction)").collect()}
    want = {}
    data = MD.assemble(df, ["a", "b"])
    for path, n in parts:
        one = MD.RandomForestRegressionModel.load(path)
        assert one.getNumTrees == n
        for r in one.transform(data).groupBy("a", "b").agg(F.max("prediction").alias("p")).collect():
            want[(r.a, r.b)] = want.get((r.a, r.b), 0.0) + n * r.p / 7
    assert len(want) == 77 and all(abs(want[tuple(k)] - v) < 1e-9 for k, v in got.items())
    assert abs(model.stages[-1].featureImportances.toArray().sum() - 1) < 1e-9
    monkeypatch.setattr(MD, "FOREST_NODES", 1_000_000)
    assert not isinstance(MD.fit_forest(df, ["a", "b"], num_trees=7, max_depth=4).stages[-1], MD.ForestParts)
