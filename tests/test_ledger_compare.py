"""Idempotent ledger commits, comparison by key ranges, category numbering,
stored distinct sketches, stream recovery."""

import pytest
from pyspark.sql import functions as F

from meterlake.operators import compare as G
from meterlake.operators import ledger as L
from meterlake.operators import prep as PR
from meterlake.operators import profile as P
from meterlake.session import scratch_path


def runs(spark, ids, experiment="e"):
    rows = [(experiment, f"r{i}", float(i)) for i in ids]
    df = spark.createDataFrame(rows, "exp string, run string, rmse double")
    return L.as_runs(df.withColumn("at", F.lit("2024-01-01 00:00:00")), "exp", "run", ["rmse"], start_time="at")


def test_commit_twice_equals_once(spark):
    path = scratch_path(spark, "ledger")
    assert L.run_append(runs(spark, [1, 2, 3]), path) is True
    assert L.run_append(runs(spark, [3, 1, 2]), path) is False  # the same batch in another order
    assert L.run_append(runs(spark, [3, 4]), path) is True      # one run is new
    assert L.run_append(runs(spark, [4, 1]), path) is True and L.read_runs(spark, path).count() == 4  # none is
    assert L.run_append(runs(spark, [1], "f"), path) is True
    names = sorted((r.experiment, r.run_name) for r in L.read_runs(spark, path).collect())
    assert names == [("e", "run_r1"), ("e", "run_r2"), ("e", "run_r3"), ("e", "run_r4"), ("f", "run_r1")]
    plan = L.run_search(spark, path, "f")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(experiment" in plan


def test_unpublished_data_is_not_read(spark):
    """A job that died before its marker, and one that died writing it."""
    path = scratch_path(spark, "ledger")
    batch = runs(spark, [1, 2])
    batch.write.partitionBy("experiment").parquet(f"{path}/data/attempt=dead")
    assert L.read_runs(spark, path).count() == 0
    marker, fs = L._fs(spark, f"{path}/commits/{L.batch_name(batch)}")
    out = fs.create(marker, False)
    out.write(bytearray(b"data/attempt=de"))
    out.close()
    assert L.read_runs(spark, path).count() == 0
    assert L.run_append(batch, path) is True and L.read_runs(spark, path).count() == 2
    assert L.publish(spark, path, L.batch_name(batch), "data/attempt=dead") is False  # a racing writer comes late


@pytest.fixture(scope="module")
def table(spark):
    path = scratch_path(spark, "wide")
    (spark.range(20_000).select("id", (F.col("id") * 2).alias("x"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("y"),
                                F.when(F.col("id") % 11 > 0, F.col("id") / 3).alias("z"))
     .repartitionByRange(8, "id").write.parquet(path))
    return spark.read.parquet(path)


def test_one_cell_reads_one_range(table):
    other = table.withColumn("z", F.when(F.col("id") == 12_345, F.lit(-1.0)).otherwise(F.col("z")))
    found, inside = G.differing_ranges(table, other, "id", ["x", "y", "z"], 100)
    assert len(found) == 1 and table.where(inside).count() == 200
    scan = table.where(inside)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,12200)" in scan and "LessThanOrEqual(id,12399)" in scan
    assert [tuple(r) for r in G.cell_diff(table, other, "id").collect()] == [(12_345, "z", "4115.0", "-1.0")]
    assert G.cell_diff(table, table, "id").count() == 0


@pytest.mark.parametrize("key", ["id", "name"])
def test_all_kinds_of_differences(table, key):
    a = table.withColumn("name", F.concat(F.lit("k"), F.col("id").cast("string")))
    b = (a.where("id NOT IN (5, 17000)").withColumn("y", F.when(F.col("id") == 9, None).otherwise(F.col("y")))
         .withColumn("x", F.when(F.col("id") == 14_000, None).otherwise(F.col("x"))))
    b = b.unionByName(a.where("id = 6").withColumn("id", F.lit(-3).cast("long")).withColumn("name", F.lit("new")))
    cols = ["x", "y", "z"]
    got = {tuple(r) for r in G.cell_diff(a, b, key, cols, ranges=50).collect()}
    ja, jb = {r[key]: r for r in a.collect()}, {r[key]: r for r in b.collect()}
    want = set()
    for k in ja.keys() | jb.keys():
        for c in cols:
            p, q = (j[k][c] if k in j else None for j in (ja, jb))
            if p != q:
                want.add((k, c, None if p is None else str(p), None if q is None else str(q)))
    assert got == want and len(got) >= 9


def test_digests_tell_null_places_apart(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "x", None)], "id long, p string, q string")
    b = spark.createDataFrame([(1, "x", None), (2, "x", None)], "id long, p string, q string")
    assert {(r["id"], r["column"]) for r in G.cell_diff(a, b, "id").collect()} == {(1, "p"), (1, "q")}
    assert G.cell_diff(a.limit(0), b.limit(0), "id").count() == 0


def test_categories_are_numbered_over_many_tasks(spark):
    df = spark.range(30_000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 10 > 0, F.pmod(F.xxhash64("id"), F.lit(17_000)))
                                    .alias("a"), F.concat(F.lit("v"), (F.col("id") % 12_000).cast("string")).alias("b"))
    codes = PR.numbered_categories(df.select(F.col("a").cast("string").alias("a"), "b"), ["a", "b"])
    assert codes.select("column", "code").distinct().count() == codes.count()
    got = {r.row_id: (r.a, r.b) for r in PR.category_codes(df, ["a", "b"]).collect()}
    rows = df.collect()
    place = [{v: i for i, v in enumerate(sorted({r[c] for r in rows if r[c] is not None}))} for c in ("a", "b")]
    # Columns of different types are numbered as text.
    place[0] = {v: i for i, v in enumerate(sorted({r.a for r in rows if r.a is not None}, key=str))}
    assert got == {r.row_id: (place[0].get(r.a, -1), place[1].get(r.b, -1)) for r in rows}
    assert "Window" not in codes._jdf.queryExecution().optimizedPlan().toString()


def test_sparse_onehot(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "row_id long, g string")
    got = {r.row_id: (r.onehot["size"], r.onehot["indices"], r.onehot["values"]) for r in PR.onehot_sparse(df, "g").collect()}
    assert got == {1: (2, [0], [1.0]), 2: (2, [], []), 3: (2, [], []), 4: (2, [1], [1.0])}
    assert PR.onehot_sparse(df.limit(0), "g").count() == 0


def test_transformer_with_very_many_categories(spark):
    """More than MAX_CATEGORIES values: fitted, stored as a table, applied."""
    df = spark.range(12_500).select(F.col("id").alias("row_id"), F.when(F.col("id") != 3, F.format_string("v%05d", F.col("id"))).alias("g"),
                                    F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("h"))
    df = df.unionByName(df.where("row_id = 77").withColumn("row_id", F.lit(99_999).cast("long")))  # the mode
    p = PR.fit(df, num_skew=[], num_lin=[], cat_nom=["g", "h"], cat_ord=[])
    again = PR.Preprocessor.from_table(p.to_table(spark))
    assert p.sparse["g"][0] == 12_499 and again.sparse == p.sparse and again.output_names() == ["cat_nom__g", "cat_nom__h_y"]
    new = spark.createDataFrame([(1, "v00000", "y"), (2, "v00005", "x"), (3, None, "y"), (4, "unknown", None)],
                                "row_id long, g string, h string")
    got = {r.row_id: (r["cat_nom__g"]["size"], r["cat_nom__g"]["indices"], r["cat_nom__h_y"]) for r in again.transform(new).collect()}
    # v00003 is missing, so v00005 is category 4 and v00077 (the mode) 76.
    assert got == {1: (12_498, [], 1.0), 2: (12_498, [3], 0.0), 3: (12_498, [75], 1.0), 4: (12_498, [], 1.0)}
    assert p.transform(df).count() == 12_501


def test_distinct_sketches_unite_without_a_rescan(spark):
    df = spark.range(40_000).select((F.col("id") % 9_000).alias("u"), (F.col("id") % 8).alias("day"))
    kept = P.distinct_sketches(df, ["u"], F.col("day"))
    assert kept.count() == 8
    r = P.united_estimates(kept).first()
    assert r["parts"] == 8 and abs(r["estimate"] - 9_000) < 450
    some = P.united_estimates(kept.where("part < 2")).first()
    assert some["parts"] == 2 and some["estimate"] <= r["estimate"] + 450


def test_profilers_give_a_row_for_a_column_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert {r["column"]: r["n_out"] for r in P.iqr_outliers(df, ["a", "b"]).collect()} == {"a": 0, "b": 0}
    assert {r["column"]: (r["q1"], r["fliers"]) for r in P.boxplot_stats(df, ["a", "b"]).collect()} == {"a": (None, 0), "b": (1.25, 0)}
    assert {r["column"] for r in P.describe_numeric(df, ["a", "b"]).collect()} == {"a", "b"}


def test_stream_ends_alike_after_a_kill(spark, sf, tmp_path):
    """The query dies inside its second epoch, after that epoch's responses were
    written; started again from its checkpoint it replays the epoch and ends
    with the batch result, every request answered once."""
    from meterlake.operators import score as SC
    from meterlake.plans import views as V
    from meterlake.streaming import score_stream as ST

    model, reqs = SC.FIXED_RULES, SC.requests_from_meter(V.meter_clean(spark, sf))
    src, out, rej, ckpt = (str(tmp_path / n) for n in ("in", "out", "rejects", "ckpt"))
    ST.write_request_files(reqs.repartition(6), src)
    parse, calls = SC.score_parsed, []

    def dies_in_the_second_epoch(parsed, *a):
        calls.append(1)
        done = parse(parsed, *a)
        if len(calls) == 2:
            done.write.parquet(f"{out}/epoch=1")  # half of the epoch's output is there
            raise RuntimeError("killed")
        return done

    SC.score_parsed = dies_in_the_second_epoch
    try:
        q = ST.score_stream(spark, src, out, rej, model, checkpoint=ckpt, max_files_per_trigger=2)
        with pytest.raises(Exception):
            q.awaitTermination()
    finally:
        SC.score_parsed = parse
    before = spark.read.parquet(out).where("epoch = 0").count()
    assert len(calls) == 2 and 0 < before < reqs.count()
    q = ST.score_stream(spark, src, out, rej, model, checkpoint=ckpt, max_files_per_trigger=2)
    q.awaitTermination()
    answers = spark.read.parquet(out)
    assert answers.select("epoch").distinct().count() == 3
    resp, verdicts = SC.score_requests(reqs, model)
    # Responses carry the time they were made at.
    text = F.regexp_replace("response", '"prediction_timestamp":"[^"]*"', "")
    got = sorted((r[0], r[1]) for r in answers.select("request_id", text).collect())
    assert got == sorted((r[0], r[1]) for r in resp.select("request_id", text).collect())
    assert len({r[0] for r in got}) == len(got)
    refused = spark.read.parquet(rej)
    assert refused.count() == refused.select("request_id").distinct().count() == verdicts.where("accepted = 0").count()
