"""Sources, stage keys and scratch folders."""

import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from meterlake import schema as S
from meterlake import session
from meterlake.plans import views as V
from meterlake.sources import io as IO
from meterlake.sources import tables


def test_csv_is_bound_by_header(spark, tmp_path):
    names = [S.CSV_NAMES[c] for c in reversed(S.METER_COLUMNS)]
    line = [f"v{i}" for i in range(len(names))]
    (tmp_path / "a.csv").write_text(",".join(["mixed_type_col", *names]) + "\n" + ",".join(["x", *line]) + "\n")
    got = IO.scan_csv_raw(spark, str(tmp_path / "a.csv")).first().asDict()
    assert got == dict(zip(reversed(S.METER_COLUMNS), line))


def test_csv_missing_column_is_null_and_bad_id_too(spark, tmp_path):
    name = S.CSV_NAMES[S.METER_COLUMNS[0]]
    (tmp_path / "b.csv").write_text(f"row_id,{name}\n7,x\nseven,y\n")
    rows = IO.scan_csv_raw(spark, str(tmp_path / "b.csv")).collect()
    assert [(r.row_id, r[S.METER_COLUMNS[0]], r[S.METER_COLUMNS[1]]) for r in rows] == [
        (7, "x", None), (None, "y", None)]


def test_stage_tables_follow_a_rewritten_source(spark, sf, tmp_path):
    shutil.copyfile(f"{sf}/events.parquet", tmp_path / "events.parquet")  # content only: the table may be read-only
    first = V.meter_clean(spark, str(tmp_path))
    n = first.count()
    assert V.meter_clean(spark, str(tmp_path)) is first
    pq.write_table(pq.read_table(f"{sf}/events.parquet").slice(0, n // 2), tmp_path / "events.parquet")
    assert V.meter_clean(spark, str(tmp_path)).count() == n // 2


def test_only_small_sources_are_spread(spark, monkeypatch):
    small = spark.range(100).coalesce(1)
    assert tables.spread(small).rdd.getNumPartitions() > 1
    monkeypatch.setattr(tables, "SPREAD_BYTES", 1)
    assert tables.spread(small).rdd.getNumPartitions() == 1


def test_no_machine_local_scratch_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_rulefit_uses_every_row_and_keeps_its_bound(spark):
    from meterlake.operators.models import fit_rulefit
    df = spark.range(400).select(
        F.col("id").alias("row_id"), (F.col("id") % 17).cast("double").alias("a"),
        (F.col("id") % 5).cast("double").alias("b"),
        ((F.col("id") % 17) * 2 + F.when(F.col("id") % 5 > 2, 30).otherwise(0)).cast("double").alias("label"))
    model, table = fit_rulefit(df, ["a", "b"], max_rules=3, n_trees=6)
    assert len(model.rules) <= 3 and table.where("kind = 'rule'").count() == len(model.rules)


def test_scratch_is_one_folder_per_application(spark):
    path = session.scratch_path(spark, "x")
    assert path.startswith(session.scratch_root(spark)) and spark.sparkContext.applicationId in path
    assert path != session.scratch_path(spark, "x")
