"""Plan properties: no cross products or nested-loop joins, no Python UDFs,
filters pushed to the stage-table scan."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

FORBIDDEN = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|"
                       r"PythonUDF|FlatMapGroupsInPandas|MapInPandas")
SAMPLE = ["clean_job", "fill_group_median", "feat_high_flag", "iqr_outliers", "boxplot_stats",
          "histogram50", "preprocess_apply", "drift_shift", "degradation", "validate_requests",
          "response_pack", "table_equal", "cell_diff", "best_run"]


@pytest.mark.parametrize("key", SAMPLE)
def test_no_cross_join_no_python(spark, sf, key):
    import __spark_entry__ as E
    df = E.queries()[key](spark, sf)
    text = df._jdf.queryExecution().toString()
    assert not FORBIDDEN.search(text), FORBIDDEN.findall(text)


def test_no_row_udf_in_library():
    # The optional llm folder is left out: its operators choose their style one by one.
    src = "\n".join(p.read_text() for p in Path(__file__).resolve().parents[1].joinpath("meterlake").rglob("*.py")
                    if "llm" not in p.parts)
    assert "F.udf(" not in src and "@udf" not in src and "pandas_udf" not in src


def test_stage_scan_prunes_and_pushes(spark, sf):
    from meterlake.plans import views as V
    d = V.meter_clean(spark, sf).where(F.col("load_type") == "LIGHT_LOAD").select("usage_kwh")
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(load_type,LIGHT_LOAD)" in plan
    assert "ReadSchema: struct<usage_kwh:double,load_type:string>" in plan
