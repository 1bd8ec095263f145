"""A sample of registered queries against their DuckDB oracle at sf0.001
(the full set runs with ``python tests/oracle_check.py <sf_dir>``)."""

import pytest

from oracle_check import compare, duck

SAMPLE = ["clean_job", "median_by_group", "describe_numeric", "corr_matrix", "histogram50",
          "feat_all", "preprocess_apply", "metrics_full", "validate_requests", "run_compare",
          "cell_diff", "iqr_outliers_lineitem"]


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("key", SAMPLE)
def test_matches_oracle(spark, sf, con, key):
    import __spark_entry__ as E
    r = compare(spark, con, sf, key, E.queries()[key], E.oracle_sql()[key])
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "usage_kwh" in df.columns
