"""Cleaning pipeline on the reference's 'raw with issues' shape and on the
driver tables: invariants of the cleaned table."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from meterlake import schema as S
from meterlake.operators import clean as C
from meterlake.plans import views as V


def issues_frame(spark):
    rows = []
    start = datetime(2018, 1, 1)
    days = ["Monday", "Tuesday", "Wednesday"]
    for i in range(50):
        usage = None if i <= 5 else str(10 + i)
        ws = None if 10 <= i <= 15 else ("Weekday" if i % 2 else "Weekend")
        lpf = str(100 + 20 * i) if 20 <= i <= 25 else "0.8"
        co2 = str(20 + i) if 30 <= i <= 35 else "0.01"
        nsm = str(90000 + 2000 * i) if 40 <= i <= 45 else str(1000 + i)
        rows.append((i, (start + timedelta(hours=i)).strftime("%Y-%m-%d %H:%M:%S"), usage, "10.0", "5.0", co2,
                     lpf, "0.9", nsm, ws, days[i % 3], ["Light_Load", "Medium_Load", "Maximum_Load"][i % 3]))
    return spark.createDataFrame(rows, S.RAW_SCHEMA)


def test_clean_invariants(spark):
    out = C.clean(issues_frame(spark))
    assert dict(out.dtypes)[S.NSM] == "bigint" and dict(out.dtypes)[S.DATE] == "timestamp_ntz"
    rows = out.collect()
    assert len(rows) == 50
    for r in rows:
        for c in S.CATEGORICAL:
            assert r[c] is not None and r[c] == r[c].upper()
        assert r[S.TARGET] is not None and r[S.TARGET] <= 157.18
        assert r[S.LAG_PF] <= 100 and r[S.CO2] <= 0.02 and r[S.NSM] <= 85500
    # usage nulls filled with the median of their load type
    med = {x["load_type"]: x["median"] for x in C.group_median(
        C.clean_categoricals(C.clean_types(issues_frame(spark))), S.TARGET, S.LOAD_TYPE).collect()}
    for r in rows:
        if r[S.ROW_ID] <= 5:
            assert r[S.TARGET] == med[r[S.LOAD_TYPE]]


def test_missing_file_raises(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException

    from meterlake.sources.io import scan_csv_raw
    with pytest.raises(AnalysisException):
        scan_csv_raw(spark, str(tmp_path / "missing.csv")).count()


def test_driver_tables_clean(spark, sf):
    out = V.build_meter_clean(spark, sf)
    nulls = out.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in S.NUMERIC + S.CATEGORICAL]).first()
    assert all(v == 0 for v in nulls.asDict().values())
