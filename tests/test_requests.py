"""Request validation: the reference API's accept / reject cases."""

import json

import pytest

from meterlake.operators import score as SC

GOOD = {"date": "2018-01-15 14:30:00", "Lagging_Current_Reactive_Power_kVarh": 45.2,
        "Leading_Current_Reactive_Power_kVarh": 12.5, "CO2(tCO2)": 0.008,
        "Lagging_Current_Power_Factor": 0.85, "Leading_Current_Power_Factor": 0.78, "NSM": 5000,
        "WeekStatus": "Weekday", "Day_of_week": "Monday", "Load_Type": "Medium_Load"}


def verdict(spark, records):
    body = json.dumps({"data": records})
    df = spark.createDataFrame([(1, body)], "request_id long, body string")
    v = SC.validate_requests(df).first()
    return v.accepted, list(v.reasons)


def bad(**kw):
    r = dict(GOOD)
    for k, val in kw.items():
        if val is ...:
            r.pop(k)
        else:
            r[k] = val
    return r


@pytest.mark.parametrize("records,ok,reason", [
    ([GOOD], 1, None),
    ([GOOD, dict(GOOD, Load_Type="Maximum_Load", Day_of_week="Tuesday")], 1, None),
    ([bad(WeekStatus="InvalidStatus")], 0, "WeekStatus:invalid"),
    ([bad(Load_Type="InvalidLoad")], 0, "Load_Type:invalid"),
    ([bad(Lagging_Current_Reactive_Power_kVarh=150)], 0, "Lagging_Current_Reactive_Power_kVarh:out_of_range"),
    ([bad(Lagging_Current_Reactive_Power_kVarh=...)], 0, "Lagging_Current_Reactive_Power_kVarh:missing"),
    ([], 0, "data:size"),
    ([GOOD, bad(NSM=95000)], 0, "NSM:out_of_range"),
    ([bad(date="15/01/2018")], 0, "date:unparsable"),
    ([bad(NSM=100.0)], 1, None),
    ([bad(NSM=100.5)], 0, "NSM:invalid_type"),
    ([bad(Lagging_Current_Power_Factor="0.9")], 1, None),
    ([bad(Lagging_Current_Power_Factor="high")], 0, "Lagging_Current_Power_Factor:invalid_type"),
    ([bad(date="2018-01-15T14:30:00")], 1, None),
    ([bad(date="2018-01-15")], 1, None),
    ([{**bad(**{"CO2(tCO2)": ...}), "CO2_tCO2": 0.008}], 1, None),
    ([{**GOOD, "CO2_tCO2": 9.0}], 1, None),
    ([bad(**{"CO2(tCO2)": ...})], 0, "CO2(tCO2):missing"),
])
def test_reference_cases(spark, records, ok, reason):
    accepted, reasons = verdict(spark, records)
    assert accepted == ok
    if reason:
        assert reason in reasons


def test_too_many_records(spark):
    accepted, reasons = verdict(spark, [GOOD] * 1001)
    assert accepted == 0 and "data:size" in reasons


def test_scoring_response_shape(spark):
    body = json.dumps({"data": [GOOD, GOOD]})
    df = spark.createDataFrame([(7, body)], "request_id long, body string")
    resp, verdicts = SC.score_requests(df, SC.FIXED_RULES)
    r = json.loads(resp.first().response)
    assert r["n_predictions"] == 2 and len(r["predictions"]) == 2 and r["model_version"] == SC.MODEL_VERSION
    assert verdicts.first().accepted == 1


def test_validation_has_no_shuffle(spark):
    df = spark.createDataFrame([(1, json.dumps({"data": [GOOD]})), (2, "{"), (3, None)],
                               "request_id long, body string")
    v = SC.validate_requests(df)
    plan = v._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("from_json") <= 1
    got = {r.request_id: (r.n_records, r.accepted, r.reasons) for r in v.collect()}
    assert got == {1: (1, 1, []), 2: (0, 0, ["data:size"]), 3: (0, 0, ["data:size"])}
