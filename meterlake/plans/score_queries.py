"""Registered queries: sources and sinks (A1-A7), rule scoring (M6) and the
request path (A8, A9, M2-M4).  Requests are built from the cleaned meter
table (FIXTURES.md: 10-record requests, every 7th with one bad field); the
oracle rebuilds each record from the same rows, so Spark's JSON encode ->
decode round trip is checked against the source values."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake import schema as S
from meterlake.functions.rules import REQUEST_ENUMS, REQUEST_RANGES, REQUEST_REQUIRED
from meterlake.operators import score as SC
from meterlake.plans import oracle as O
from meterlake.plans import views as V
from meterlake.plans.feature_queries import _prep_names, _prep_oracle
from meterlake.plans.registry import register
from meterlake.session import scratch_path
from meterlake.sources import io as IO

NUM_NO_NSM = [c for c in S.NUMERIC if c != S.NSM]


@register("scan_csv_raw", O.rounded(O.with_(O.CHAIN_TYPED, "SELECT row_id, date, " + ", ".join(
    f"{O.num(c)} AS {c}" for c in S.NUMERIC) + ", " + ", ".join(S.CATEGORICAL) + " FROM meter_raw"), S.NUMERIC))
def scan_csv_raw(spark, sf):
    """A1: raw CSV (file column names, all STRING) read back with a declared
    schema; numeric text compared as DOUBLE (its text form is engine-specific)."""
    from meterlake.functions import expr as X
    path = scratch_path(spark, "raw_csv")
    IO.write_csv(IO.to_file_names(V.meter_raw(spark, sf)), path)
    raw = IO.scan_csv_raw(spark, path)
    return raw.select(*[X.to_double_or_null(c).alias(c) if c in S.NUMERIC else F.col(c) for c in raw.columns])


@register("scan_clean", O.rounded(O.with_(O.CHAIN_CLEAN, "SELECT * FROM meter_clean"), NUM_NO_NSM))
def scan_clean(spark, sf):
    """A3: cleaned CSV read with its declared schema and timestamp format."""
    path = scratch_path(spark, "clean_csv")
    IO.sink_clean(V.meter_clean(spark, sf), path, fmt="csv")
    return IO.scan_clean(spark, path, fmt="csv")


@register("sink_clean", O.rounded(O.with_(O.CHAIN_CLEAN, "SELECT * FROM meter_clean"), NUM_NO_NSM))
def sink_clean(spark, sf):
    """A4: write the cleaned table as parquet and read it back."""
    path = scratch_path(spark, "clean_parquet")
    IO.sink_clean(V.build_meter_clean(spark, sf), path)
    return IO.scan_clean(spark, path)


@register("load_features", _prep_oracle(label=True))
def load_features(spark, sf):
    """A5 + A2: one feature table (row_id, 30 features, label) written and read back."""
    f = V.meter_features(spark, sf)
    p = V.fitted_preprocessor(spark, sf)
    path = scratch_path(spark, "features")
    table = f.select(S.ROW_ID, *p.columns(), F.col(S.TARGET).alias("label"))
    IO.sink_features(table, p.output_names(), path)
    x, y = IO.load_features(spark, path)
    return x.join(y, S.ROW_ID)


def _original(name: str) -> str:
    rest = name.split("__", 1)[1]
    return "week_status" if rest.startswith("week_status") else rest


@register("feature_info", O.with_(O.CHAIN_FEATURES, "SELECT feature, \"group\", original, CAST(position AS BIGINT) "
    "AS position, (SELECT CAST(count(*) AS BIGINT) FROM meter_features) AS n_rows FROM (VALUES " + ", ".join(
    f"('{n}', '{n.split('__', 1)[0]}', '{_original(n)}', {i})" for i, n in enumerate(_prep_names()))
    + ") t(feature, \"group\", original, position)"))
def feature_info(spark, sf):
    """A5: the feature table written whole, with its column-group metadata
    (processed and original names) and the rows written."""
    f = V.meter_features(spark, sf)
    p = V.fitted_preprocessor(spark, sf)
    path = scratch_path(spark, "finfo")
    info = IO.sink_features(p.transform(f), p.output_names(), path)
    return info.withColumn("n_rows", F.lit(spark.read.parquet(path).count()))


@register("scan_csv_reordered", O.rounded(O.with_(O.CHAIN_TYPED, "SELECT date, " + ", ".join(
    f"{O.num(c)} AS {c}" for c in S.NUMERIC) + ", " + ", ".join(S.CATEGORICAL) + " FROM meter_raw"), S.NUMERIC))
def scan_csv_reordered(spark, sf):
    """A1: a file with permuted columns, an unknown column and no row_id."""
    from meterlake.functions import expr as X
    path = scratch_path(spark, "raw_csv_reordered")
    raw = V.meter_raw(spark, sf).select(*reversed(S.METER_COLUMNS)).withColumn(
        "mixed_type_col", F.lit("x"))
    IO.write_csv(IO.to_file_names(raw.select(S.METER_COLUMNS[3], "mixed_type_col", *[
        c for c in raw.columns if c not in (S.METER_COLUMNS[3], "mixed_type_col")])), path)
    back = IO.scan_csv_raw(spark, path)
    return back.select(*[X.to_double_or_null(c).alias(c) if c in S.NUMERIC else F.col(c) for c in back.columns])


def _rules_sql(src: str) -> str:
    m = SC.FIXED_RULES
    ind = [f"CAST(coalesce({cond}, false) AS DOUBLE)" for _r, cond, _c in m.rules]
    pred = f"{float(m.intercept)}" + "".join(f" + {float(c)} * {e}" for (_r, _cd, c), e in zip(m.rules, ind)) \
        + "".join(f" + {float(k)} * CAST({c} AS DOUBLE)" for c, k in m.linear)
    return ", ".join(f"{e} AS {r}" for (r, _c, _k), e in zip(m.rules, ind)) + f", {pred} AS prediction"


@register("score_rules", O.rounded(O.with_(
    O.CHAIN_CLEAN, f"SELECT row_id, {_rules_sql('meter_clean')} FROM meter_clean"), ["r1", "r2", "r3", "prediction"]))
def score_rules(spark, sf):
    """M6: fixed rule set as Column expressions in one projection."""
    d = V.meter_clean(spark, sf)
    return SC.score_rules(d).select(S.ROW_ID, "r1", "r2", "r3", "prediction")


@register("sink_predictions", O.rounded(O.with_(
    O.CHAIN_CLEAN, f"SELECT row_id, prediction FROM (SELECT row_id, {_rules_sql('meter_clean')} FROM meter_clean)"),
    ["prediction"]))
def sink_predictions(spark, sf):
    """Append (row_id, prediction, predicted_at) and read back."""
    path = scratch_path(spark, "predictions")
    IO.sink_predictions(SC.score_rules(V.meter_clean(spark, sf)), path)
    return spark.read.parquet(path).select(S.ROW_ID, "prediction")


# ---------------------------------------------------------------- requests
def _api_case(c):
    return f"upper(substr({c}, 1, 1)) || lower(substr({c}, 2))"


REQ_REC = (
    "req_rec AS (SELECT CAST(floor(row_id / 10) AS BIGINT) AS request_id, CAST(row_id % 10 AS BIGINT) AS pos, "
    "CAST(count(*) OVER (PARTITION BY floor(row_id / 10)) AS BIGINT) AS n_records, "
    "strftime(date, '%Y-%m-%d %H:%M:%S') AS date, "
    "CASE WHEN floor(row_id / 10) % 7 = 0 AND row_id % 10 = 0 THEN 150.0 ELSE lagging_reactive_kvarh END "
    "AS \"Lagging_Current_Reactive_Power_kVarh\", leading_reactive_kvarh AS \"Leading_Current_Reactive_Power_kVarh\", "
    "co2_tco2 AS \"CO2(tCO2)\", lagging_power_factor / 100 AS \"Lagging_Current_Power_Factor\", "
    "leading_power_factor / 100 AS \"Leading_Current_Power_Factor\", CAST(nsm AS BIGINT) AS \"NSM\", "
    f"{_api_case('week_status')} AS \"WeekStatus\", {_api_case('day_of_week')} AS \"Day_of_week\", "
    "CASE load_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SC.API_LOAD.items())
    + " END AS \"Load_Type\" FROM meter_clean)")
API_DOUBLES = [f.name for f in SC.RECORD_TYPE.fields if f.dataType.simpleString() == "double"]


def _q(name):
    return f'"{name}"'


@register("request_explode", O.rounded(O.with_(O.CHAIN_CLEAN + [REQ_REC], "SELECT * FROM req_rec"),
                                       [_q(c) for c in API_DOUBLES]))
def request_explode(spark, sf):
    """JSON request bodies -> one row per record (from_json + posexplode)."""
    return SC.decode_requests(SC.requests_from_meter(V.meter_clean(spark, sf)))


def _reason_sql():
    checks = [f"CASE WHEN {_q(f)} IS NULL THEN '{f}:missing' END" for f in REQUEST_REQUIRED]
    checks += [f"CASE WHEN NOT ({_q(r.field)} BETWEEN {r.lo} AND {r.hi}) THEN '{r.field}:out_of_range' END"
               for r in REQUEST_RANGES]
    checks += [f"CASE WHEN {_q(f)} NOT IN ({', '.join(repr(v) for v in vals)}) THEN '{f}:invalid' END"
               for f, vals in REQUEST_ENUMS.items()]
    checks.append("CASE WHEN date IS NOT NULL AND try_strptime(date, '%Y-%m-%d %H:%M:%S') IS NULL "
                  "THEN 'date:unparsable' END")
    checks.append("CASE WHEN n_records < 1 OR n_records > 1000 THEN 'data:size' END")
    return ("req_reason AS (SELECT request_id, reason FROM (SELECT request_id, unnest(["
            + ", ".join(checks) + "]) AS reason FROM req_rec) WHERE reason IS NOT NULL)")


VERDICT = ("verdict AS (SELECT r.request_id, max(r.n_records) AS n_records, "
           "coalesce((SELECT string_agg(DISTINCT x.reason, ';' ORDER BY x.reason) FROM req_reason x "
           "WHERE x.request_id = r.request_id), '') AS reasons FROM req_rec r GROUP BY r.request_id)")


@register("validate_requests", O.with_(
    O.CHAIN_CLEAN + [REQ_REC, _reason_sql(), VERDICT],
    "SELECT request_id, n_records, reasons, CAST(reasons = '' AS BIGINT) AS accepted FROM verdict"))
def validate_requests(spark, sf):
    """M2: per-field checks, a bad record rejects its whole request (reasons listed)."""
    v = SC.validate_requests(SC.requests_from_meter(V.meter_clean(spark, sf)))
    return v.select("request_id", "n_records", F.array_join("reasons", ";").alias("reasons"), "accepted")


FORMS = 8


@register("validate_request_forms", O.with_(
    O.CHAIN_CLEAN + [REQ_REC, _reason_sql(), VERDICT],
    "SELECT request_id, CASE WHEN request_id % 8 = 7 THEN 0 ELSE n_records END AS n_records, "
    "CASE WHEN request_id % 8 = 7 THEN 'data:size' WHEN request_id % 8 = 6 THEN "
    "(SELECT string_agg(x, ';' ORDER BY x) FROM (SELECT unnest(list_distinct(list_concat("
    "string_split(nullif(reasons, ''), ';'), ['Lagging_Current_Power_Factor:invalid_type']))) AS x)) "
    "ELSE reasons END AS reasons, CAST(request_id % 8 < 6 AND reasons = '' AS BIGINT) AS accepted FROM verdict"))
def validate_request_forms(spark, sf):
    """The requests re-spelled by request id: as they are, NSM as
    an integral float, numbers as text, the other CO2 name, ISO dates, dates
    alone; then a wrong type and a broken body."""
    reqs = SC.requests_from_meter(V.meter_clean(spark, sf))
    body, form = F.col("body"), F.pmod(F.col("request_id"), F.lit(FORMS))
    spelled = [
        (1, F.regexp_replace(body, r'"NSM":(\d+)', r'"NSM":$1.0')),
        (2, F.regexp_replace(body, r'(_Factor"):([0-9.E-]+)', r'$1:"$2"')),
        (3, F.replace(body, F.lit('"CO2(tCO2)"'), F.lit('"CO2_tCO2"'))),
        (4, F.regexp_replace(body, r'"date":"([0-9-]+) ', r'"date":"$1T')),
        (5, F.regexp_replace(body, r'"date":"([0-9-]+) [0-9:]+"', r'"date":"$1"')),
        (6, F.regexp_replace(body, r'"Lagging_Current_Power_Factor":[0-9.E-]+',
                             '"Lagging_Current_Power_Factor":"high"')),
        (7, F.concat(F.lit("{{"), F.substring(body, 1, 40)))]
    text = body
    for k, e in spelled:
        text = F.when(form == k, e).otherwise(text)
    v = SC.validate_requests(reqs.select("request_id", text.alias("body")))
    return v.select("request_id", "n_records", F.array_join("reasons", ";").alias("reasons"), "accepted")


REQ_INT = ("req_int AS (SELECT request_id, n_records, pos, try_strptime(date, '%Y-%m-%d %H:%M:%S') AS date, "
           "\"Lagging_Current_Reactive_Power_kVarh\" AS lagging_reactive_kvarh, "
           "\"Leading_Current_Reactive_Power_kVarh\" AS leading_reactive_kvarh, \"CO2(tCO2)\" AS co2_tco2, "
           "\"Lagging_Current_Power_Factor\" AS lagging_power_factor, "
           "\"Leading_Current_Power_Factor\" AS leading_power_factor, \"NSM\" AS nsm, "
           "upper(\"WeekStatus\") AS week_status, upper(\"Day_of_week\") AS day_of_week, "
           "upper(\"Load_Type\") AS load_type FROM req_rec)")
REQ_FEAT = ("req_feat AS (SELECT * EXCLUDE (date, day_of_week) FROM ("
            + O.feature_select("req_int", inference=True) + "))")
FEAT_DOUBLES = (["lagging_reactive_kvarh", "leading_reactive_kvarh", "co2_tco2", "lagging_power_factor",
                 "leading_power_factor"] + S.CYCLIC + S.POWER_FACTOR + S.REACTIVE + S.INTENSITY)


@register("request_features", O.rounded(O.with_(
    O.CHAIN_CLEAN + [REQ_REC, REQ_INT, REQ_FEAT], "SELECT * FROM req_feat"), FEAT_DOUBLES))
def request_features(spark, sf):
    """M3 + M4: API names -> internal names, inference features."""
    rec = SC.decode_requests(SC.requests_from_meter(V.meter_clean(spark, sf)))
    return SC.request_features(rec)


@register("response_pack", O.rounded(O.with_(
    O.CHAIN_CLEAN + [REQ_REC, _reason_sql(), VERDICT, REQ_INT, REQ_FEAT],
    "SELECT request_id, CAST(count(*) AS BIGINT) AS n_predictions, sum(prediction) AS pred_sum, "
    f"'{SC.MODEL_VERSION}' AS model_version FROM (SELECT request_id, {_rules_sql('req_feat')} FROM req_feat "
    "WHERE request_id IN (SELECT request_id FROM verdict WHERE reasons = '')) GROUP BY request_id"),
    ["pred_sum"]))
def response_pack(spark, sf):
    """Accepted requests scored and packed as JSON responses (checked unpacked)."""
    reqs = SC.requests_from_meter(V.meter_clean(spark, sf))
    resp, _verdicts = SC.score_requests(reqs, SC.FIXED_RULES)
    return SC.unpack_responses(resp)


@register("score_stream", ORACLE_RESPONSE := O.rounded(O.with_(
    O.CHAIN_CLEAN + [REQ_REC, _reason_sql(), VERDICT, REQ_INT, REQ_FEAT],
    "SELECT request_id, CAST(count(*) AS BIGINT) AS n_predictions, sum(prediction) AS pred_sum, "
    f"'{SC.MODEL_VERSION}' AS model_version FROM (SELECT request_id, {_rules_sql('req_feat')} FROM req_feat "
    "WHERE request_id IN (SELECT request_id FROM verdict WHERE reasons = '')) GROUP BY request_id"),
    ["pred_sum"]))
def score_stream(spark, sf):
    """The request files scored by a Structured Streaming query (availableNow,
    foreachBatch, per-epoch idempotent sink); equals the batch responses."""
    from meterlake.streaming.score_stream import run_to_completion
    reqs = SC.requests_from_meter(V.meter_clean(spark, sf))
    responses, _rejects = run_to_completion(spark, reqs, SC.FIXED_RULES)
    return SC.unpack_responses(responses)


@register("align_predictions", O.rounded(O.with_(
    O.CHAIN_CLEAN, f"SELECT p.row_id, c.usage_kwh AS label, p.prediction FROM "
    f"(SELECT row_id, {_rules_sql('meter_clean')} FROM meter_clean) p JOIN meter_clean c ON p.row_id = c.row_id"),
    ["label", "prediction"]))
def align_predictions(spark, sf):
    """C4: predictions paired with labels by key (1:1 equi-join on row_id), not by position."""
    d = V.meter_clean(spark, sf)
    pred = SC.score_rules(d).select(S.ROW_ID, "prediction")
    labels = d.select(S.ROW_ID, F.col(S.TARGET).alias("label"))
    return pred.join(labels, S.ROW_ID)
