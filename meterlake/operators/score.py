"""Scoring A8, A9, M1-M6.

Requests are JSON bodies ``{"data": [record, ...]}`` (1-1000 records).  The
batch path decodes with ``from_json`` + ``posexplode``, validates every field
against the rule tables (reasons collected as an array), rejects a whole
request when any record fails, renames API fields to internal names, builds
the inference features, applies the fitted preprocessor and a model, and
packs one JSON response per request.  All of it is built-in expressions; the
only per-request grouping is over at most 1000 records.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import schema as S
from meterlake.functions import expr as X
from meterlake.functions.rules import (MAX_RECORDS, MIN_RECORDS, REQUEST_ENUMS, REQUEST_RANGES,
                                       REQUEST_REQUIRED)
from meterlake.operators.features import engineer_inference
from meterlake.sources.io import rename_map

# The service's version string and record field names.
MODEL_VERSION = "1.0.0"

RECORD_TYPE = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("Lagging_Current_Reactive_Power_kVarh", T.DoubleType()),
    T.StructField("Leading_Current_Reactive_Power_kVarh", T.DoubleType()),
    T.StructField("CO2(tCO2)", T.DoubleType()),
    T.StructField("Lagging_Current_Power_Factor", T.DoubleType()),
    T.StructField("Leading_Current_Power_Factor", T.DoubleType()),
    T.StructField("NSM", T.IntegerType()),
    T.StructField("WeekStatus", T.StringType()),
    T.StructField("Day_of_week", T.StringType()),
    T.StructField("Load_Type", T.StringType()),
])
API_FIELDS = [f.name for f in RECORD_TYPE.fields]
# The CO2 field's two accepted names, and accepted date forms.
CO2_FIELD, CO2_ALIAS = "CO2(tCO2)", "CO2_tCO2"
DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd HH:mm", "yyyy-MM-dd"]
# Bodies are decoded as text, so that a value of another JSON type is checked
# for what it says instead of being lost.
REQUEST_TYPE = T.StructType([T.StructField("data", T.ArrayType(T.StructType(
    [T.StructField(f, T.StringType()) for f in [*API_FIELDS, CO2_ALIAS]])))])
# Load type spelling accepted by the API, per cleaned value.
API_LOAD = {"LIGHT_LOAD": "Light_Load", "MEDIUM_LOAD": "Medium_Load", "MAXIMUM_LOAD": "Maximum_Load"}


# ---------------------------------------------------------------- rule model (M6)
@dataclass
class RuleModel:
    """intercept + sum(coef * 1[condition]) + sum(coef * column)."""
    intercept: float
    rules: list[tuple[str, str, float]] = field(default_factory=list)   # (rule_id, SQL condition, coef)
    linear: list[tuple[str, float]] = field(default_factory=list)        # (column or SQL expression, coef)
    penalty: float = 0.0                                                 # lasso penalty of the fit, not stored
    pool: list[str] = field(default_factory=list)                        # all candidate conditions, not stored

    def rule_columns(self) -> list[Column]:
        return [F.coalesce(F.expr(cond), F.lit(False)).cast("double").alias(rid)
                for rid, cond, _ in self.rules]

    def prediction(self) -> Column:
        e = F.lit(float(self.intercept))
        for _rid, cond, coef in self.rules:
            e = e + F.lit(float(coef)) * F.coalesce(F.expr(cond), F.lit(False)).cast("double")
        for c, coef in self.linear:
            e = e + F.lit(float(coef)) * F.expr(c).cast("double")
        return e

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.prediction())

    def to_table(self, spark) -> DataFrame:
        rows = [(0, "intercept", "intercept", None, float(self.intercept))]
        rows += [(i + 1, "rule", rid, cond, float(c)) for i, (rid, cond, c) in enumerate(self.rules)]
        rows += [(len(self.rules) + i + 1, "linear", f"linear_{i}", c, float(k))
                 for i, (c, k) in enumerate(self.linear)]
        return spark.createDataFrame(
            rows, "position int, kind string, term string, expression string, coefficient double")


# A literal rule model used by the SQL-checked scoring queries.
FIXED_RULES = RuleModel(
    intercept=20.0,
    rules=[("r1", "nsm > 30000 AND load_type <> 'LIGHT_LOAD'", 15.0),
           ("r2", "lagging_reactive_kvarh > 40", 8.5),
           ("r3", "co2_tco2 <= 0.005 AND week_status = 'WEEKEND'", -6.0)],
    linear=[("lagging_reactive_kvarh", 0.3), ("leading_power_factor", -0.05)])


def score_rules(df: DataFrame, model: RuleModel = FIXED_RULES) -> DataFrame:
    """M6: one projection of rule indicators and the prediction."""
    return df.select("*", *model.rule_columns(), model.prediction().alias("prediction"))


# ---------------------------------------------------------------- requests
def requests_from_meter(clean: DataFrame, per_request: int = 10, bad_every: int = 7) -> DataFrame:
    """Fixture requests from the cleaned meter table (rescaled to API units):
    ``per_request`` consecutive rows per request; in every ``bad_every``-th
    request the first record carries an out-of-range reactive power."""
    rid = F.floor(F.col(S.ROW_ID) / per_request).cast("long")
    pos = F.pmod(F.col(S.ROW_ID), F.lit(per_request)).cast("int")
    bad = (F.pmod(rid, F.lit(bad_every)) == 0) & (pos == 0)
    load = F.lit(None).cast("string")
    for k, v in API_LOAD.items():
        load = F.when(F.col(S.LOAD_TYPE) == k, F.lit(v)).otherwise(load)
    rec = F.struct(
        F.date_format(S.DATE, X.TS_FORMAT).alias("date"),
        F.when(bad, F.lit(150.0)).otherwise(F.col(S.LAG_REACTIVE)).alias("Lagging_Current_Reactive_Power_kVarh"),
        F.col(S.LEAD_REACTIVE).alias("Leading_Current_Reactive_Power_kVarh"),
        F.col(S.CO2).alias("CO2(tCO2)"),
        (F.col(S.LAG_PF) / 100).alias("Lagging_Current_Power_Factor"),
        (F.col(S.LEAD_PF) / 100).alias("Leading_Current_Power_Factor"),
        F.col(S.NSM).cast("int").alias("NSM"),
        F.initcap(S.WEEK_STATUS).alias("WeekStatus"),
        F.initcap(S.DAY_OF_WEEK).alias("Day_of_week"),
        load.alias("Load_Type"))
    recs = clean.select(rid.alias("request_id"), pos.alias("pos"), rec.alias("rec"))
    return (recs.groupBy("request_id")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "rec"))).alias("items"))
            .select("request_id", F.to_json(F.struct(
                F.transform("items", lambda x: x.getField("rec")).alias("data"))).alias("body")))


def _typed(r: Column) -> Column:
    """The typed record of one raw one.  Numbers may come as JSON numbers or
    numeric text, NSM as an integral float; the CO2 value under either name
    (the first wins)."""
    out = []
    for f in RECORD_TYPE.fields:
        x = F.coalesce(r[CO2_FIELD], r[CO2_ALIAS]) if f.name == CO2_FIELD else r[f.name]
        if isinstance(f.dataType, T.DoubleType):
            x = X.to_double_or_null(x)
        elif isinstance(f.dataType, T.IntegerType):
            v = X.to_double_or_null(x)
            x = F.when(v == F.floor(v), v.try_cast("int"))
        out.append(x.alias(f.name))
    return F.struct(*out)


def _reasons(t: Column, r: Column) -> Column:
    """Failed checks of a typed record ``t`` and its raw form ``r``."""
    checks = []
    for f in REQUEST_REQUIRED:
        raw = F.coalesce(r[CO2_FIELD], r[CO2_ALIAS]) if f == CO2_FIELD else r[f]
        checks.append(F.when(raw.isNull(), F.lit(f"{f}:missing")).when(t[f].isNull(), F.lit(f"{f}:invalid_type")))
    for rule in REQUEST_RANGES:
        checks.append(F.when(~t[rule.field].between(rule.lo, rule.hi), F.lit(f"{rule.field}:out_of_range")))
    for f, allowed in REQUEST_ENUMS.items():
        checks.append(F.when(~t[f].isin(*allowed), F.lit(f"{f}:invalid")))
    checks.append(F.when(r["date"].isNotNull() & X.to_timestamp_or_null(r["date"], *DATE_FORMATS).isNull(),
                         F.lit("date:unparsable")))
    return F.array_compact(F.array(*checks))


def parse_requests(requests: DataFrame, body: str = "body") -> DataFrame:
    """A8 + M2 in one row per request: (request_id, n_records, records, reasons,
    accepted).  The body is decoded once and its records are checked inside
    the array, without a shuffle; a body whose size is out of bounds is turned
    down before its records are looked at (``records`` stays as decoded)."""
    parsed = requests.select("request_id", F.from_json(F.col(body), REQUEST_TYPE).getField("data").alias("raw"))
    typed = parsed.select("request_id", "raw", F.transform("raw", _typed).alias("records"),
                          F.greatest(F.coalesce(F.size("raw"), F.lit(0)), F.lit(0)).alias("n_records"))
    reasons = F.when(F.col("n_records").between(MIN_RECORDS, MAX_RECORDS), F.array_sort(F.array_distinct(F.flatten(
        F.zip_with("records", "raw", _reasons))))).otherwise(F.array(F.lit("data:size")))
    return (typed.select("request_id", "n_records", "records", reasons.alias("reasons"))
            .withColumn("accepted", (F.size("reasons") == 0).cast("int")))


def exploded(parsed: DataFrame) -> DataFrame:
    """(request_id, n_records, pos, record fields...): one row per record; a
    request with no parsable records keeps one row with ``pos`` NULL."""
    rows = parsed.select("request_id", "n_records", F.posexplode_outer("records").alias("pos", "r"))
    return rows.select("request_id", "n_records", "pos",
                       *[F.col("r").getField(f).alias(f) for f in API_FIELDS])


def decode_requests(requests: DataFrame, body: str = "body") -> DataFrame:
    """Request bodies -> one row per record."""
    return exploded(parse_requests(requests, body))


def validate_requests(requests: DataFrame, body: str = "body") -> DataFrame:
    """M2 per request: one bad record rejects the whole request."""
    return parse_requests(requests, body).select("request_id", "n_records", "reasons", "accepted")


def to_internal(rec: DataFrame, upper_case: bool = True) -> DataFrame:
    """M3: API names -> internal names; categoricals upper-cased (the trained
    encoders expect upper case; ``upper_case=False`` keeps API spelling)."""
    d = rename_map(rec, {v: k for k, v in S.API_NAMES.items()})
    d = d.withColumn(S.DATE, X.to_timestamp_or_null(S.DATE, *DATE_FORMATS))
    if upper_case:
        d = d.withColumns({c: F.upper(F.col(c)) for c in S.CATEGORICAL})
    return d


def request_features(rec: DataFrame, upper_case: bool = True) -> DataFrame:
    """M4: inference features for decoded records."""
    d = to_internal(rec, upper_case)
    d = d.withColumn(S.NSM, F.col(S.NSM).cast("bigint"))
    return engineer_inference(d)


def pack_responses(pred: DataFrame, model_version: str = MODEL_VERSION) -> DataFrame:
    """One JSON response per request, predictions in record order."""
    g = (pred.groupBy("request_id")
         .agg(F.sort_array(F.collect_list(F.struct("pos", "prediction"))).alias("items")))
    resp = F.struct(F.transform("items", lambda x: x.getField("prediction")).alias("predictions"),
                    F.lit(model_version).alias("model_version"),
                    F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
                    .alias("prediction_timestamp"),
                    F.size("items").alias("n_predictions"))
    return g.select("request_id", F.to_json(resp).alias("response"))


RESPONSE_TYPE = T.StructType([
    T.StructField("predictions", T.ArrayType(T.DoubleType())),
    T.StructField("model_version", T.StringType()),
    T.StructField("prediction_timestamp", T.StringType()),
    T.StructField("n_predictions", T.IntegerType())])


def unpack_responses(resp: DataFrame) -> DataFrame:
    r = resp.select("request_id", F.from_json("response", RESPONSE_TYPE).alias("r"))
    return r.select("request_id", F.col("r.n_predictions").alias("n_predictions"),
                    F.aggregate("r.predictions", F.lit(0.0), lambda a, x: a + x).alias("pred_sum"),
                    F.col("r.model_version").alias("model_version"))


def score_parsed(parsed: DataFrame, model, preprocessor=None, upper_case: bool = True) -> DataFrame:
    """Responses of the accepted requests of ``parse_requests``."""
    # Not a filter on ``accepted``: pushed below the projections it would
    # decode and check every body a second time.
    taken = parsed.withColumn("records", F.when(F.col("accepted") == 1, F.col("records")))
    ok = exploded(taken).where(F.col("pos").isNotNull())
    feats = request_features(ok, upper_case)
    if preprocessor is not None:
        feats = preprocessor.transform(feats, keep=("request_id", "pos"))
    return pack_responses(predict(model, feats).select("request_id", "pos", "prediction"))


def score_requests(requests: DataFrame, model, preprocessor=None, upper_case: bool = True
                   ) -> tuple[DataFrame, DataFrame]:
    """M5: decode -> validate -> rename -> features -> [preprocess] -> predict -> pack.

    ``model`` is a RuleModel or a fitted MLlib model reading a ``features``
    vector.  Returns (responses of accepted requests, verdicts of all)."""
    parsed = parse_requests(requests)
    return (score_parsed(parsed, model, preprocessor, upper_case),
            parsed.select("request_id", "n_records", "reasons", "accepted"))


def predict(model, df: DataFrame) -> DataFrame:
    """M1: apply a RuleModel or an MLlib model (assembling ``features`` if needed)."""
    if isinstance(model, RuleModel):
        return model.transform(df)
    from meterlake.operators.models import predict_ml
    return predict_ml(model, df)
