"""DuckDB SQL building blocks for the correctness oracle.

The meter views are re-derived here from the formulas (never from Spark
output): ``meter_raw`` -> ``meter_typed`` -> ``meter_cat`` -> ``meter_filled``
-> ``meter_clean`` -> ``meter_features``.
"""

from __future__ import annotations

import math

from meterlake import schema as S
from meterlake.functions.rules import QUALITY_RULES
from meterlake.sources.tables import meter_raw_sql


def num(c: str) -> str:
    return f"CASE WHEN isnan(TRY_CAST({c} AS DOUBLE)) THEN NULL ELSE TRY_CAST({c} AS DOUBLE) END"


def norm(c: str) -> str:
    u = f"upper(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'))"
    return f"CASE WHEN {u} IN ('NAN','NA','NONE','NULL','') THEN NULL ELSE {u} END"


def rule(c: str) -> str:
    r = next(x for x in QUALITY_RULES if x.column == c)
    s = f"(CASE WHEN {c} > {r.scale_if_gt} THEN {c} / {float(r.divisor)} ELSE {c} END)"
    return f"CASE WHEN {s} > {r.cap} THEN CAST({r.cap} AS DOUBLE) ELSE {s} END"


def mode_of(c: str, src: str) -> str:
    return (f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} ASC LIMIT 1)")


RAW = f"meter_raw AS ({meter_raw_sql('duckdb')})"

TYPED = ("meter_typed AS (SELECT row_id, try_strptime(date, '%Y-%m-%d %H:%M:%S') AS date, "
         + ", ".join(f"{num(c)} AS {c}" for c in S.NUMERIC) + ", "
         + ", ".join(S.CATEGORICAL) + " FROM meter_raw)")

NORM = ("meter_norm AS (SELECT row_id, date, " + ", ".join(S.NUMERIC) + ", "
        + ", ".join(f"{norm(c)} AS {c}" for c in S.CATEGORICAL) + " FROM meter_typed)")

CAT = ("meter_cat AS (SELECT row_id, date, " + ", ".join(S.NUMERIC) + ", "
       + ", ".join(f"coalesce({c}, {mode_of(c, 'meter_norm')}, 'UNKNOWN') AS {c}"
                   for c in S.CATEGORICAL) + " FROM meter_norm)")

MED = ("meter_med AS (SELECT load_type, quantile_cont(usage_kwh, 0.5) AS med "
       "FROM meter_cat WHERE usage_kwh IS NOT NULL GROUP BY load_type)")

FILLED = ("meter_filled AS (SELECT m.row_id, m.date, coalesce(m.usage_kwh, d.med) AS usage_kwh, "
          + ", ".join(f"coalesce(m.{c}, 0.0) AS {c}" for c in S.NUMERIC if c != S.TARGET) + ", "
          + ", ".join(f"m.{c}" for c in S.CATEGORICAL)
          + " FROM meter_cat m LEFT JOIN meter_med d ON m.load_type = d.load_type)")

RULED = ("meter_ruled AS (SELECT row_id, date, "
         + ", ".join(f"{rule(c)} AS {c}" for c in S.NUMERIC) + ", "
         + ", ".join(S.CATEGORICAL) + " FROM meter_filled)")

CLEAN = ("meter_clean AS (SELECT row_id, date, "
         + ", ".join(f"CAST(trunc({c}) AS BIGINT) AS {c}" if c == S.NSM else c for c in S.NUMERIC)
         + ", " + ", ".join(S.CATEGORICAL) + " FROM meter_ruled)")

TWO_PI = repr(2 * math.pi)


def _cyc(x: str, p: int) -> str:
    return (f"sin({TWO_PI} * {x} / {float(p)})", f"cos({TWO_PI} * {x} / {float(p)})")


def feature_select(src: str, inference: bool = False, divisor: float = 75.0) -> str:
    cal = ("CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month, "
           "CAST(day(date) AS BIGINT) AS day, CAST(hour(date) AS BIGINT) AS hour, "
           "CAST(isodow(date) - 1 AS BIGINT) AS day_of_week_num, "
           "CAST(quarter(date) AS BIGINT) AS quarter, "
           "CAST(coalesce(isodow(date) - 1 >= 5, false) AS BIGINT) AS is_weekend")
    hs, hc = _cyc("hour(date)", 24)
    ms, mc = _cyc("month(date)", 12)
    ds, dc = _cyc("(isodow(date) - 1)", 7)
    cyc = (f"{hs} AS hour_sin, {hc} AS hour_cos, {ms} AS month_sin, {mc} AS month_cos, "
           f"{ds} AS dow_sin, {dc} AS dow_cos")
    pf = ("lagging_power_factor / (leading_power_factor + 1e-6) AS power_factor_ratio, "
          "lagging_power_factor - leading_power_factor AS power_factor_diff, "
          "(lagging_power_factor + leading_power_factor) / 2 AS avg_power_factor")
    rp = ("lagging_reactive_kvarh + leading_reactive_kvarh AS reactive_power_total, "
          "lagging_reactive_kvarh - leading_reactive_kvarh AS reactive_power_diff, "
          "lagging_reactive_kvarh / (leading_reactive_kvarh + 1e-6) AS reactive_power_ratio")
    if inference:
        inten = (f"co2_tco2 / {float(divisor)} AS co2_per_kwh, CAST(0 AS BIGINT) AS is_high_consumption, "
                 f"nsm / {float(divisor)} AS nsm_per_kwh")
    else:
        inten = ("co2_tco2 / (usage_kwh + 1e-6) AS co2_per_kwh, "
                 f"CAST(coalesce(usage_kwh > (SELECT quantile_cont(usage_kwh, 0.5) FROM {src}), false) "
                 "AS BIGINT) AS is_high_consumption, nsm / (usage_kwh + 1e-6) AS nsm_per_kwh")
    return f"SELECT *, {cal}, {cyc}, {pf}, {rp}, {inten} FROM {src}"


FEATURES = f"meter_features AS ({feature_select('meter_clean')})"

CHAIN_TYPED = [RAW, TYPED]
CHAIN_CAT = CHAIN_TYPED + [NORM, CAT]
CHAIN_FILLED = CHAIN_CAT + [MED, FILLED]
CHAIN_CLEAN = CHAIN_FILLED + [RULED, CLEAN]
CHAIN_FEATURES = CHAIN_CLEAN + [FEATURES]


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _half_up(x: str, digits: int) -> str:
    k = repr(float(10 ** digits))
    return f"(floor(({x}) * {k} + 0.5) / {k})"


def normalize_double(x: str, digits: int = 6) -> str:
    e = f"floor(log10(abs({x})))"
    small = _half_up(_half_up(x, 9), digits)
    large = f"({_half_up(f'({x}) / pow(10.0, {e})', 11)} * pow(10.0, {e}))"
    return (f"CASE WHEN isnan({x}) OR isinf({x}) THEN {x} WHEN abs({x}) < 1e6 THEN {small} "
            f"ELSE {large} END")


def rounded(sql: str, doubles: list[str], digits: int = 6, bigints: list[str] = ()) -> str:
    """Wrap ``sql`` so listed columns are rounded DOUBLE / cast BIGINT."""
    rep = [f"{normalize_double(f'CAST({c} AS DOUBLE)', digits)} AS {c}" for c in doubles]
    rep += [f"CAST({c} AS BIGINT) AS {c}" for c in bigints]
    if not rep:
        return sql
    return f"SELECT * REPLACE ({', '.join(rep)}) FROM ({sql}) _q"
