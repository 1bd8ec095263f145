"""Feature derivation J1-J9: calendar, cyclic, power-factor, reactive-power
and intensity columns, all as one projection.  The only statistic (global
median of the target for the high-consumption flag) is a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake import schema as S
from meterlake.functions import expr as X
from meterlake.operators.quantile import quantiles

INFERENCE_DIVISOR = 75.0


def calendar(ts: str = S.DATE) -> dict[str, Column]:
    """Year, month, day, hour, Monday-0 weekday, quarter, is_weekend."""
    t = F.col(ts)
    dow = X.weekday_mon0(t)
    return {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t),
            "hour": F.hour(t), "day_of_week_num": dow, "quarter": F.quarter(t),
            "is_weekend": X.flag(dow >= 5)}


def cyclic_features() -> dict[str, Column]:
    """sin/cos of hour (24), month (12), weekday (7)."""
    out = {}
    for name, src, p in (("hour", F.hour(S.DATE), 24), ("month", F.month(S.DATE), 12),
                         ("dow", X.weekday_mon0(S.DATE), 7)):
        s, c = X.cyclic(src, p)
        out[f"{name}_sin"], out[f"{name}_cos"] = s, c
    return out


def power_factor() -> dict[str, Column]:
    """J3."""
    lag, lead = F.col(S.LAG_PF), F.col(S.LEAD_PF)
    return {"power_factor_ratio": X.safe_ratio(lag, lead), "power_factor_diff": lag - lead,
            "avg_power_factor": (lag + lead) / 2}


def reactive() -> dict[str, Column]:
    """J4."""
    lag, lead = F.col(S.LAG_REACTIVE), F.col(S.LEAD_REACTIVE)
    return {"reactive_power_total": lag + lead, "reactive_power_diff": lag - lead,
            "reactive_power_ratio": X.safe_ratio(lag, lead)}


def global_median(df: DataFrame, c: str) -> Column:
    """The exact global median as a scalar subquery (computed once, no join)."""
    return quantiles(df, [c], [0.5]).select("q").scalar()


def intensity(df: DataFrame) -> dict[str, Column]:
    """J5 + J6: ratios to the target and the strict > global-median flag."""
    u = F.col(S.TARGET)
    return {"co2_per_kwh": X.safe_ratio(S.CO2, u),
            S.HIGH_FLAG: X.flag(u > global_median(df, S.TARGET)),
            "nsm_per_kwh": X.safe_ratio(S.NSM, u)}


def inference_intensity(divisor: float = INFERENCE_DIVISOR) -> dict[str, Column]:
    """Target-free stand-ins (constant divisor, flag 0)."""
    d = F.lit(float(divisor))
    return {"co2_per_kwh": F.col(S.CO2) / d, S.HIGH_FLAG: F.lit(0),
            "nsm_per_kwh": F.col(S.NSM) / d}


def _groups(df: DataFrame, inference: bool, divisor: float) -> list[tuple[list[str], dict]]:
    have = set(df.columns)
    groups = []
    if S.DATE in have:
        groups += [([S.DATE], calendar()), ([S.DATE], cyclic_features())]
    groups.append(([S.LAG_PF, S.LEAD_PF], power_factor()))
    groups.append(([S.LAG_REACTIVE, S.LEAD_REACTIVE], reactive()))
    if inference:
        groups.append(([S.CO2, S.NSM], inference_intensity(divisor)))
    else:
        groups.append(([S.CO2, S.NSM, S.TARGET], intensity(df)))
    return groups


TARGET_DERIVED = ["co2_per_kwh", S.HIGH_FLAG, "nsm_per_kwh"]


def engineer(df: DataFrame, *, partial: bool = False, exclude_target_features: bool = False) -> DataFrame:
    """J8 (and J9 with ``partial=True``: a group whose inputs are absent is skipped).

    ``exclude_target_features`` leaves out the three columns computed from the
    target itself (they leak the label into the features)."""
    new = {}
    for needs, cols in _groups(df, False, INFERENCE_DIVISOR):
        if all(n in df.columns for n in needs):
            new.update(cols)
        elif not partial:
            raise ValueError(f"missing input columns {needs}")
    if not partial:
        new = {k: new[k] for k in S.ENGINEERED}
    if exclude_target_features:
        new = {k: v for k, v in new.items() if k not in TARGET_DERIVED}
    return df.withColumns(new)


def engineer_inference(df: DataFrame, divisor: float = INFERENCE_DIVISOR) -> DataFrame:
    """Inference form; drops ``date`` and ``day_of_week``."""
    new = {}
    for _needs, cols in _groups(df, True, divisor):
        new.update(cols)
    new = {k: new[k] for k in S.ENGINEERED if k in new}
    return df.withColumns(new).drop(S.DATE, S.DAY_OF_WEEK)
