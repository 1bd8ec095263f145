"""Quality and validation rules kept as data and compiled to Columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake import schema as S


@dataclass(frozen=True)
class QualityRule:
    column: str
    scale_if_gt: float
    divisor: float
    cap: float


# The cleaning rules (scale when above, divide by, cap at), in
# the order the reference applies them.
QUALITY_RULES = [
    QualityRule(S.LEAD_PF, 100, 100, 100),
    QualityRule(S.LAG_PF, 100, 100, 100),
    QualityRule(S.CO2, 0.2, 100000, 0.02),
    QualityRule(S.LAG_REACTIVE, 100, 100, 96.91),
    QualityRule(S.LEAD_REACTIVE, 27.76, 1000, 27.76),
    QualityRule(S.NSM, 85500, 100, 85500),
    QualityRule(S.TARGET, 157.18, 1000, 157.18),
]


def apply_rule(rule: QualityRule, c: Column | None = None) -> Column:
    """Scale values above the threshold, then cap what is still too large."""
    c = F.col(rule.column) if c is None else c
    scaled = F.when(c > F.lit(rule.scale_if_gt), c / F.lit(float(rule.divisor))).otherwise(c)
    return F.when(scaled > F.lit(rule.cap), F.lit(float(rule.cap))).otherwise(scaled)


@dataclass(frozen=True)
class RangeRule:
    field: str
    lo: float
    hi: float


# Accepted ranges of the scoring request fields (inclusive).
REQUEST_RANGES = [
    RangeRule(S.API_NAMES[S.LAG_REACTIVE], 0, 100),
    RangeRule(S.API_NAMES[S.LEAD_REACTIVE], 0, 30),
    RangeRule(S.API_NAMES[S.CO2], 0, 0.02),
    RangeRule(S.API_NAMES[S.LAG_PF], 0, 1),
    RangeRule(S.API_NAMES[S.LEAD_PF], 0, 1),
    RangeRule(S.API_NAMES[S.NSM], 0, 90000),
]
# Accepted categorical values of the scoring request.
REQUEST_ENUMS = {
    "WeekStatus": ["Weekday", "Weekend"],
    "Load_Type": ["Light_Load", "Medium_Load", "Maximum_Load"],
}
REQUEST_REQUIRED = ["date", *[r.field for r in REQUEST_RANGES], "WeekStatus",
                    "Day_of_week", "Load_Type"]
MIN_RECORDS, MAX_RECORDS = 1, 1000
