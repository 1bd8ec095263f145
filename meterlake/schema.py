"""Column names and schemas of the meter-reading table.

Internal names are snake_case; the dotted/parenthesised CSV names exist only
at the file and JSON edges (see ``CSV_NAMES``).
"""

from __future__ import annotations

from pyspark.sql import types as T

DATE = "date"
TARGET = "usage_kwh"
LAG_REACTIVE = "lagging_reactive_kvarh"
LEAD_REACTIVE = "leading_reactive_kvarh"
CO2 = "co2_tco2"
LAG_PF = "lagging_power_factor"
LEAD_PF = "leading_power_factor"
NSM = "nsm"
WEEK_STATUS = "week_status"
DAY_OF_WEEK = "day_of_week"
LOAD_TYPE = "load_type"
ROW_ID = "row_id"

NUMERIC = [TARGET, LAG_REACTIVE, LEAD_REACTIVE, CO2, LAG_PF, LEAD_PF, NSM]
CATEGORICAL = [WEEK_STATUS, DAY_OF_WEEK, LOAD_TYPE]
METER_COLUMNS = [DATE, *NUMERIC, *CATEGORICAL]

# The column names of the source CSV files and of the scoring API.
CSV_NAMES = {
    DATE: "date",
    TARGET: "Usage_kWh",
    LAG_REACTIVE: "Lagging_Current_Reactive.Power_kVarh",
    LEAD_REACTIVE: "Leading_Current_Reactive_Power_kVarh",
    CO2: "CO2(tCO2)",
    LAG_PF: "Lagging_Current_Power_Factor",
    LEAD_PF: "Leading_Current_Power_Factor",
    NSM: "NSM",
    WEEK_STATUS: "WeekStatus",
    DAY_OF_WEEK: "Day_of_week",
    LOAD_TYPE: "Load_Type",
}
API_NAMES = dict(CSV_NAMES, **{LAG_REACTIVE: "Lagging_Current_Reactive_Power_kVarh"})

RAW_SCHEMA = T.StructType(
    [T.StructField(ROW_ID, T.LongType())]
    + [T.StructField(c, T.StringType()) for c in METER_COLUMNS])

CLEAN_SCHEMA = T.StructType(
    [T.StructField(ROW_ID, T.LongType()), T.StructField(DATE, T.TimestampNTZType())]
    + [T.StructField(c, T.LongType() if c == NSM else T.DoubleType()) for c in NUMERIC]
    + [T.StructField(c, T.StringType()) for c in CATEGORICAL])

CSV_RAW_SCHEMA = T.StructType([T.StructField(CSV_NAMES[c], T.StringType()) for c in METER_COLUMNS])

CALENDAR = ["year", "month", "day", "hour", "day_of_week_num", "quarter", "is_weekend"]
CYCLIC = ["hour_sin", "hour_cos", "month_sin", "month_cos", "dow_sin", "dow_cos"]
POWER_FACTOR = ["power_factor_ratio", "power_factor_diff", "avg_power_factor"]
REACTIVE = ["reactive_power_total", "reactive_power_diff", "reactive_power_ratio"]
INTENSITY = ["co2_per_kwh", "nsm_per_kwh"]
HIGH_FLAG = "is_high_consumption"
ENGINEERED = CALENDAR + CYCLIC + POWER_FACTOR + REACTIVE + ["co2_per_kwh", HIGH_FLAG, "nsm_per_kwh"]

# The four column groups of the preprocessing transformer, in order.
NUM_SKEW = [LAG_REACTIVE, LEAD_REACTIVE, CO2, "reactive_power_total", NSM,
            "co2_per_kwh", "nsm_per_kwh"]
NUM_LIN = [LAG_PF, LEAD_PF, "hour", "hour_sin", "hour_cos", "dow_sin", "dow_cos",
           "month_sin", "month_cos", "power_factor_ratio", "power_factor_diff",
           "avg_power_factor", "reactive_power_diff", "reactive_power_ratio",
           "year", "month", "day", "quarter", "day_of_week_num", "is_weekend", HIGH_FLAG]
CAT_NOM = [WEEK_STATUS]
CAT_ORD = [LOAD_TYPE]
# Ordinal category order of the load type.
LOAD_ORDER = ["LIGHT_LOAD", "MEDIUM_LOAD", "MAXIMUM_LOAD"]
EXCLUDE_FROM_FEATURES = [DATE, TARGET, DAY_OF_WEEK]
