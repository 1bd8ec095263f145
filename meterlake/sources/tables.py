"""The driver's parquet tables and the meter views derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


SPREAD_BYTES = 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a small source that has fewer splits than the session's
    default parallelism (a single-row-group file would otherwise run every
    per-row expression in one task).  A source of more than ``SPREAD_BYTES``
    is never shuffled for this, whatever the cluster's size."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    target = df.sparkSession.sparkContext.defaultParallelism
    if size <= SPREAD_BYTES and df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def table(spark: SparkSession, sf_dir: str, name: str, spread_small: bool = False) -> DataFrame:
    """A driver table; ``spread_small`` for plans whose per-row work is heavy
    (text parsing) — cheap aggregations are better off without the shuffle."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_small else df


# Deterministic dirt injected into ``events`` (FIXTURES.md §2).  One text for
# both engines; the five placeholders are rendered per dialect.
METER_RAW_SQL = """
SELECT event_id AS row_id,
 CASE WHEN event_id % 47 = 0 THEN 'bad' ELSE {FMT} END AS date,
 CASE WHEN event_id % 19 = 0 THEN 'abc' WHEN event_id % 29 = 0 THEN NULL ELSE CAST(value AS {STR}) END AS usage_kwh,
 CASE WHEN event_id % 31 = 0 THEN '' ELSE CAST(CAST(k AS DOUBLE) * 1.1 AS {STR}) END AS lagging_reactive_kvarh,
 CAST(CAST((k * 7) % 100 AS DOUBLE) * 0.3 AS {STR}) AS leading_reactive_kvarh,
 CAST(CASE WHEN event_id % 11 = 0 THEN CAST(k AS DOUBLE) / 50
           WHEN event_id % 12 = 0 THEN 0.02 + CAST(k AS DOUBLE) / 1000
           ELSE CAST(k AS DOUBLE) / 5000 END AS {STR}) AS co2_tco2,
 CAST(CASE WHEN event_id % 13 = 0 THEN 150.0 + k ELSE 50.0 + k / CAST(2 AS DOUBLE) END AS {STR}) AS lagging_power_factor,
 CASE WHEN event_id % 37 = 0 THEN 'NaN' ELSE CAST(100.0 - k / CAST(4 AS DOUBLE) AS {STR}) END AS leading_power_factor,
 CAST((hour(ts)*3600 + minute(ts)*60 + CAST(floor(second(ts)) AS INT))
      * CASE WHEN event_id % 17 = 0 THEN 10 ELSE 1 END AS {STR}) AS nsm,
 CASE WHEN event_id % 23 = 0 THEN ' nan ' WHEN event_id % 41 = 0 THEN NULL
      WHEN {DOW} >= 6 THEN 'Weekend' ELSE ' Weekday ' END AS week_status,
 {DAY} AS day_of_week,
 CASE WHEN event_id % 43 = 0 THEN 'null' WHEN event_type IN ('click','view') THEN 'Light_Load'
      WHEN event_type = 'signup' THEN 'medium_load' ELSE 'Maximum_Load ' END AS load_type
FROM (SELECT *, CAST({JSON} AS INT) AS k FROM {EVENTS}) e
"""

DIALECTS = {
    "spark": dict(STR="STRING", DOW="EXTRACT(DAYOFWEEK_ISO FROM ts)",
                  DAY="date_format(ts,'EEEE')",
                  FMT="date_format(ts,'yyyy-MM-dd HH:mm:ss')",
                  JSON="get_json_object(props,'$.k')", EVENTS="{events}"),
    "duckdb": dict(STR="VARCHAR", DOW="isodow(ts)", DAY="dayname(ts)",
                   FMT="strftime(ts,'%Y-%m-%d %H:%M:%S')",
                   JSON="json_extract_string(props,'$.k')", EVENTS="events"),
}


def meter_raw_sql(dialect: str) -> str:
    return METER_RAW_SQL.format(**DIALECTS[dialect])


def meter_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-STRING meter table with the fixture dirt (row_id = event_id)."""
    events = spread(table(spark, sf_dir, "events", spread_small=False)
                    .select("event_id", "ts", "event_type", "value", "props"))
    return spark.sql(meter_raw_sql("spark"), events=events)
