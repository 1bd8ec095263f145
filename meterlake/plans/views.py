"""Spark-side meter views over the driver's tables (FIXTURES.md §2).

``meter_clean`` and ``meter_features`` are stage outputs: like the
reference's processed files they are written once per session as parquet in
the shared checkpoint folder and scanned by downstream queries (column
pruning, predicate pushdown, and a lineage cut that survives executor loss).
The ``build_*`` functions return the lazy plans themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.operators import clean as C
from meterlake.session import scratch_path, source_stamp
from meterlake.sources.tables import meter_raw, table  # noqa: F401

_STAGES: dict[tuple, DataFrame] = {}


def source_key(spark: SparkSession, sf: str, name: str) -> tuple:
    """What a stage of the meter view depends on: the session, and the files
    of the one table that the view reads."""
    return (spark.sparkContext.applicationId, name, sf,
            source_stamp(spark, f"{sf.rstrip('/')}/events.parquet"))


def materialize(spark: SparkSession, build, name: str, sf: str) -> DataFrame:
    """Write ``build()`` once per (session, stage, state of the source files) and
    return the scan of it; ``build`` is a DataFrame or a callable, called only on
    a miss (so a hit plans nothing and runs no statistics job).  A rewritten
    source makes a new stage."""
    key = source_key(spark, sf, name)
    if key not in _STAGES:
        df = build() if callable(build) else build
        path = scratch_path(spark, name)
        df.write.mode("overwrite").parquet(path)
        _STAGES[key] = spark.read.parquet(path)
    return _STAGES[key]


def meter_typed(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_types(meter_raw(spark, sf))


def meter_norm(spark: SparkSession, sf: str) -> DataFrame:
    """Typed + normalised categoricals: the text parsing happens once, written
    as a stage table; modes, medians and the final projection scan it."""
    return materialize(spark, lambda: C.normalized_categoricals(meter_typed(spark, sf)), "meter_norm", sf)


def meter_cat(spark: SparkSession, sf: str) -> DataFrame:
    return C.fill_modes(meter_norm(spark, sf))


def meter_filled(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_nulls(meter_cat(spark, sf))


def build_meter_clean(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_final(C.clean_rules(meter_filled(spark, sf)))


def meter_clean(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(spark, lambda: build_meter_clean(spark, sf), "meter_clean", sf)


def build_meter_features(spark: SparkSession, sf: str) -> DataFrame:
    from meterlake.operators.features import engineer
    return engineer(meter_clean(spark, sf))


def meter_features(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(spark, lambda: build_meter_features(spark, sf), "meter_features", sf)


_FITTED: dict[tuple, object] = {}


def fitted_preprocessor(spark: SparkSession, sf: str):
    """The 4-group transformer fitted on ``meter_features``, once per session
    (its parameter table is the stage artifact, like the stage tables)."""
    from meterlake.operators.prep import fit
    key = source_key(spark, sf, "preprocessor")
    if key not in _FITTED:
        _FITTED[key] = fit(meter_features(spark, sf))
    return _FITTED[key]
