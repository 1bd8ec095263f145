"""Query registry: key -> (spark callable(spark, sf_dir) -> DataFrame, oracle SQL or None).

Every Spark result goes through ``finish``: DOUBLE columns normalised by
``normalize_double`` (the oracle rounds the same columns the same way, so
last-bit differences from summation order do not change the value), INT
widened to BIGINT, so both engines produce the same names, types and values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def _half_up(x, digits: int):
    """floor(x * 10^d + 0.5) / 10^d — plain IEEE steps, evaluated identically
    by Spark and the oracle engine (``round`` is not: decimal vs binary)."""
    k = float(10 ** digits)
    return F.floor(x * F.lit(k) + F.lit(0.5)).cast("double") / F.lit(k)


def normalize_double(x, digits: int = 6):
    """Below 1e6: to 9 then ``digits`` decimals (the first step absorbs
    last-bit differences from summation order); from 1e6 up: 12 significant
    digits.  NaN and +-inf pass through; -0.0 becomes 0.0."""
    e = F.floor(F.log10(F.abs(x))).cast("double")
    small = _half_up(_half_up(x, 9), digits)
    large = _half_up(x / F.pow(F.lit(10.0), e), 11) * F.pow(F.lit(10.0), e)
    return (F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), x)
            .when(F.abs(x) < F.lit(1e6), small).otherwise(large))


def finish(df: DataFrame, digits: int = 6, digits_by: dict | None = None) -> DataFrame:
    digits_by = digits_by or {}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            out.append(normalize_double(c.cast("double"), digits_by.get(f.name, digits)).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out.append(c.cast("bigint").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def register(key: str, sql: str | None = None, digits: int = 6, digits_by: dict | None = None):
    def deco(fn):
        def run(spark, sf_dir):
            return finish(fn(spark, sf_dir), digits, digits_by)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    from meterlake.plans import (clean_queries, eval_queries, feature_queries,  # noqa: F401
                                 model_queries, profile_queries, score_queries)
