"""Sources and sinks A1-A7.

Raw files are read with a declared all-STRING schema (never ``inferSchema``)
and renamed from the file's column names to internal names at the edge.
Writes go to parquet by default; CSV keeps whitespace and distinguishes
NULL from the empty string.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import schema as S

NULL_MARK = "\\N"
CSV_OPTS = {"header": "true", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false", "nullValue": NULL_MARK}


def rename_map(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by map; names absent from ``df`` are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def to_file_names(df: DataFrame, names: dict[str, str] = S.CSV_NAMES) -> DataFrame:
    return rename_map(df, names)


def to_internal_names(df: DataFrame, names: dict[str, str] = S.CSV_NAMES) -> DataFrame:
    return rename_map(df, {v: k for k, v in names.items()})


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_OPTS).csv(path)


def csv_by_name(spark: SparkSession, path: str) -> DataFrame:
    """All columns of a CSV as STRING, bound by the names in its header.

    The header is read from one line (Spark's CSV source binds an explicit
    schema by position, so the schema is built in the file's own order);
    ``enforceSchema=false`` makes files of a folder whose header differs an
    error instead of silently shifted columns."""
    one = spark.read.options(**CSV_OPTS).option("inferSchema", "false").csv(path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in one.columns])
    return spark.read.schema(schema).options(**CSV_OPTS).option("enforceSchema", "false").csv(path)


def scan_csv_raw(spark: SparkSession, path: str, extra_cols: Sequence[str] = (S.ROW_ID,)) -> DataFrame:
    """A1: raw meter CSV, every column STRING, renamed to internal names.

    Columns are found by header name in any order; ones the meter table does
    not know (``mixed_type_col``) are left out, meter columns the file lacks
    are NULL, and ``extra_cols`` (ids) are taken where present.  A missing path
    raises ``AnalysisException`` (PATH_NOT_FOUND)."""
    raw = to_internal_names(csv_by_name(spark, path))
    ids = [F.col(c).try_cast("bigint").alias(c) for c in extra_cols if c in raw.columns]
    return raw.select(*ids, *[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c)
                              for c in S.METER_COLUMNS])


def scan_clean(spark: SparkSession, path: str, fmt: str = "parquet",
               ts_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """A3: cleaned table with its declared schema (CSV: explicit timestamp format)."""
    if fmt == "parquet":
        return spark.read.schema(S.CLEAN_SCHEMA).parquet(path)
    raw = csv_by_name(spark, path)
    typed = {"timestamp_ntz": lambda c: F.try_to_timestamp(F.col(c), F.lit(ts_format)).cast("timestamp_ntz")}
    return raw.select(*[
        (typed.get(f.dataType.simpleString(), lambda c, t=f.dataType: F.col(c).try_cast(t))(f.name)
         if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in S.CLEAN_SCHEMA.fields])


def sink_clean(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """A4: write the cleaned table."""
    if fmt == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        (df.write.mode(mode).options(**CSV_OPTS)
         .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def sink_features(features: DataFrame, names: Sequence[str], path: str, label: str = "label") -> DataFrame:
    """A5: one table (row_id, features..., label) + column-group metadata
    ``(feature, group, original, position)`` returned as a DataFrame: the
    processed name, its group and the column it was made from."""
    features.write.mode("overwrite").parquet(path)
    spark = features.sparkSession
    meta = []
    for i, n in enumerate(names):
        group, _, rest = n.partition("__")
        original = next((c for c in S.CAT_NOM if rest.startswith(c + "_")), rest) if group == "cat_nom" else rest
        meta.append((n, group, original, i))
    return spark.createDataFrame(meta, "feature string, group string, original string, position int")


def load_features(spark: SparkSession, path: str, label: str = "label") -> tuple[DataFrame, DataFrame]:
    """A2: (X, y) views of the stored feature table, both keyed by row_id."""
    t = spark.read.parquet(path)
    return t.drop(label), t.select(S.ROW_ID, label)


def sink_predictions(pred: DataFrame, path: str, prediction: str = "prediction") -> None:
    """Append (row_id, prediction, predicted_at)."""
    (pred.select(S.ROW_ID, F.col(prediction).alias("prediction"),
                 F.localtimestamp().alias("predicted_at"))
     .write.mode("append").parquet(path))
