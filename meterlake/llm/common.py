"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.session import scratch_path

# ASCII white space; everything else belongs to a word.  Equals the set that
# ``bytes.split()`` splits on.
WORD_RE = r"[^\x20\x09-\x0D]+"
SPACES = b" \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(df: DataFrame, name: str) -> Column:
    """A top-level column by exact name, whatever characters it holds."""
    return df[f"`{name}`"]


def whole_row(df: DataFrame) -> Column:
    """All input columns as one struct, so an operator can carry them along
    under a name of its own and give them back untouched."""
    return F.struct(*[col(df, c).alias(c) for c in df.columns])


def give_back(df: DataFrame, packed: str, columns: list[str]) -> DataFrame:
    """The inverse of ``whole_row``: only the original columns."""
    return df.select(*[F.col(packed).getField(c).alias(c) for c in columns])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.  Cuts lineage
    (a lost executor recomputes nothing upstream) and gives the planner the
    table's real size, so a join broadcasts it only below the session's
    broadcast threshold."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
