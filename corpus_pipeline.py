"""The corpus pipeline: quality rules, near-duplicates, personal data, source
mix, packing.  Each stage takes the previous one's documents, written as
Parquet and read again.

Defined results: every row is a document, whatever it holds; null and blank texts
fail the quality rules and go; repeated rows and near copies leave one document;
ties are broken as the stages' modules say; very long texts pass whole; an empty
table gives no pieces; extra columns, also of clashing names, ride along to the
packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.llm import mixing, packing, pii, quality, simhash
from meterlake.llm.common import read, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their own rules and whose host passes."""
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data masked, disclosing terms generalised or removed."""
    return pii.sanitised(docs, everywhere=True)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their ids and places in the sequences."""
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("personal data", pii_stage),
    ("source mix", mixing_stage),
    ("packing", packing_stage),
]

# Fingerprints, tokenisation and packing have no SQL form; tests compare the
# stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
