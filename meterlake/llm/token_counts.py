"""Token counts of whole texts, and the change batches of a corpus (operator
5).

Defined results: null and empty texts count zero tokens; rows with equal ids or
equal rows are counted each; of rows with an equal text the one of smallest
doc_id (null last, then source and language) keeps it and the others are listed
as deleted; null source and language are groups of their own; a very long text
is counted as one cell; an empty table gives no group; columns beyond doc_id,
text, source and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import col, stored
from meterlake.llm.encode import default_tokenizer, encoder, slices
from meterlake.llm.rollup import Rollup, no_state, state
from meterlake.session import scratch_path

VERSION = "word_bpe_49k"
CHARS_PER_TOKEN = 4


def counted(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, source, lang, n_chars, tokens, digest per document; texts stay
    in their task."""
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("lang", pa.string()),
                        ("n_chars", pa.int64()), ("digest", pa.string()), ("tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for a, b, texts in slices(batch.column(5)):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(5)] + [pa.array(enc.lengths(texts))], schema=schema)

    text = F.coalesce(col(docs, "text"), F.lit(""))
    return docs.select(
        col(docs, "doc_id").cast("long").alias("doc_id"), col(docs, "source").cast("string").alias("source"),
        col(docs, "lang").cast("string").alias("lang"), F.length(text).cast("long").alias("n_chars"),
        F.md5(text).alias("digest"), text.cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, source string, lang string, n_chars long, digest string, tokens long")


def maintained(docs: DataFrame, path: str | None = None, tokenizer: str | None = None,
               version: str = VERSION) -> Rollup:
    """A rollup of ``docs`` brought up by three batches, as an ingest would:

    insert   every document on arrival, with an estimate from its length, under
             the tokenizer version 'estimate';
    revise   every document's estimate replaced by its counted tokens, moving
             it to ``version``;
    delete   later copies of an equal text taken out again.  The totals list
             them (``deleted``) at the group that keeps the text, by their own
             source and language; both together count all documents.

    Each batch is committed twice, as a retry would, and counts once."""
    spark = docs.sparkSession
    rows = stored(counted(docs, tokenizer or default_tokenizer()), "token-counts")
    estimate = F.ceil(F.col("n_chars") / CHARS_PER_TOKEN)
    guessed = state(F.col("source"), F.col("lang"), F.lit("estimate"), estimate)
    exact = state(F.col("source"), F.col("lang"), F.lit(version), F.col("tokens"))
    # Copies are summed per (text, source, lang) before they meet, so a text
    # that a third of all documents share is a few rows, not one hot group.
    order = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id"), "source", "lang")
    same = stored(rows.groupBy("digest", "source", "lang", "tokens").agg(
        F.count("*").alias("n"), F.min(order).alias("o")), "equal-texts")
    least = same.groupBy("digest").agg(F.min("o").alias("kept"))
    later = same.join(least, "digest").withColumn(
        "n", F.col("n") - F.when(F.col("o").eqNullSafe(F.col("kept")), 1).otherwise(0)).where("n > 0")
    rollup = Rollup(spark, path or scratch_path(spark, "token-rollup"))
    batches = [
        ("0001-insert", rows.select(no_state().alias("old"), guessed.alias("new"))),
        ("0002-revise", rows.select(guessed.alias("old"), exact.alias("new"))),
        ("0003-delete", later.select(exact.alias("old"), no_state().alias("new"), "n",
                                      F.struct("kept.source", "kept.lang").alias("kept"))),
    ]
    for batch_id, changes in batches + batches:
        rollup.commit(batch_id, changes)
    return rollup
