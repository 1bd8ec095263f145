"""Delta-maintained token counts (operator 5).

Totals by (source, lang, tokenizer) are kept as additive deltas.  A batch of
changes becomes signed rows, which are summed per group and committed once
under the batch's id:

    insert   + new          delete   - old          revise   - old + new

A deletion can name the group that keeps the text (``kept``); its deltas stay
apart, so the totals can list what was deleted as copies of a group's texts.

A batch folder counts as committed when its success marker is there.
Committing an id again is a no-op, and a batch that failed midway has no
marker and is written anew, so retries and replays never count twice.  Totals
are the sum over committed batches.

Defined results: null source, lang or tokenizer is a group of its own; null
counts are 0; equal change rows each count; an empty batch commits no rows;
groups whose documents and tokens are back to 0 are left out of the totals
(with ``deleted``, if no deletions are listed there either);
texts are not seen here, however long; columns that are not named are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = ["source", "lang", "tokenizer"]
KEPT = "struct<source:string,lang:string>"
SCHEMA = f"source string, lang string, tokenizer string, kept {KEPT}, d_docs long, d_tokens long"
STATE = "struct<source:string,lang:string,tokenizer:string,tokens:bigint>"


def state(source, lang, tokenizer, tokens):
    return F.struct(source.alias("source"), lang.alias("lang"), tokenizer.alias("tokenizer"),
                    F.coalesce(tokens.cast("long"), F.lit(0)).alias("tokens"))


def no_state():
    return F.lit(None).cast(STATE)


def signed(changes: DataFrame) -> DataFrame:
    """Summed deltas of changes (old, new: state or null; optionally n: how
    many equal changes the row stands for, and kept).  One row per group and
    task reaches the shuffle, however hot a group is."""
    times = F.col("n").cast("long") if "n" in changes.columns else F.lit(1).cast("long")
    kept = (F.col("kept") if "kept" in changes.columns else F.lit(None)).cast(KEPT)
    sides = F.filter(F.array(
        F.struct(F.col("new").alias("s"), F.lit(1).alias("sign")),
            F.struct(F.col("old").alias("s"), F.lit(-1).alias("sign"))), lambda x: x["s"].isNotNull())
    rows = (changes.select(times.alias("n"), kept.alias("kept"), F.explode(sides).alias("x"))
            .select("x.s.*", "kept", (F.col("x.sign") * F.col("n")).alias("times")))
    return rows.groupBy(*GROUP, "kept").agg(F.sum("times").alias("d_docs"),
                                            F.sum(F.col("times") * F.col("tokens")).alias("d_tokens"))


class Rollup:
    """A rollup in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _folder(self, batch_id: str) -> str:
        return f"{self.path}/batch={batch_id}"

    def committed(self, batch_id: str) -> bool:
        return self._fs.exists(self._path(f"{self._folder(batch_id)}/_SUCCESS"))

    def batches(self) -> list[str]:
        if not self._fs.exists(self._path(self.path)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.path))]
        found = sorted(n.removeprefix("batch=") for n in names if n.startswith("batch="))
        return [b for b in found if self.committed(b)]

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """True if this call applied the batch, False if it was there."""
        if self.committed(batch_id):
            return False
        signed(changes).write.mode("overwrite").parquet(self._folder(batch_id))
        return True

    def deltas(self) -> DataFrame:
        paths = [self._folder(b) for b in self.batches()]
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*paths)

    def totals(self, deleted: bool = False) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens; with ``deleted`` also the
        deleted copies of the group's texts, by their own source and lang."""
        deltas = self.deltas()
        sums = [F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens")]
        some = (F.col("n_docs") != 0) | (F.col("n_tokens") != 0)
        if not deleted:
            return deltas.groupBy(*GROUP).agg(*sums).where(some)
        copies = F.struct("source", "lang", (-F.col("n_docs")).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))
        gone = (deltas.where(F.col("kept").isNotNull()).groupBy(*GROUP, "kept").agg(*sums).where(some)
                .select("kept.source", "kept.lang", "tokenizer", copies.alias("copies")))
        return (deltas.unionByName(gone, allowMissingColumns=True).groupBy(*GROUP)
                .agg(*[F.coalesce(x, F.lit(0)).alias(k) for x, k in zip(sums, ("n_docs", "n_tokens"))],
                     F.sort_array(F.collect_list("copies")).alias("deleted"))
                .where(some | (F.size("deleted") > 0)))
