"""Mixing sources to target weights (operator 3).

Words are summed per source, targets follow from the weights (excess over
``max_repeats`` times a source's own size is shared again by weight), a
source's repetition rate is target / size, and each document is taken
floor(rate) times plus one Bernoulli copy with probability equal to the
fraction, drawn from a hash of (doc_id, seed).

Defined results: null text has size 0; null source is a source of its own,
last in order; a source of size 0 has rate 0; repeated rows share one draw
(same doc_id); a null doc_id draws as the text 'null'; a very long text is
counted whole, as one cell; an empty table gives an empty mix.  Only the named
columns are read, so extra ones are harmless.  Sources are ordered and shared
out in one task, a row each: a bound of some millions of sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import WORD_RE, col, give_back, stored, whole_row

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def unit_draw(key: Column, seed: str = SEED) -> Column:
    """Uniform in [0, 1) from 52 hash bits: the same in every run."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":" + seed))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, weight, target, rate) from per-document (source,
    size).  Weights repeat over the sources in code-point order, nulls last.

    Sharing the excess again until no target is above its limit ends at
    target = min(limit, level * weight).  With sources sorted by limit/weight,
    the first source whose share of what is left fits its limit sets the
    level; integers are compared by cross-multiplying, so this is exact.  The
    windows run over one row per source, not over documents."""
    per = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-size")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          (rank % len(weights) + 1).cast("int")).cast("long")
    ranked = per.select("source", "source_size", weight.alias("weight"))
    limit = F.col("source_size") * max_repeats
    order = [limit / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    steps = ranked.select("*", limit.alias("limit"), left.alias("left"),
                          F.sum("weight").over(onward).alias("left_weight"))
    fits = F.col("left") * F.col("weight") <= F.col("limit") * F.col("left_weight")
    first = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = steps.select(
        "source", "source_size", "weight", "limit",
        F.first(F.when(fits, F.col("left")), ignorenulls=True).over(first).alias("lv"),
        F.first(F.when(fits, F.col("left_weight")), ignorenulls=True).over(first).alias("lw"))
    share = F.col("lv").cast("double") * F.col("weight") / F.col("lw").cast("double")
    target = F.least(F.col("limit").cast("double"), share)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return level.select("source", "source_size", "weight", target.alias("target"),
                        rate.alias("rate"))


def copies(rate: Column, key: Column, seed: str = SEED) -> Column:
    whole = F.floor(rate)
    return (whole + (unit_draw(key, seed) < rate - whole).cast("long")).cast("long")


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED,
             keep_rows: bool = False) -> DataFrame:
    """Per document: doc (struct), size, source_size, target, rate, copies.

    Without ``keep_rows`` the per-document sizes are stored once and read
    twice; with it the texts are scanned again instead of being copied.  The
    table of targets has one row per source; being stored, it is broadcast
    only below the session's size threshold, otherwise joined by shuffle with
    skew splitting."""
    row = whole_row(docs) if keep_rows else F.struct(
        *[col(docs, c).alias(c) for c in docs.columns if c != "text"])
    sized = docs.select(row.alias("doc"), col(docs, "doc_id").alias("key"),
                        col(docs, "source").alias("source"),
                        n_words(col(docs, "text")).alias("size"))
    if not keep_rows:
        sized = stored(sized, "doc-size")
    targets = stored(source_targets(sized.select("source", "size"), weights), "targets")
    t = targets.select(F.col("source").alias("_of"), "source_size", "target", "rate")
    out = sized.join(t, sized["source"].eqNullSafe(t["_of"])).drop("_of")
    return out.withColumn("copies", copies(F.col("rate"), F.col("key"), seed))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """The mix itself: each document's row, once per copy taken."""
    plan = mix_plan(docs, weights, seed, keep_rows=True).where("copies > 0")
    out = plan.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return give_back(out, "doc", docs.columns)
