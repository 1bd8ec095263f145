"""Quality rules with host-level verdicts (operator 9).

Document rules are measured on the whole text.  Their failures are aggregated
per host (here: the ``source`` column), each host's failure rate is shrunk by
an empirical beta prior fitted to all hosts by moments, and the host verdict
is joined back.  The posterior of a host's rate is a beta, too; ``sure_rate`` is
the value that the rate exceeds with probability ``LEVEL`` (95 %, by the
posterior's mean and deviation).  A host is rejected where that value is above
both ``max_host_rate``, so that most of its documents fail, and the corpus rate:
a host of twice or five times the usual rate still holds mostly clean documents,
which stay.

Defined results: null text counts as no words (fails the minimum length); a
null host is a host of its own; repeated rows are judged and counted each;
very long texts are measured whole, one at a time in a task; an empty table
gives empty tables; input columns are never read beyond the ones named, so
extra columns of any name are harmless.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import SPACES, col, give_back, stored, whole_row

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_HOST_RATE = 0.5
LEVEL = 1.645  # standard deviations below the posterior mean: 95 %

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATS_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in STATS])


def repeated_words(words: list[bytes]) -> int:
    """Words inside 5-word windows that occur at least twice in the text.

    Windows are compared by a 64-bit rolling hash first; only a text in which
    two hashes meet is compared word by word, so the count is exact."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    roll = h[:n].copy()
    for k in range(1, WINDOW):
        roll *= np.uint64(0x9E3779B97F4A7C15)
        roll += h[k:n + k]
    ordered = np.sort(roll)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    windows = list(zip(*(words[k:n + k] for k in range(WINDOW))))
    seen = Counter(windows)
    hit = np.zeros(len(words) + 1, np.int64)
    at = np.fromiter((i for i, w in enumerate(windows) if seen[w] > 1), np.int64)
    np.add.at(hit, at, 1)
    np.add.at(hit, at + WINDOW, -1)
    return int((np.cumsum(hit) > 0).sum())


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    raw = (text or "").encode()
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, SPACES))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip(SPACES)]
    return (len(words), len(text or "") - spaces, symbols,
            len(lines) - len(set(lines)), repeated_words(words))


@F.pandas_udf(STATS_TYPE)
def stats_udf(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_stats(t) for t in text], columns=STATS, dtype="int64")


def rule_failed(stats: str = "stats"):
    s = F.col(stats)
    return ((s["n_words"] < MIN_WORDS)
            | (s["n_repeat_words"] * 100 > s["n_words"] * MAX_REPEAT_PERCENT))


def host_rates(judged: DataFrame, host: str = "host", failed: str = "failed") -> DataFrame:
    """One row per host: documents, failures, shrunk failure rate, sure_rate and
    the corpus rate.

    Prior by moments: mean = overall rate m; the document-weighted variance of
    the host rates, less its binomial part, gives the precision a + b, at least
    1 and at most the mean number of documents a host: however alike the other
    hosts are, the prior never outweighs an average host's own documents.
    Counts are combined on the map side, so a hot host costs one row a task."""
    per = judged.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n_docs"),
        F.sum(F.col(failed).cast("long")).alias("n_failed"))
    per = stored(per, "host-counts")
    n, f = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    tot = per.agg(F.sum(f).alias("f"), F.sum(n).alias("n"), F.count("*").alias("h"),
                  F.sum(f * f / n).alias("ff"))
    mean = F.col("f") / F.col("n")
    between = F.greatest(F.col("ff") / F.col("n") - mean * mean, F.lit(0.0))
    within = mean * (1 - mean) * F.col("h") / F.col("n")
    excess = F.greatest(between - within, F.lit(1e-12))
    most = F.greatest(F.col("n") / F.col("h"), F.lit(1.0))
    strength = F.least(F.greatest(mean * (1 - mean) / excess - 1, F.lit(1.0)), most)
    prior = tot.select(mean.alias("mean"), strength.alias("strength")).first()
    m, s = (prior["mean"] or 0.0, prior["strength"] or 1.0)
    rate = (f + F.lit(m * s)) / (n + F.lit(s))
    sure = rate - LEVEL * F.sqrt(rate * (1 - rate) / (n + F.lit(s) + 1))
    return per.select("host", "n_docs", "n_failed", rate.alias("shrunk_rate"), sure.alias("sure_rate"),
                      F.lit(float(m)).alias("corpus_rate"))


def with_verdict(judged: DataFrame, rates: DataFrame, host: str = "host",
                 failed: str = "failed", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``judged`` plus ``shrunk_rate``, ``sure_rate`` and ``kept``."""
    bad = (F.col("sure_rate") > max_host_rate) & (F.col("sure_rate") > F.col("corpus_rate"))
    r = rates.select(F.col("host").alias("_rate_host"), F.col("shrunk_rate").alias("shrunk_rate"),
                     F.col("sure_rate").alias("sure_rate"), bad.alias("_bad_host"))
    out = judged.join(r, judged[host].eqNullSafe(r["_rate_host"]), "left").drop("_rate_host")
    return out.withColumn("kept", ~F.col(failed) & ~F.col("_bad_host")).drop("_bad_host")


def judged_documents(docs: DataFrame, host_col: str = "source", text_col: str = "text",
                     keep_rows: bool = False) -> DataFrame:
    """Measures, ``host`` and ``failed`` per document; with ``keep_rows`` the
    whole input row rides along as the struct ``doc``."""
    base = docs.select(
        (whole_row(docs) if keep_rows else F.struct(*[
            col(docs, c).alias(c) for c in docs.columns if c != text_col])).alias("doc"),
        col(docs, host_col).alias("host"), stats_udf(col(docs, text_col)).alias("stats"))
    return base.withColumn("failed", rule_failed())


def quality_report(docs: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """doc (struct of the input columns but text), stats, host, failed,
    shrunk_rate, sure_rate, kept: one row per document.  The measures are stored once
    (no texts), so both the host totals and the join read the small table."""
    judged = stored(judged_documents(docs), "quality-stats")
    return with_verdict(judged, host_rates(judged), max_host_rate=max_host_rate)


def keep_good(docs: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The documents that stay, with their own columns.  Measures are
    recomputed in the second scan, which costs less than moving the texts."""
    rates = stored(host_rates(judged_documents(docs)), "host-rates")
    judged = judged_documents(docs, keep_rows=True)
    kept = with_verdict(judged, rates, max_host_rate=max_host_rate).where("kept")
    return give_back(kept, "doc", docs.columns)
