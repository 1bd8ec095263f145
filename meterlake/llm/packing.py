"""Packing documents into sequences (operator 4).

Documents are tokenised whole, ended by an end id, and cut into full pieces of
``size`` ids plus one rest.  Shortest-pack-first runs over the histogram of
rest lengths: lengths are placed longest first, each into the open pattern
with the most room that fits, updating how many packs follow each pattern.
Patterns are joined back to pieces by rank within their length.

The histogram has at most ``size`` bins and every step splits at most one
pattern, so the driver handles O(size) numbers at any corpus size.  Ranks need
no sort: a piece carries its running number within (task, length), fixed when
the pieces are written, and the count of that length in earlier tasks is added.

Defined results: null and empty texts are one piece holding the end id;
repeated rows are packed each; a null doc_id stays null; an empty table gives
no pieces; a very long text is tokenised as one cell and cut into as many pieces
as it needs; columns beyond doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import col, stored
from meterlake.llm.encode import default_tokenizer, encoder, slices

SEQUENCE = 2048
END_ID = 1

PIECE_TYPE = ("doc_id long, start long, length long, ids array<int>, doc_tokens long, "
              "part long, nth long")


def pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece; ``nth`` counts rests of equal length within ``part``
    (the task), full pieces among themselves."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids", pa.list_(pa.int32())), ("doc_tokens", pa.int64()),
                        ("part", pa.int64()), ("nth", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for a, b, texts in slices(batch.column(1)):
                flat, n = enc.ids(texts)
                total = n + 1
                ends = np.cumsum(total)
                ids = np.full(int(ends[-1]), end_id, np.int32)
                body = np.ones(len(ids), bool)
                body[ends - 1] = False
                ids[body] = flat
                count = -(-total // size)
                doc = np.repeat(np.arange(b - a), count)
                k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = k * size
                length = np.minimum(size, total[doc] - start)
                nth = np.empty(len(doc), np.int64)
                order = np.argsort(length, kind="stable")
                run_len = length[order]
                first = np.searchsorted(run_len, run_len, "left")
                nth[order] = seen[run_len] + np.arange(len(order)) - first
                seen += np.bincount(length, minlength=size + 1)
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([doc_ids[a + i] for i in doc], pa.int64()), pa.array(start),
                    pa.array(length), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
                    pa.array(total[doc]), pa.array(np.full(len(doc), part)), pa.array(nth)],
                    schema=schema)

    return docs.select(col(docs, "doc_id").cast("long").alias("doc_id"),
                       col(docs, "text").cast("binary").alias("text")).mapInArrow(run, PIECE_TYPE)


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """[(lengths in a pack, number of packs)], covering every count.

    ``room[r]`` holds the open patterns with ``r`` ids left.  A length goes to
    the packs with most room; the packs it fills move on as a new pattern."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            widest = max((r for r, packs in room.items() if packs and r >= length), default=None)
            if widest is None:
                room.setdefault(size - length, []).append(((length,), left))
                break
            pattern, packs = room[widest].pop()
            per = min(widest // length, -(-left // packs))  # several of one length at once
            used = min(packs, left // per)
            if used < packs:
                room[widest].append((pattern, packs - used))
            room.setdefault(widest - per * length, []).append((pattern + (length,) * per, used))
            left -= used * per
    return [(list(p), n) for packs in room.values() for p, n in packs]


def interval_table(patterns: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first sequence, offset): which
    sequences the pieces of a length go to, by rank."""
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for lengths, packs in patterns:
        offset = 0
        for length in lengths:
            r = rank.get(length, 0)
            out.append((length, r, r + packs, sequence, offset))
            rank[length] = r + packs
            offset += length
        sequence += packs
    return out


def packed(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE,
           end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset per piece."""
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer or default_tokenizer(), size, end_id), "pieces")
    per_part = stored(cut.groupBy("part", "length").count(), "piece-counts")
    histogram = {r["length"]: r["n"] for r in
                 per_part.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # <= size rows
    intervals = interval_table(shortest_pack_first(histogram, size))
    before = (Window.partitionBy("length").orderBy("part")
              .rowsBetween(Window.unboundedPreceding, -1))
    earlier = stored(per_part.select("part", "length", F.coalesce(
        F.sum("count").over(before), F.lit(0)).alias("before")), "piece-ranks")
    ranked = cut.join(earlier, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))

    by_length: dict[int, np.ndarray] = {}
    for length, *rest in intervals:
        by_length.setdefault(length, []).append(rest)
    plan = spark.sparkContext.broadcast({k: np.array(v, np.int64) for k, v in by_length.items()})

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        values, ranks = length.to_numpy(), rank.to_numpy()
        for value in np.unique(values):
            rows = np.flatnonzero(values == value)
            table = plan.value[int(value)]
            at = np.searchsorted(table[:, 0], ranks[rows], "right") - 1
            seq[rows] = table[at, 2] + ranks[rows] - table[at, 0]
            off[rows] = table[at, 3]
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    out = ranked.withColumn("place", place("length", "rank"))
    return out.select("doc_id", "start", "length", "ids", "doc_tokens",
                      "place.sequence_id", "place.offset")
