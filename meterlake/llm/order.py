"""Exact places of rows within their group, however large a group is."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from meterlake.llm.common import stored


def _run_starts(groups: pa.Array) -> np.ndarray:
    """True where a row's group differs from the row before (the first: True)."""
    null = pc.is_null(groups).to_numpy(zero_copy_only=False)
    value = pc.fill_null(groups, 0).to_numpy()
    return np.concatenate([[True], (value[1:] != value[:-1]) | (null[1:] != null[:-1])])


def numbered(rows: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``pos``, the place from 0 within ``group`` (a long column,
    null is a group of its own) by ``order``, stored and sorted.

    Rows are range-partitioned by group and order, so a group of a third of
    all rows lies over many tasks; each task numbers its part of a group as it
    streams by, and the rows of the same group in earlier partitions are added.
    Only a partition's first group can have any: the driver sees one row (two
    group ids, one count) a partition."""
    spark = rows.sparkSession
    by = [F.col(group).asc_nulls_first(), *order]
    place = rows.columns.index(group)
    marked_type = rows.select("*", *[F.lit(0).cast("long").alias(n) for n in ("part", "at", "nth")],
                              F.lit(True).alias("open")).schema
    arrow = to_arrow_schema(marked_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, seen, last, first = TaskContext.get().partitionId(), 0, 0, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(place)
            starts = _run_starts(groups)
            if at and groups[0].as_py() == last:
                starts[0] = False
            k = np.arange(len(starts))
            since = np.maximum.accumulate(np.where(starts, k, -1))
            nth = np.where(since < 0, seen + k, k - since)
            runs = np.cumsum(starts) - (at == 0)
            is_open = first & (runs == 0)
            first, seen, last = bool(is_open[-1]), int(nth[-1]) + 1, groups[-1].as_py()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(k), part)), pa.array(at + k), pa.array(nth),
                 pa.array(is_open)], schema=arrow)
            at += len(k)

    marked = stored(rows.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, marked_type), name)
    edge = F.struct("at", F.col(group).alias("g"), "nth")
    edges = marked.groupBy("part").agg(F.min(edge).alias("a"), F.max(edge).alias("z")).collect()
    before, held, n, begun = [], None, 0, False
    for r in sorted(edges, key=lambda r: r.part):
        add = n if begun and r.a.g == held else 0
        if add:
            before.append((r.part, add))
        n = r.z.nth + 1 + (add if r.a.g == r.z.g else 0)
        held, begun = r.z.g, True
    pos = F.col("nth")
    if before:
        shift = spark.createDataFrame(before, "part long, before long")
        marked = marked.join(F.broadcast(shift), "part", "left")  # at most one row a partition
        pos = pos + F.when(F.col("open"), F.coalesce("before", F.lit(0))).otherwise(0)
    return marked.select(*rows.columns, pos.alias("pos"))


def text_order(text: str = "text") -> list[Column]:
    """Order of rows that nothing else tells apart: by the first 64 characters
    of the text, then its hash, then where the row came from (equal texts).
    Bounded keys, so range bounds stay small whatever the texts."""
    return [F.substring(text, 1, 64), F.xxhash64(text), F.monotonically_increasing_id()]
