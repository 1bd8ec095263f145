"""Token ids in Arrow stream files of equal-length sequences (operator 11).

Documents are put in ascending doc_id order by one range shuffle of their
texts; each task tokenises its range, ends every document with ``end_id`` and
writes the ids, documents running on from one sequence into the next, as Arrow
IPC streams (``.arrows``).  A record batch holds ``BATCH`` sequences in three
columns:

    ids   fixed_size_list<uint16>[size], uint32 for vocabularies beyond 65,536
    mask  fixed_size_list<bool>[size]: false for padding
    last  fixed_size_list<bool>[size]: true for the last id of a document

Every batch of a file is written full (the last one is padded), without nulls
and without compression, so all batch messages have one byte length.  A stream
has no footer, yet sequence k is found by arithmetic alone; on a mapped file it
is a view, not a copy.  Beside each file lies its index, an Arrow stream of
(doc_id, start, n_tokens) with starts counted within the file.

Files are written through ``pyarrow.fs`` into the shared folder under a name no
other attempt of the task has; the rows a task returns name the files of the
attempt that Spark accepted, and these rows, stored, are the manifest.  Files
of lost or repeated attempts are in no manifest and are never read.  A file
ends after ``file_sequences`` sequences, and a task holds one batch of texts
and one of sequences whatever its range.

Defined results: null and empty texts are one end id; a null doc_id comes
first; rows with one doc_id are documents of their own, ordered by a hash of
their text, equal rows in any order (their ids are equal); a text longer than
a sequence, or than a batch, runs on (it is tokenised as one cell); an empty
table writes no file and reads back empty; columns beyond doc_id and text are
not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import col, stored
from meterlake.llm.encode import default_tokenizer, encoder, slices
from meterlake.session import scratch_path

SEQUENCE = 2048
BATCH = 64
FILE_SEQUENCES = 1 << 17  # of 2048 ids of 2.25 bytes: files of 0.6 GB
END_ID = 1

INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST_TYPE = "part long, nth long, file string, documents long, tokens long"


def sequence_schema(size: int, vocabulary: int) -> pa.Schema:
    def fixed(name, kind):
        return pa.field(name, pa.list_(pa.field("item", kind, nullable=False), size), nullable=False)

    return pa.schema([fixed("ids", pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()),
                      fixed("mask", pa.bool_()), fixed("last", pa.bool_())])


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") \
        else (fs.LocalFileSystem(), path)


class _FileWriter:
    """One sequence file and its index, written batch by batch."""

    def __init__(self, path: str, schema: pa.Schema, batch: int):
        self.path, self.schema = path, schema
        self.size = schema.field("ids").type.list_size
        system, where = _open(path)
        system.create_dir(where.rsplit("/", 1)[0], recursive=True)
        self.sinks = [system.open_output_stream(where + end) for end in (".arrows", ".index.arrows")]
        self.out = pa.ipc.new_stream(self.sinks[0], schema)
        self.index = pa.ipc.new_stream(self.sinks[1], INDEX)
        self.ids = np.zeros(self.size * batch, schema.field("ids").type.value_type.to_pandas_dtype())
        self.last = np.zeros(len(self.ids), bool)
        self.used = self.tokens = self.documents = 0

    def room(self, sequences: int) -> int:
        return sequences * self.size - self.tokens

    def put(self, ids: np.ndarray, ends: np.ndarray) -> None:
        """Append ids; ``ends``: places in ``ids`` of documents' last ids."""
        last = np.zeros(len(ids), bool)
        last[ends] = True
        self.tokens += len(ids)
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, len(self.ids) - self.used)
            self.ids[self.used:self.used + n] = ids[at:at + n]
            self.last[self.used:self.used + n] = last[at:at + n]
            self.used, at = self.used + n, at + n
            if self.used == len(self.ids):
                self._flush()

    def put_index(self, doc_ids: pa.Array, starts: np.ndarray, counts: np.ndarray) -> None:
        self.documents += len(starts)
        self.index.write_batch(pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(starts), pa.array(counts)], schema=INDEX))

    def _flush(self) -> None:
        self.ids[self.used:], self.last[self.used:] = 0, False
        mask = np.arange(len(self.ids)) < self.used
        self.out.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type)
             for f, x in zip(self.schema, (self.ids, mask, self.last))], schema=self.schema))
        self.used = 0

    def close(self) -> tuple[str, int, int]:
        if self.used:
            self._flush()
        for x in (self.out, self.index, *self.sinks):
            x.close()
        return self.path, self.documents, self.tokens


def ordered(docs: DataFrame) -> DataFrame:
    """doc_id and UTF-8 text, ascending.  Rows that share a doc_id are parted by
    text and place, so one id of very many rows is no hot range."""
    rows = docs.select(col(docs, "doc_id").cast("long").alias("doc_id"),
                       col(docs, "text").cast("string").alias("text"))
    keys = rows.select("doc_id", F.xxhash64("text").alias("mark"), F.monotonically_increasing_id().alias("row"),
                       F.col("text").cast("binary").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), "mark", "row"]
    return keys.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")


def written(docs: DataFrame, path: str, tokenizer: str | None = None, size: int = SEQUENCE,
            end_id: int = END_ID, batch: int = BATCH, file_sequences: int = FILE_SEQUENCES) -> DataFrame:
    """Write ``docs`` under ``path``; the manifest: part, nth, file, documents,
    tokens and ``start`` (ids in all earlier files), one row a file.

    Prefix sums run over one row a file, in one task: 1e5 files at 100 TB."""
    tokenizer = tokenizer or default_tokenizer()
    root = path.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        schema = sequence_schema(size, enc.tokenizer.get_vocab_size())
        out, done = None, []
        for rows in batches:
            for a, b, texts in slices(rows.column(1)):
                flat, n = enc.ids(texts)
                total = n + 1
                ends = np.cumsum(total)
                ids = np.full(int(ends[-1]), end_id, np.uint32)
                body = np.ones(len(ids), bool)
                body[ends - 1] = False
                ids[body] = flat
                doc_ids = rows.column(0).slice(a, b - a)
                first = 0
                while first < b - a:  # documents [first, last) go to one file
                    if out is None:
                        out = _FileWriter(f"{root}/part-{part:06d}-{len(done):04d}-{uuid.uuid4().hex[:12]}",
                                          schema, batch)
                    base = int(ends[first] - total[first])
                    last = int(np.searchsorted(ends, base + max(out.room(file_sequences), 0), "right"))
                    if last <= first and out.tokens:
                        done.append(out.close())
                        out = None
                        continue
                    last = max(last, first + 1)  # a document is never split between files
                    stop = int(ends[last - 1])
                    out.put_index(doc_ids.slice(first, last - first),
                                  out.tokens + ends[first:last] - total[first:last] - base, total[first:last])
                    out.put(ids[base:stop], ends[first:last] - 1 - base)
                    first = last
        if out is not None:
            done.append(out.close())
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "nth": k, "file": f, "documents": d, "tokens": t} for k, (f, d, t) in enumerate(done)],
            schema=pa.schema([("part", pa.int64()), ("nth", pa.int64()), ("file", pa.string()),
                              ("documents", pa.int64()), ("tokens", pa.int64())]))

    files = stored(ordered(docs).mapInArrow(run, MANIFEST_TYPE), "id-files")
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


class SequenceFile:
    """Random access to one file by sequence number.  All batches are equally
    long, so a batch's place follows from its number; arrays of a local file
    are views of its map, elsewhere one batch is read."""

    def __init__(self, path: str):
        from pyarrow import fs

        system, where = _open(path)
        name = where + ".arrows"
        local = isinstance(system, fs.LocalFileSystem)
        self.source = pa.memory_map(name) if local else system.open_input_file(name)
        self.schema = pa.ipc.read_schema(self.source)
        self.head, self.held = self.source.tell(), (None, None)
        self.step = self.batch = 1
        if self.head + 8 < self.source.size():  # more than the end mark
            self.batch = self._batch(0).num_rows
            self.step = self.source.tell() - self.head
        self.sequences = (self.source.size() - self.head) // self.step * self.batch if self.step > 1 else 0

    def _batch(self, k: int) -> pa.RecordBatch:
        if self.held[0] != k:
            self.source.seek(self.head + k * self.step)
            self.held = k, pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)
        return self.held[1]

    def __len__(self) -> int:
        return self.sequences

    def __getitem__(self, k: int) -> tuple[pa.Array, pa.Array, pa.Array]:
        """(ids, mask, last) of sequence k."""
        if not 0 <= k < self.sequences:
            raise IndexError(k)
        batch, row = divmod(k, self.batch)
        return tuple(c.slice(row, 1).flatten() for c in self._batch(batch).columns)

    def close(self) -> None:
        self.held = None, None
        self.source.close()


def index_batches(path: str) -> Iterator[pa.RecordBatch]:
    system, where = _open(path)
    with system.open_input_stream(where + ".index.arrows") as f:
        yield from pa.ipc.open_stream(f)


def documents_of(path: str) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(doc_ids, starts, counts, ids of each document) a run of documents at a
    time, read in order; fails where the marks and the index differ."""
    system, where = _open(path)
    with system.open_input_stream(where + ".arrows") as f:
        stream = iter(pa.ipc.open_stream(f))
        ids, last, base = np.zeros(0, np.uint16), np.zeros(0, bool), 0
        for rows in index_batches(path):
            starts, counts = rows.column(1).to_numpy(), rows.column(2).to_numpy()
            first = 0
            while first < len(starts):
                parts = [(ids[starts[first] - base:], last[starts[first] - base:])]
                base, have = int(starts[first]), len(parts[0][0])
                while have < counts[first]:
                    got = next(stream)
                    keep = got.column(1).flatten().to_numpy(zero_copy_only=False)
                    parts.append((got.column(0).flatten().to_numpy()[keep],
                                  got.column(2).flatten().to_numpy(zero_copy_only=False)[keep]))
                    have += len(parts[-1][0])
                ids, last = (np.concatenate(x) for x in zip(*parts))
                stop = int(np.searchsorted(starts + counts, base + have, "right"))
                a, z = starts[first:stop] - base, (starts + counts)[first:stop] - base
                if not np.array_equal(np.flatnonzero(last[:z[-1]]), z - 1):
                    raise ValueError(f"{path}: marks and index differ")
                yield (rows.column(0).slice(first, stop - first), starts[first:stop], counts[first:stop],
                       [ids[i:j] for i, j in zip(a, z)])
                first = stop


def read_back(manifest: DataFrame, ids: bool = True) -> DataFrame:
    """doc_id, start (ids in all documents before), n_tokens, ids_crc32 of
    every document in the files of ``manifest``, and its ids if asked for."""
    import zlib

    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
              ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int64()))] * ids
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for path, base in zip(files.column(0).to_pylist(), files.column(1).to_pylist()):
                for doc_ids, starts, counts, parts in documents_of(path):
                    columns = [doc_ids, pa.array(starts + base), pa.array(counts),
                               pa.array([zlib.crc32(x.astype("<u4")) for x in parts], pa.int64())]
                    if ids:
                        columns.append(pa.array([x.astype(np.int64) for x in parts], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    spark = manifest.sparkSession
    files = stored(manifest.select("file", "start"), "id-manifest")
    # One row a file, dealt round over the cluster: reading is the work.
    spread = files.repartition(spark.sparkContext.defaultParallelism * 2)
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"
                             + (", ids array<long>" if ids else ""))


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs`` to the shared folder and read them back, without ids."""
    spark: SparkSession = docs.sparkSession
    return read_back(written(docs, scratch_path(spark, "token-ids"), tokenizer), ids=False)
