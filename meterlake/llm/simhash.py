"""SimHash near-duplicates by Golay-code fuzzy hashing (operator 8).

Fingerprint: words of the lower-cased text (A-Z only), 3-word shingles with
repeats, XXH64 (seed 42) of each; a bit is 1 if set in over half the hashes.

Links join fingerprints at ``max_bits`` = 3 or fewer differing bits:

* the 64 bits are cut into three segments (22, 21, 21 bits; zero-padded to the
  23 bits of the perfect Golay code).  Three errors over three segments leave
  two segments with at most one error each (otherwise two segments had two
  or more), so each of the three segment pairs is tried;
* a 23-bit word decodes to the 12-bit index of the one codeword within three
  bits.  Words one bit apart need not share that index, but the index of one
  is always among the (1 or 6) indices met by decoding the other and its 23
  neighbours.  For a pair of segments (i, j) a fingerprint is filed under
  {indices near its i} x {own index of j} and under {own index of i} x {indices
  near its j}; two fingerprints with at most one error in each meet between the
  two kinds of keys;
* those that meet are verified by counting differing bits.  A key's members are
  dealt into blocks of about ``BLOCK`` and every left block meets every right
  block in a group of its own, so a key that a third of all fingerprints share
  is many tasks' work.  Only links that join two groups not yet joined in that
  task are emitted, so a dense group of m near copies gives about m rows a
  block, not m * m.  No key or member is skipped.

Groups are the connected components over those links, by repeated minimum
exchange on link tables (large-star, small-star), each round written to the
shared folder.  Equal fingerprints are collapsed first, so thousands of exact
copies weigh one row.

Defined results: null, empty and blank texts have fingerprint zero, linked
like any other; texts below three words hash their whole word sequence; a
component's id is its smallest doc_id (null only if all are null); repeated
rows each get a row; an empty table gives an empty one; only doc_id and text
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import col, give_back, stored, whole_row

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))
BLOCK = 8_192   # members of one kind that a task holds of a key
ONE_OF = 64     # fingerprints looked at to find the large keys

# ---- fingerprints ---------------------------------------------------------


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the whole text."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= shingle:
        return digest(joined, SEED)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = end - length
    ones, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for at in range(0, n, 65_536):  # bounded memory for very long texts
        stop = min(n, at + 65_536)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(
            start[at:stop].tolist(), end[at + shingle - 1:stop + shingle - 1].tolist())),
            np.dtype("<u8"), stop - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carry: str | None = None) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long); ``carry`` names a column to
    take along under the name carry."""

    @F.pandas_udf("long")
    def fp(text: pd.Series) -> pd.Series:
        bits = np.array([fingerprint(t, shingle) for t in text], np.uint64)
        return pd.Series(bits.view(np.int64))

    more = [col(docs, carry).alias("carry")] if carry else []
    return docs.select(col(docs, "doc_id").alias("doc_id"), fp(col(docs, "text")).alias("fp"), *more)


# ---- Golay code -----------------------------------------------------------

GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, the code's polynomial


def _syndrome(word: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words modulo the generator polynomial."""
    rest = word.copy()
    for k in range(22, 10, -1):
        rest ^= np.where(rest >> k & 1, GENERATOR << (k - 11), 0)
    return rest


def _nearest_error() -> np.ndarray:
    """Syndrome -> the one error pattern of weight three or less."""
    from itertools import combinations

    errors = np.array([sum(1 << b for b in bits) for n in range(4)
                       for bits in combinations(range(23), n)], np.int64)
    table = np.zeros(2048, np.int64)
    table[_syndrome(errors)] = errors
    return table


_ERROR = _nearest_error()


def golay_index(word: np.ndarray) -> np.ndarray:
    """Index (the 12 message bits) of the codeword within three bits."""
    return (word ^ _ERROR[_syndrome(word)]) >> 11


def near_indices(word: np.ndarray) -> np.ndarray:
    """(n, 6) distinct indices met by decoding the word and its 23 neighbours;
    -1 where there are fewer."""
    flips = np.array([0] + [1 << b for b in range(23)], np.int64)
    met = np.sort(golay_index(word[:, None] ^ flips), axis=1)
    fresh = np.ones(met.shape, bool)
    fresh[:, 1:] = met[:, 1:] != met[:, :-1]
    place = np.cumsum(fresh, axis=1) - 1
    out = np.full((len(word), 6), -1, np.int64)
    row = np.nonzero(fresh)[0]
    out[row, place[fresh]] = met[fresh]
    return out


def segment_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, kind, row) of every filing of the fingerprints ``fp`` (uint64)."""
    parts = [(fp >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    own = [golay_index(p) for p in parts]
    near = [near_indices(p) for p in parts]
    keys, kinds, rows = [], [], []
    for p, (i, j) in enumerate(PAIRS):
        for kind, made in ((0, (near[i] << 12) | own[j][:, None]),
                           (1, (own[i] << 12)[:, None] | near[j])):
            there = (near[i] if kind == 0 else near[j]) >= 0
            row = np.nonzero(there)[0]
            keys.append(made[there] | (p << 24))
            kinds.append(np.full(len(row), kind, np.int8))
            rows.append(row)
    return np.concatenate(keys), np.concatenate(kinds), np.concatenate(rows)


def filed(distinct: DataFrame) -> DataFrame:
    """key, kind, fp: all filings of distinct fingerprints."""
    schema = pa.schema([("key", pa.int64()), ("kind", pa.int8()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fps), 4096):
                some = fps[at:at + 4096]
                key, kind, row = segment_keys(some.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(kind), pa.array(some[row])], schema=schema)

    return distinct.select("fp").mapInArrow(run, "key long, kind byte, fp long")


# ---- links ----------------------------------------------------------------


class Joined:
    """Which fingerprints this task has already joined (union by path halving)."""

    def __init__(self, most: int = 1_000_000):
        self.up: dict[int, int] = {}
        self.most = most

    def forget(self) -> None:
        """Bounded memory: what is forgotten can only cost a link told twice."""
        if len(self.up) > self.most:
            self.up.clear()

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def run_links(left: np.ndarray, right: np.ndarray, max_bits: int, joined: Joined,
              out: list[tuple[int, int]]) -> None:
    """Verify all left x right members of one key in blocks; keep only links
    that join two groups."""
    step = max(1, (1 << 20) // max(1, len(right)))
    for at in range(0, len(left), step):
        some = left[at:at + step]
        close = np.bitwise_count(some[:, None] ^ right[None, :]) <= max_bits
        close &= some[:, None] != right[None, :]
        for i in np.flatnonzero(close.any(axis=1)):
            a = int(some[i].astype(np.int64))
            for b in right[close[i]].astype(np.int64).tolist():
                if joined.join(a, b):
                    out.append((a, b))


def large_keys(distinct: DataFrame, block: int, one_of: int) -> DataFrame:
    """key, lefts, rights: keys with more than about ``block`` members of a kind,
    and into how many blocks each kind is split.  They are found among one of
    ``one_of`` fingerprints, which only steers the work: a key that is missed
    stays one group, no link depends on it."""
    some = distinct.where(F.pmod(F.xxhash64("fp", F.lit(3)), F.lit(one_of)) == 0)
    seen = filed(some).groupBy("key").agg(*[F.count(F.when(F.col("kind") == k, 1)).alias(n)
                                            for k, n in enumerate(("lefts", "rights"))])
    parts = [F.greatest(F.ceil(F.col(n) * one_of / block), F.lit(1)).cast("int").alias(n) for n in ("lefts", "rights")]
    return seen.select("key", *parts).where("lefts > 1 OR rights > 1")


def grouped(distinct: DataFrame, block: int = BLOCK, one_of: int = ONE_OF) -> DataFrame:
    """key, left, right, kind, fp: the filings, a large key's members dealt into
    blocks such that every left block meets every right block."""
    large = stored(large_keys(distinct, block, one_of), "large-keys")  # broadcast while small
    rows = filed(distinct).join(large, "key", "left")
    own = lambda n: F.pmod(F.xxhash64("fp"), F.coalesce(n, F.lit(1))).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1)
    place = F.when(F.col("kind") == 0, F.transform(every(F.col("rights")), lambda j: F.struct(
        own(F.col("lefts")).alias("left"), j.alias("right")))).otherwise(F.transform(
            every(F.col("lefts")), lambda i: F.struct(i.alias("left"), own(F.col("rights")).alias("right"))))
    return rows.select("key", "kind", "fp", F.explode(place).alias("at")).select("key", "at.left", "at.right", "kind", "fp")


def links(distinct: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK, one_of: int = ONE_OF) -> DataFrame:
    """a, b: links that connect the near-duplicate groups of distinct
    fingerprints (every two linked ones are connected by them)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined = Joined()
        rest = [np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros(0, np.int64)]
        last_group, numbers = None, 0

        def flush(key, kind, fp):
            out: list[tuple[int, int]] = []
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            stop = np.append(start[1:], len(key))
            ones = np.concatenate([[0], np.cumsum(kind == 1)])
            right = ones[stop] - ones[start]
            for s, e in zip(start[(right > 0) & (right < stop - start)],
                            stop[(right > 0) & (right < stop - start)]):
                member = fp[s:e].view(np.uint64)
                of = kind[s:e]
                if member.min() != member.max():
                    run_links(member[of == 0], member[of == 1], max_bits, joined, out)
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()),
                 pa.array([x[1] for x in out], pa.int64())], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            # Groups (key, left, right) are numbered as they come, in order.
            place = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
            fresh = np.any(place[1:] != place[:-1], axis=1)
            fresh = np.concatenate([[last_group is not None and tuple(place[0]) != last_group], fresh])
            number = numbers + np.cumsum(fresh)
            numbers, last_group = int(number[-1]), tuple(place[-1])
            new = [number, batch.column(3).to_numpy(zero_copy_only=False), batch.column(4).to_numpy(zero_copy_only=False)]
            cols = [np.concatenate([r, x]) for r, x in zip(rest, new)]
            last = int(np.searchsorted(cols[0], cols[0][-1], "left")) if len(cols[0]) else 0
            rest = [c[last:] for c in cols]  # the last key may go on in the next batch
            if last:
                yield flush(*[c[:last] for c in cols])
                joined.forget()
        if len(rest[0]):
            yield flush(*rest)

    by = ["key", "left", "right"]
    return (grouped(distinct, block, one_of).repartition(*by).sortWithinPartitions(*by, "kind", "fp")
            .mapInArrow(run, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of the component; signed order) for all
    nodes of ``edges`` (a, b).

    Alternating star contraction: every node hangs its larger neighbours, then
    its smaller ones, on the smallest it knows; stops when the links stay the
    same (every node linked to its root alone).  Rounds grow with the log of
    the component size."""
    links_ = stored(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        both = links_.select("a", "b").unionAll(links_.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.join(least, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*").where("a <> b").distinct())
        links_ = stored(small, "links")
        now = links_.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return links_.select(F.col("a").alias("node"), F.col("b").alias("root"))


def groups(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """fp, root (the group's smallest fingerprint, signed) of all fingerprints
    in ``prints``."""
    distinct = stored(prints.select("fp").distinct(), "distinct-fp")
    member = components(links(distinct, max_bits))
    return stored(distinct.join(member, distinct["fp"] == member["node"], "left")
                  .select("fp", F.coalesce("root", "fp").alias("root")), "fp-root")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp, component_id per row of ``docs``."""
    prints = stored(fingerprints(docs, shingle=shingle), "fingerprints")
    root = groups(prints, max_bits)
    per_fp = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")).join(root, "fp")
    least = per_fp.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stored(root.join(least, "root").select("fp", "component_id"), "fp-component")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """One document of each group, with its own columns: the one of smallest
    doc_id (nulls last); of rows with equal doc_id the one with the smallest
    hash of its row."""
    key = F.xxhash64(*[col(docs, c) for c in docs.columns])
    prints = stored(fingerprints(docs.select("*", key.alias("_row_key_")), shingle=shingle, carry="_row_key_"),
                    "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id"), F.col("carry"))
    per_fp = prints.groupBy("fp").agg(F.min(order).alias("o"))
    chosen = stored(per_fp.join(groups(prints, max_bits), "fp").groupBy("root")
                    .agg(F.min("o").alias("o")).select(F.col("o.carry").alias("_key")), "representatives")
    rows = docs.select(whole_row(docs).alias("doc"), key.alias("row_key"))
    kept = rows.join(chosen, rows["row_key"] == chosen["_key"], "left_semi")
    first = kept.groupBy("row_key").agg(F.first("doc").alias("doc"))
    return give_back(first, "doc", docs.columns)


def hex64(fp):
    """Sixteen lower-case hex digits of a signed long's bits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
