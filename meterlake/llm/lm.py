"""Language-model scoring by deleted interpolation (operator 6).

A bigram model over lower-cased words and one end per text:

    P(w | u) = a2[b] c(u, w) / c(u) + a1[b] c(w) / N + a0[b] / (V + 1)

with b = bucket(c(u)), powers of two of the context's frequency.  Maximum
likelihood counts come from the training documents.  The weights are learned
by expectation-maximisation: a part of the training documents is deleted from
the counts, and the weights per bucket that best explain its bigrams under
the remaining counts are found; they are then used with all counts.

How it runs.  Tasks cut their documents into chunks of about ``CHUNK`` tokens
and store each as its distinct words' 64-bit hashes and the places of its
tokens among them.  From that a chunk's distinct words and bigrams follow in a
fixed order, sorted by key; their counts are summed over chunks by key range
(the number of ranges follows the corpus, so a range fits a task however
large the corpus is), and the totals go back to the chunks in the same order,
so keys travel once and only counts return.  A very frequent word pair is
one entry per chunk.  What is moved grows with the corpus; nothing but the
weights (three per bucket) passes through the driver.

Words and bigrams are told apart by 64-bit hashes at every corpus size: two of
n share one with probability about n * n / 2^65.

Defined results: null and empty texts are one token, the end; a null doc_id
is hashed as 'null' for the split; repeated rows are each counted and scored;
with no training documents the model is uniform; a very long text is one chunk,
which bounds a text by a task's memory (12 bytes a token); an empty table gives
an empty one; only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import col, stored

CHUNK = 1 << 20
RANGE_TOKENS = 5 << 20  # corpus tokens per key range
FREQUENCY_BUCKETS = 48
FOLDS, HELD_OUT_FOLD, TUNE_FOLD = 7, 2, 3
MAX_ROUNDS = 25
LEAST_WEIGHT = 1e-6
END, BEGIN = b"\n", b"\n\n"  # no word holds white space


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % FOLDS


# ---- compact arrays -------------------------------------------------------

def planes(values: np.ndarray) -> bytes:
    """Whole numbers as byte planes, low bytes first, as many as the largest
    needs; the first byte tells how many."""
    wide = np.ascontiguousarray(values, np.uint64).view(np.uint8).reshape(-1, 8)
    width = max((k + 1 for k in range(8) if wide[:, k].any()), default=1)
    return bytes([width]) + wide[:, :width].T.tobytes()


def unplanes(data: bytes) -> np.ndarray:
    width = data[0]
    wide = np.zeros(((len(data) - 1) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1).T
    return wide.view(np.uint64).ravel()


def sorted_planes(keys: np.ndarray) -> bytes:
    return planes(np.diff(keys, prepend=np.uint64(0)))


def from_sorted_planes(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data), dtype=np.uint64)


def counts(values: np.ndarray) -> bytes:
    """Counts are mostly 0 and 1: entropy-coded, they take a fraction of a byte."""
    return zlib.compress(planes(values), 1)


def uncounts(data: bytes) -> np.ndarray:
    return unplanes(zlib.decompress(data))


def mixed(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """64-bit key of an ordered pair of word hashes."""
    x = u * np.uint64(0x9E3779B97F4A7C15) + (w ^ (u >> np.uint64(29)))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def frequency_bucket(count: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, else 1 + floor(log2(count))."""
    return np.minimum(np.frexp(count.astype(np.float64))[1], FREQUENCY_BUCKETS - 1)


# ---- chunks ---------------------------------------------------------------

CHUNK_TYPE = ("chunk long, doc_ids array<long>, folds array<long>, n_tokens array<long>, "
              "words binary, tokens binary")
CHUNK_SCHEMA = pa.schema([("chunk", pa.int64())]
                         + [(n, pa.list_(pa.int64())) for n in ("doc_ids", "folds", "n_tokens")]
                         + [(n, pa.binary()) for n in ("words", "tokens")])


class _Places(dict):
    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        return place


class ChunkBuilder:
    """Gathers documents and turns them into a chunk's row."""

    def __init__(self):
        self._new()

    def _new(self) -> None:
        self.places = _Places()
        self.places[END], self.places[BEGIN]  # places 0 and 1
        self.docs: list[tuple[int | None, int]] = []
        self.tokens: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, fold_: int, text: bytes) -> None:
        words = text.lower().split()
        ids = np.zeros(len(words) + 1, np.int32)  # the last one stays END
        ids[:-1] = np.fromiter(map(self.places.__getitem__, words), np.int32, len(words))
        self.docs.append((doc_id, fold_))
        self.tokens.append(ids)
        self.size += len(ids)

    def row(self, chunk: int) -> dict:
        """The chunk; frequent words get small places, which store well."""
        import xxhash

        n = len(self.places)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.places), np.uint64, n)
        tokens = np.concatenate(self.tokens)
        often = np.bincount(tokens, minlength=n)
        order = np.concatenate([[0, 1], 2 + np.argsort(-often[2:], kind="stable")])
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        out = {"chunk": chunk, "doc_ids": [d for d, _ in self.docs], "folds": [f for _, f in self.docs],
               "n_tokens": [len(t) for t in self.tokens], "words": planes(hashes[order]),
               "tokens": planes(place[tokens])}
        self._new()
        return out


def chunks(docs: DataFrame, chunk_tokens: int = CHUNK) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        build, n = ChunkBuilder(), 0
        for batch in batches:
            for doc_id, fold_, text in zip(*(batch.column(i) for i in range(3))):
                build.add(doc_id.as_py(), fold_.as_py(), text.as_py())
                if build.size >= chunk_tokens:
                    yield pa.RecordBatch.from_pylist([build.row(part + n)], schema=CHUNK_SCHEMA)
                    n += 1
        if build.docs:
            yield pa.RecordBatch.from_pylist([build.row(part + n)], schema=CHUNK_SCHEMA)

    rows = docs.select(
        col(docs, "doc_id").cast("long").alias("doc_id"), fold(col(docs, "doc_id")).alias("fold"),
        F.coalesce(col(docs, "text"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, CHUNK_TYPE)


class Chunk:
    """A stored chunk's distinct words and bigrams, both sorted by key."""

    def __init__(self, row: dict):
        hashes = unplanes(row["words"])
        order = np.argsort(hashes, kind="stable")
        self.words = hashes[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.begin = place[1]
        self.word = place[unplanes(row["tokens"]).astype(np.int64)]
        self.lengths = np.array(row["n_tokens"], np.int64)
        self.folds = np.array(row["folds"], np.int64)
        context = np.empty_like(self.word)
        context[1:] = self.word[:-1]
        context[np.cumsum(self.lengths) - self.lengths] = self.begin
        pairs, pair = np.unique(context * len(order) + self.word, return_inverse=True)
        u, w = pairs // len(order), pairs % len(order)
        keys = mixed(self.words[u], self.words[w])
        sort = np.argsort(keys, kind="stable")
        self.pairs, self.pair_context, self.pair_word = keys[sort], u[sort], w[sort]
        back = np.empty(len(sort), np.int64)
        back[sort] = np.arange(len(sort))
        self.pair = back[pair]

    def counted(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of words and of bigrams among the tokens of ``mask``."""
        return (np.bincount(self.word[mask], minlength=len(self.words)),
                np.bincount(self.pair[mask], minlength=len(self.pairs)))

    def of(self, *folds: int) -> np.ndarray:
        return np.isin(np.repeat(self.folds, self.lengths), folds)


KEPT_FOLDS = tuple(f for f in range(FOLDS) if f not in (HELD_OUT_FOLD, TUNE_FOLD))
KINDS = ("word", "pair")
COUNTED = [f"{kind}_{name}" for kind in KINDS for name in ("kept", "tune")]


def range_edges(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where ranges of equal width over sorted 64-bit keys begin."""
    return np.searchsorted(((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32), np.arange(ranges + 1))


def key_rows(cut: DataFrame, ranges: int) -> DataFrame:
    """chunk, range, sorted word and pair keys, and their counts in the chunk."""
    schema = pa.schema([("chunk", pa.int64()), ("range", pa.int32())]
                       + [(n, pa.binary()) for n in ("words", "pairs", *COUNTED)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                c = Chunk(row)
                kept, tune = c.counted(c.of(*KEPT_FOLDS)), c.counted(c.of(TUNE_FOLD))
                edges = [range_edges(c.words, ranges), range_edges(c.pairs, ranges)]
                for r in range(ranges):
                    (a, b), (x, y) = ((int(e[r]), int(e[r + 1])) for e in edges)
                    if a < b or x < y:
                        yield pa.RecordBatch.from_pylist([{
                            "chunk": row["chunk"], "range": r, "words": sorted_planes(c.words[a:b]),
                            "pairs": sorted_planes(c.pairs[x:y]), "word_kept": counts(kept[0][a:b]),
                            "word_tune": counts(tune[0][a:b]), "pair_kept": counts(kept[1][x:y]),
                            "pair_tune": counts(tune[1][x:y])}], schema=schema)

    columns = ["chunk", "folds", "n_tokens", "words", "tokens"]
    return cut.select(*columns).mapInArrow(
        run, "chunk long, range int, words binary, pairs binary, " + ", ".join(f"{n} binary" for n in COUNTED))


def summed(rows: DataFrame) -> DataFrame:
    """chunk, range and the corpus totals of every chunk's keys, in their
    order; n_words: distinct training words of the range, on one row."""
    schema = pa.schema([("chunk", pa.int64()), ("range", pa.int32())]
                       + [(n, pa.binary()) for n in COUNTED] + [("n_words", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        got = table.select(["chunk", "range"]).to_pylist()
        n_words = 0
        for kind in KINDS:
            keys = [from_sorted_planes(k.as_py()) for k in table.column(f"{kind}s")]
            ends = np.cumsum([len(k) for k in keys])
            distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
            train = np.zeros(len(distinct))
            for name in (f"{kind}_kept", f"{kind}_tune"):
                own = np.concatenate([uncounts(x.as_py()) for x in table.column(name)])
                total = np.bincount(where, weights=own, minlength=len(distinct))
                train += total
                for r, k, e in zip(got, keys, ends):
                    r[name] = counts(total[where[e - len(k):e]])
            if kind == "word":
                n_words = int((train > 0).sum())
        for i, r in enumerate(got):
            r["n_words"] = n_words if i == 0 else 0
        return pa.Table.from_pylist(got, schema=schema)

    return rows.groupBy("range").applyInArrow(
        run, "chunk long, range int, " + ", ".join(f"{n} binary" for n in COUNTED) + ", n_words long")


class Scored(Chunk):
    """A chunk with the corpus totals of its words and bigrams."""

    def __init__(self, row: dict, totals: list[dict]):
        super().__init__(row)
        totals = sorted(totals, key=lambda r: r["range"])
        self.total = {n: np.concatenate([uncounts(r[n]) for r in totals]).astype(np.float64) for n in COUNTED}

    def counts(self, training: bool, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """c(u, w), c(u), c(w) per distinct bigram, over all training documents
        or those kept.  BEGIN is no token: as a context it comes once per
        document, which ``n_docs`` gives."""
        words, pairs = self.total["word_kept"].copy(), self.total["pair_kept"].copy()
        if training:
            words += self.total["word_tune"]
            pairs += self.total["pair_tune"]
        context = words[self.pair_context]
        context[self.pair_context == self.begin] = n_docs
        return pairs, context, words[self.pair_word]


def _together(cut: DataFrame, totals: DataFrame, fn, schema: str, columns: list[str]) -> DataFrame:
    """``fn(row, Scored)`` -> pa.Table for every chunk."""
    def run(state: pa.Table, totals_: pa.Table) -> pa.Table:
        row = state.to_pylist()[0]
        return fn(row, Scored(row, totals_.to_pylist()))

    return cut.select(*columns).groupBy("chunk").cogroup(
        totals.select("chunk", "range", *COUNTED).groupBy("chunk")).applyInArrow(run, schema)


# ---- weights --------------------------------------------------------------

def deleted_counts(cut: DataFrame, totals: DataFrame, n_docs: int) -> DataFrame:
    """c_pair, c_context, c_word, bucket, n: how often bigrams with these
    remaining counts occur in the deleted part.  The context's count only
    matters through its bucket where the pair is unseen."""
    schema = pa.schema([(n, pa.int64()) for n in ("c_pair", "c_context", "c_word", "bucket", "n")])

    def fn(row: dict, s: Scored) -> pa.Table:
        times = s.counted(s.of(TUNE_FOLD))[1]
        some = times > 0
        c2, cu, cw = (x[some].astype(np.int64) for x in s.counts(False, n_docs))
        bucket = frequency_bucket(cu)
        rows, where = np.unique(np.column_stack([c2, np.where(c2 > 0, cu, 0), cw, bucket]),
                                axis=0, return_inverse=True)
        n = np.bincount(where.ravel(), weights=times[some], minlength=len(rows)).astype(np.int64)
        return pa.table([*(pa.array(rows[:, i]) for i in range(4)), pa.array(n)], schema=schema)

    rows = _together(cut, totals, fn,
                     "c_pair long, c_context long, c_word long, bucket long, n long",
                     ["chunk", "folds", "n_tokens", "words", "tokens"])
    return rows.groupBy("c_pair", "c_context", "c_word", "bucket").agg(F.sum("n").alias("n"))


def learned_weights(counts: DataFrame, n_tokens: int, n_words: int,
                    max_rounds: int = MAX_ROUNDS) -> np.ndarray:
    """(buckets, 3) weights of bigram, unigram and uniform estimates.  Each
    round is one aggregation over the stored counts; a bucket without deleted
    bigrams takes the weights of all buckets together."""
    weights = np.full((FREQUENCY_BUCKETS, 3), 1 / 3)
    weights[0] = [0.0, 0.5, 0.5]
    before = -np.inf
    f2 = F.when(F.col("c_context") > 0, F.col("c_pair") / F.col("c_context")).otherwise(F.lit(0.0))
    f1 = F.col("c_word") / F.lit(float(max(n_tokens, 1)))
    for _ in range(max_rounds):
        a = [F.element_at(F.array(*[F.lit(float(x)) for x in weights[:, k]]),
                          (F.col("bucket") + 1).cast("int")) for k in range(3)]
        parts = [a[0] * f2, a[1] * f1, a[2] / F.lit(float(n_words + 1))]
        mixed_ = counts.select("bucket", "n", *[p.alias(f"p{k}") for k, p in enumerate(parts)])
        total = F.col("p0") + F.col("p1") + F.col("p2")
        got = mixed_.groupBy("bucket").agg(
            *[F.sum(F.col("n") * F.col(f"p{k}") / total).alias(f"e{k}") for k in range(3)],
            F.sum(F.col("n") * F.log(total)).alias("ll")).collect()  # a row per frequency bucket
        if not got:
            return weights
        for r in got:
            e = np.maximum([r["e0"], r["e1"], r["e2"]], 0.0)
            w = np.maximum(e / e.sum(), LEAST_WEIGHT)
            weights[r["bucket"]] = w / w.sum()
        all_ = np.sum([[r["e0"], r["e1"], r["e2"]] for r in got], axis=0)
        for b in set(range(1, FREQUENCY_BUCKETS)) - {r["bucket"] for r in got}:
            weights[b] = np.maximum(all_ / all_.sum(), LEAST_WEIGHT)
            weights[b] /= weights[b].sum()
        now = sum(r["ll"] for r in got)
        if now - before < 1e-5 * abs(now):
            break
        before = now
    return weights


# ---- scores ---------------------------------------------------------------

def scores(docs: DataFrame, chunk_tokens: int = CHUNK) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    cut = stored(chunks(docs, chunk_tokens), "lm-chunks")
    per_doc = cut.select(F.explode(F.arrays_zip("folds", "n_tokens")).alias("d")).select("d.folds", "d.n_tokens")
    training, keeping = F.col("folds") != HELD_OUT_FOLD, ~F.col("folds").isin(HELD_OUT_FOLD, TUNE_FOLD)
    seen = per_doc.agg(*[F.coalesce(F.sum(F.when(m, x)), F.lit(0)).alias(n) for n, m, x in (
        ("every", F.lit(True), F.col("n_tokens")), ("tokens", training, F.col("n_tokens")),
        ("docs", training, F.lit(1)), ("kept_tokens", keeping, F.col("n_tokens")),
        ("kept_docs", keeping, F.lit(1)))]).first()
    ranges = max(1, -(-int(seen["every"]) // RANGE_TOKENS))
    totals = stored(summed(key_rows(cut, ranges)), "lm-totals")
    n_words = totals.agg(F.sum("n_words")).first()[0] or 0
    deleted = stored(deleted_counts(cut, totals, seen["kept_docs"]), "lm-deleted")
    weights = learned_weights(deleted, seen["kept_tokens"], n_words)
    n_tokens, n_docs = int(seen["tokens"]), int(seen["docs"])
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def fn(row: dict, s: Scored) -> pa.Table:
        c2, cu, cw = s.counts(True, n_docs)
        a = weights[frequency_bucket(cu)]
        p = a[:, 0] * c2 / np.maximum(cu, 1) + a[:, 1] * cw / max(n_tokens, 1) + a[:, 2] / (n_words + 1)
        per_pair = {"score": np.log10(p), "n_known": (cw > 0).astype(np.float64),
                    "base_score": np.log10((cw + 1) / (n_tokens + n_words + 1))}
        start = np.cumsum(s.lengths) - s.lengths  # every text has at least its end
        sums = {k: np.add.reduceat(v[s.pair], start) for k, v in per_pair.items()}
        return pa.table([
            pa.array(row["doc_ids"], pa.int64()), pa.array(s.folds == HELD_OUT_FOLD), pa.array(s.lengths),
            pa.array(sums["n_known"].astype(np.int64)), pa.array(np.full(len(s.lengths), n_tokens)),
            pa.array(sums["base_score"]), pa.array(sums["score"])], schema=schema)

    return _together(cut, totals, fn, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                     "train_tokens long, base_score double, score double",
                     ["chunk", "doc_ids", "folds", "n_tokens", "words", "tokens"])
