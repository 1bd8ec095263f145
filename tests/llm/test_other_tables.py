"""Brute-force checks of the operators on other tables, and the pipeline."""

import gzip
import hashlib
import io

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from meterlake.llm import chat_format, neighbours, token_counts, warc
from meterlake.llm import queries as Q
from meterlake.llm.encode import WordEncoder, default_tokenizer
from meterlake.llm.rollup import Rollup, no_state, state
from meterlake.session import scratch_path

from .conftest import ODD_ROWS

SF = "/root/testdata/sf0.001"

# ---- 1: chat --------------------------------------------------------------

LOG = "conv_id long, message struct<turn:long,nth:int>, seq int, event string, role string, text string"


def log_of(spark, rows):
    return spark.createDataFrame(rows, LOG).withColumn("block", chat_format.block_of(F.col("message.turn")))


def test_fold_applies_edits_and_regenerations(spark):
    rows = [(1, (0, 1), 0, "open", "user", None), (1, (0, 1), 1, "delta", None, "helo"),
            (1, (0, 1), 2, "edit", None, "hello"), (1, (0, 1), 3, "delta", None, " there"),
            (1, (1, 1), 0, "open", "assistant", None), (1, (1, 1), 1, "delta", None, "wrong"),
            (1, (1, 1), 2, "regenerate", None, None), (1, (1, 1), 4, "delta", None, "ht"),
            (1, (1, 1), 3, "delta", None, "rig"), (2, (0, 1), 5, "delta", None, "orphan"),
            (3, (0, 1), 0, "open", None, None), (None, (0, 1), 0, "open", "user", None),
            (3, (None, 1), 0, "open", "system", None)]
    got = {(r.conv_id, r.message.turn): (r.role, r.text)
           for r in chat_format.folded(log_of(spark, rows)).collect()}
    assert got == {(1, 0): ("user", "hello there"), (1, 1): ("assistant", "right"), (2, 0): ("", "orphan"),
                   (3, 0): ("", ""), (None, 0): ("user", ""), (3, None): ("system", "")}


def test_template_is_reversible(spark):
    texts = ["", "<|im_end|>", "<\\|", "<\\\\|", "<", "|", "<<|im_start|>>", "a<\\b", "\\", "é<|𝔘", "\n\n", "x<"]
    rows = [(1, (i, 1), 0, "open", role, None) for i, role in enumerate(["us<er\\n", "a\nb", "assistant"] * 4)]
    rows += [(1, (i, 1), 1, "delta", None, t) for i, t in enumerate(texts)]
    out = chat_format.formatted(log_of(spark, rows)).select(
        "*", chat_format.parsed(F.col("formatted")).alias("turns")).first()
    assert [t.text for t in out.turns] == texts
    assert [t.role for t in out.turns] == ["us<er\\n", "a\nb", "assistant"] * 4
    assert out.formatted.count("<|im_start|>") == out.formatted.count("<|im_end|>") == len(texts)
    at, lost = 0, []
    for run in out.loss_runs:
        body = out.formatted[at + run.head:at + run.head + run.body]
        lost += [body] if run.loss else []
        at += run.head + run.body + run.tail
    assert at == len(out.formatted)
    assert [x.replace("<\\", "<") for x in lost] == texts[2::3]


def test_chat_long_tied_and_empty(spark):
    turns = spark.createDataFrame(
        [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(1500)]
        + [(2, 0, "user", "same")] * 3 + [(2, 0, None, None)], "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat_format.formatted(chat_format.turn_log(turns)).collect()}
    assert out[1].n_turns == 1500 and out[1].formatted.index("t2<") < out[1].formatted.index("t1400<")
    assert out[2].n_turns == 4
    assert chat_format.formatted(chat_format.turn_log(turns.limit(0))).count() == 0


def test_chat_runs_no_python(spark):
    plan = Q.QUERIES["op1_chat_format"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


# ---- 2: neighbours --------------------------------------------------------

def brute_nearest(ids, vecs, queries, k):
    out = {}
    for q in queries:
        others = ids != ids[q]
        score = vecs[others] @ vecs[q]
        first = np.lexsort((ids[others], -score))[:k]
        out[int(ids[q])] = list(zip(ids[others][first].tolist(), score[first].tolist()))
    return out


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(0)
    centre = rng.standard_normal((20, 24))
    vecs = (centre[rng.integers(0, 20, 3000)] + rng.standard_normal((3000, 24))) * rng.uniform(0.2, 3, (3000, 1))
    vecs = vecs.astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "vec_id long, embedding array<float>")
    got = neighbours.searched(neighbours.usable(df), F.col("vec_id") % 20 == 0, block=1000, chunk=64).collect()
    want = brute_nearest(np.arange(3000), vecs, range(0, 3000, 20), 20)
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == set(want)
    hits = 0
    for q, rows in found.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21))
        assert all(abs(s - vecs[v] @ vecs[q]) < 1e-9 for _, v, s in rows)
        hits += len({v for _, v, _ in rows} & {v for v, _ in want[q]})
    assert hits / (20 * len(want)) >= 0.9


def test_one_longer_vector_costs_no_recall(spark):
    """At the production block size, vectors that are not clustered."""
    rng = np.random.default_rng(0)
    vecs = rng.standard_normal((16_384, 64))
    vecs /= np.linalg.norm(vecs, axis=1)[:, None]
    vecs[5] *= 5
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.searched(neighbours.usable(df), F.col("vec_id") % 512 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute_nearest(np.arange(len(vecs)), vecs, range(0, len(vecs), 512), 20)
    assert sum(len(found[q] & {v for v, _ in rows}) for q, rows in want.items()) / (20 * len(want)) >= 0.95


def test_norm_blocks_share_only_what_is_verified():
    places, spans = neighbours.norm_blocks(
        [(2, 5, 2500), (2, 0, 100), (2, 1, 150), (2, 9, 3), (3, 1, 10)], 1000, 250)
    assert places == [(2, 0, 0, 1), (2, 1, 0, 1), (2, 5, 1, 3), (2, 9, 4, 1), (3, 1, 5, 1)]
    assert spans == [(2, 0, 4), (3, 5, 5)] and neighbours.norm_blocks([], 1000, 250) == ([], [])


def test_neighbours_odd_vectors(spark):
    same = [1.0, 2.0]
    rows = ([(i, same) for i in range(30)] + [(0, [9.0, 9.0])]
            + [(40, None), (41, [0.0, 0.0]), (42, [1.0, None]), (43, [float("nan"), 1.0]), (None, same),
               (44, [float("inf"), 1.0]), (45, []), (60, [1.0, 2.0, 3.0]), (61, [-1.0, 2.0, 3.0])])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.searched(neighbours.usable(df), F.col("vec_id") % 20 == 0).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank, r.score)):
        by.setdefault(r.query_id, []).append(r.vec_id)
    # Rows that share an id are candidates and queries of their own.
    assert sorted(by[0]) == sorted(list(range(20)) * 2) and by[20] == [0, *range(19)]
    assert by[60] == [61] and set(by) == {0, 20, 60}
    assert neighbours.searched(neighbours.usable(df.limit(0)), F.col("vec_id") % 20 == 0).count() == 0


def test_candidates_by_few_countings(monkeypatch):
    """From whatever width the search begins, the candidates are those of the
    first windows that hold enough; a block's later queries are counted at few
    widths."""
    rng = np.random.default_rng(1)
    vecs = np.concatenate([rng.standard_normal((900, 16)), np.ones((100, 16))])
    part = neighbours.Block(np.arange(1000), vecs, 96)
    widths = neighbours.FIRST_WIDTH * neighbours.GROWTH ** np.arange(28)
    centres = part.centres(vecs[::20])
    at = np.column_stack([vecs / np.linalg.norm(vecs, axis=1).max(), np.zeros(1000)])
    at[:, -1] = np.sqrt(np.maximum(0.0, 1.0 - (at * at).sum(axis=1)))
    at = at @ part.lines
    calls = []
    counts = neighbours.Block.counts
    monkeypatch.setattr(neighbours.Block, "counts", lambda self, *a: calls.append(1) or counts(self, *a))
    near = 0
    for i, centre in enumerate(centres):
        def ends(w, i=i):
            low, span = part.windows(centres[i:i + 1], widths[w])
            return low[0], span[0]

        for need in (250, 990):
            plain = [((at >= centre - w) & (at <= centre + w)).sum(axis=1) for w in widths]
            first = next((c for c in plain if (c >= 72).sum() >= need), None)
            want = range(1000) if first is None else np.flatnonzero(first >= np.sort(first)[-need])
            for start in (0, 13, 27):
                assert part.candidates(ends, 28, need, 72, start)[0].tolist() == list(want)
    last = len(calls)
    for i in range(50):  # each from the last one's width
        near = part.candidates(lambda w: tuple(x[i] for x in part.windows(centres, widths[w])), 28, 250, 72, near)[1]
    assert len(calls) - last <= 50 * 4


# ---- 5: rollup ------------------------------------------------------------

def test_rollup_batches_are_idempotent(spark):
    new = state(F.lit("s"), F.lit("en"), F.lit("v1"), F.col("id") + 1)
    newer = state(F.lit("s"), F.lit("en"), F.lit("v2"), F.lit(10))
    gone = no_state()
    rows = spark.range(5)
    path = scratch_path(spark, "rollup-test")
    rollup = Rollup(spark, path)
    assert rollup.totals().count() == 0
    assert rollup.commit("1", rows.select(gone.alias("old"), new.alias("new")))
    assert not rollup.commit("1", rows.select(gone.alias("old"), new.alias("new")))
    rollup.commit("2", rows.where("id < 2").select(new.alias("old"), newer.alias("new")))
    rollup.commit("3", rows.where("id = 4").select(new.alias("old"), gone.alias("new")))
    rollup.commit("4", rows.limit(0).select(new.alias("old"), gone.alias("new")))
    got = {tuple(r) for r in Rollup(spark, path).totals().collect()}
    assert got == {("s", "en", "v1", 2, 3 + 4), ("s", "en", "v2", 2, 20)}
    # A batch that broke off has no success marker: it is not read, and written anew.
    folder = rollup._path(f"{path}/batch=3/_SUCCESS")
    rollup._fs.delete(folder, False)
    assert ("s", "en", "v1", 3, 12) in {tuple(r) for r in rollup.totals().collect()}
    assert rollup.commit("3", rows.where("id = 4").select(new.alias("old"), gone.alias("new")))
    assert {tuple(r) for r in rollup.totals().collect()} == got


def test_token_rollup_matches_brute_force(spark):
    enc = WordEncoder(default_tokenizer()).tokenizer
    want, seen = {}, set()
    for r in Q.read(spark, SF, "documents").orderBy("doc_id").collect():
        if r.text in seen:
            continue
        seen.add(r.text)
        n, t = want.get((r.source, r.lang), (0, 0))
        want[r.source, r.lang] = (n + 1, t + len(enc.encode(r.text, add_special_tokens=False).ids))
    got = {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in Q.QUERIES["op5_token_rollup"](spark, SF).collect()}
    assert got == want


def test_token_rollup_odd_rows(odd, none):
    got = {(r.source, r.lang): r.n_docs for r in token_counts.maintained(odd).totals().collect()}
    # (5, null source) is a later copy of (4, 'a'); null and empty texts are equal.
    assert got == {(None, None): 1, ("a", "en"): 2, ("b", "fr"): 1, ("b", "de"): 1, ("c", "en"): 1}
    assert token_counts.maintained(none).totals().count() == 0


def test_token_rollup_tells_deleted_copies(spark, odd, tmp_path):
    """Totals and deleted copies together count all documents by source and lang."""
    def whole(rows):
        out = {}
        for r in rows:
            for x in [r, *r.deleted]:
                n, t = out.get((x.source, x.lang), (0, 0))
                out[x.source, x.lang] = (n + x.n_docs, t + x.n_tokens)
        return out

    enc = WordEncoder(default_tokenizer()).tokenizer
    want = {}
    for r in Q.read(spark, SF, "documents").collect():
        n, t = want.get((r.source, r.lang), (0, 0))
        want[r.source, r.lang] = (n + 1, t + len(enc.encode(r.text, add_special_tokens=False).ids))
    assert whole(Q.QUERIES["op5_token_rollup"](spark, SF).collect()) == want
    got = whole(token_counts.maintained(odd).totals(deleted=True).collect())
    assert {k: n for k, (n, _) in got.items()} == {
        (r.source, r.lang): r["count"] for r in odd.groupBy("source", "lang").count().collect()}
    # Batches written before there was such a column have none.
    spark.createDataFrame([("s", "en", "v", 2, 9)], "source string, lang string, tokenizer string, d_docs long, "
                          "d_tokens long").write.parquet(f"{tmp_path}/old/batch=1")
    old = Rollup(spark, f"{tmp_path}/old").totals(deleted=True)
    assert [tuple(r) for r in old.collect()] == [("s", "en", "v", 2, 9, [])]


# ---- 7: WARC --------------------------------------------------------------

def test_warc_round_trip(spark):
    long_ = "<p>" + "x\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(3, "http://a/%0A", long_), (2, "http://b/\nc", long_), (9, None, long_), (4, "u", "small"),
            (5, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", "é𝔘" * 200), (8, "u", "é𝔘" * 200),
            (None, "n", "other" * 50)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    made = warc.archived(df)
    kept = {r.page_id: r for r in made.collect()}
    assert kept[2].main.uri == "http://b/\nc" and kept[3].main.uri == "http://a/%0A"
    assert bytes(kept[2].main.payload).decode() == long_ and len(kept[3].main.payload) == 0
    assert len(kept[4].requests) == len(kept[4].metadata) == 1
    got = sorted(((r.page_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to)
                  for r in warc.resolved(made).collect()), key=str)
    size, sha = len(long_.encode()), hashlib.sha256(long_.encode()).hexdigest()
    by = {}
    for g in got:
        by.setdefault(g[0], []).append(g[1:])
    assert by[2] == [("response", size, sha, None)]
    assert by[3] == by[9] == [("revisit", size, sha, 2)]
    assert by[4][0][0] == by[5][0][0] == "response"
    assert by[6] == by[7] == [("response", 0, hashlib.sha256(b"").hexdigest(), None)]
    assert sorted(x[0] for x in by[8]) == ["response", "revisit"] and {x[3] for x in by[8]} == {None, 8}
    assert by[None][0][0] == "response"
    assert warc.resolved(warc.archived(df.limit(0))).count() == 0


def test_warc_files_parse_by_length(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([(1, "u", "a\r\n\r\nb")], "page_id long, url string, payload string"), path)
    files = [bytes(r.content) for r in spark.read.format("binaryFile").option(
        "pathGlobFilter", "part-*").load(path).collect()]
    records = [r for f in files for r in warc.parse(gzip.GzipFile(fileobj=io.BytesIO(f)))]
    assert sorted(r["type"] for r in records) == ["metadata", "request", "response"]
    main = next(r for r in records if r["type"] == "response")
    assert main["payload"] == b"a\r\n\r\nb" and {r["concurrent_to"] for r in records} == {None, main["record_id"]}


# ---- pipeline -------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = Q.read(spark, SF, "documents")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = scratch_path(spark, "pipe")
        stage(spark, docs, SF).write.parquet(out)
        docs = spark.read.parquet(out)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.where("start = 0").count() == sizes[4]
    assert corpus_pipeline.run(spark, SF).count() == pieces.count()


def test_pipeline_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = scratch_path(spark, "pipe")
            stage(spark, docs, SF).write.parquet(out)
            docs = spark.read.parquet(out)
            assert docs.columns == odd.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= 0
    assert len(ODD_ROWS) == 9
