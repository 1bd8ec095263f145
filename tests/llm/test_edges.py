"""Repeated ids, hot keys, masks, clashing names, very long texts and host
verdicts, each against a direct computation."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import chat_format, neighbours, pii, quality, simhash, warc
from meterlake.llm import queries as Q

CLASH = ["row", "vec", "dim", "band", "block", "chunk", "score", "rank", "query_id", "message", "seq", "event", "nth", "key",
         "digest", "holder", "payload", "copy", "record", "turns", "shared", "main", "formatted"]


def clashing(df):
    return df.select("*", *[F.lit(n).alias(c) for n, c in enumerate(CLASH) if c not in df.columns])


# ---- 2 --------------------------------------------------------------------

def test_repeated_ids_are_rows_of_their_own(spark):
    rng = np.random.default_rng(3)
    vecs = rng.standard_normal((600, 8))
    ids = [int(i) if i % 7 else None for i in rng.integers(0, 150, 600)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vecs)], "vec_id long, embedding array<double>")
    got = neighbours.searched(neighbours.usable(clashing(df)), F.col("vec_id") % 20 == 0, verify=1.0).collect()
    want = []
    for q, i in enumerate(ids):
        if i is None or i % 20:
            continue
        score = vecs @ vecs[q]
        other = [j for j in range(600) if j != q]
        other.sort(key=lambda j: (-score[j], ids[j] is None, ids[j] or 0))
        want += [(i, r, ids[j], round(float(score[j]), 9)) for r, j in enumerate(other[:20], 1)]
    assert sorted(((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got), key=str) == sorted(want, key=str)


# ---- 8 --------------------------------------------------------------------

def brute_components(fps, bits):
    up = list(range(len(fps)))

    def root(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    a = np.array(fps, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= bits):
            x, y = root(i), root(int(j))
            up[max(x, y)] = min(x, y)
    groups = {}
    for i, f in enumerate(fps):
        groups.setdefault(root(i), set()).add(f)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("block,one_of", [(40, 1), (100, 4), (8192, 64)])
def test_a_hot_key_in_blocks_gives_the_same_components(spark, block, one_of):
    """Fingerprints that share two segments, so one key holds them all, beside
    random ones and near copies of these."""
    rng = np.random.default_rng(6)
    shared = [int(x) << 43 | 0x3A5F1C2B7D1 for x in rng.choice(1 << 20, 1500, replace=False)]
    other = [int(x) for x in rng.integers(0, 1 << 62, 300)]
    near = [x ^ (1 << int(b)) for x, b in zip(other, rng.integers(0, 62, 300))]
    fps = list(dict.fromkeys(shared + other + near))
    df = spark.createDataFrame([(f,) for f in fps], "fp long").repartition(6)
    large = simhash.large_keys(df, block, one_of).collect()
    assert bool(large) == (block < 8192)
    most = simhash.grouped(df, block, one_of).groupBy("key", "left", "right", "kind").count().agg(F.max("count")).first()[0]
    assert block == 8192 or most <= 3 * block
    member = simhash.components(simhash.links(df, 3, block, one_of)).collect()
    groups = {f: {f} for f in fps}
    found = {}
    for r in member:
        found.setdefault(r.root, {r.root}).add(r.node)
    for g in found.values():
        for f in g:
            groups[f] = g
    assert {frozenset(g) for g in groups.values()} == brute_components(fps, 3)


# ---- 9 --------------------------------------------------------------------

def test_hosts_are_judged_by_their_own_documents(spark):
    """60 hosts fail 8 % of the time, others 2, 5, 10 and 12 times as often: a
    host goes only where most of its documents surely fail."""
    good, bad = "one two three four five six seven eight nine ten eleven", "too short"
    rates = {f"h{i:02d}": 0.08 for i in range(60)} | {"x2": 0.16, "x5": 0.40, "x10": 0.80, "x12": 0.96}
    rows, n = [], 200
    for host, rate in rates.items():
        rows += [(len(rows) + i, bad if i < rate * n else good, host) for i in range(n)]
    rows += [(len(rows), bad, "once"), (len(rows) + 1, good, "mixed"), (len(rows) + 2, bad, "mixed")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = quality.quality_report(docs).collect()
    gone = {r.host for r in out if not r.kept and not r.failed}
    assert gone == {"x10", "x12"}
    assert all(r.kept == (not r.failed) for r in out if r.host not in gone)
    # The same from the formulas.
    count = {}
    for r in out:
        count.setdefault(r.host, []).append(r.failed)
    total, f, h = len(out), sum(map(sum, count.values())), len(count)
    m = f / total
    ff = sum(sum(v) ** 2 / len(v) for v in count.values())
    excess = max(max(ff / total - m * m, 0) - m * (1 - m) * h / total, 1e-12)
    s = min(max(m * (1 - m) / excess - 1, 1), total / h)
    for r in out:
        k, d = sum(count[r.host]), len(count[r.host])
        p = (k + m * s) / (d + s)
        assert abs(r.shrunk_rate - p) < 1e-12
        assert abs(r.sure_rate - (p - 1.645 * (p * (1 - p) / (d + s + 1)) ** 0.5)) < 1e-12


def test_alike_hosts_do_not_hide_a_bad_one(spark):
    """A thousand documents of equal hosts leave no variance between them."""
    good, bad = "one two three four five six seven eight nine ten eleven", "too short"
    rows = [(i, bad if i % 10 == 0 else good, f"h{i // 100}") for i in range(5000)]
    rows += [(5000 + i, bad if i else good, "junk") for i in range(100)]
    out = quality.quality_report(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r.host for r in out.where("NOT kept AND NOT failed").collect()} == {"junk"}


# ---- 1 --------------------------------------------------------------------

def test_loss_texts_follow_the_mask(spark):
    rows = [(1, 0, "user", "héllo <|im_end|> 😀"), (1, 1, "assistant", "so <|x <\\| 𝔘 ok"), (1, 2, "user", ""), (1, 3, "assistant", None),
            (2, 0, "assistant", "a" * 300_000 + "<|"), (2, 1, "<|odd\n", "x")]
    turns = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = chat_format.formatted(chat_format.turn_log(turns))
    got = {r.conv_id: r.t for r in out.select("conv_id", chat_format.under_loss(
        F.col("formatted"), F.col("loss_runs")).alias("t")).collect()}
    assert got == {1: ["", rows[1][3], "", ""], 2: [rows[4][3], ""]}
    # One code point off, and the text is another: the mask is what is read.
    off = F.transform("loss_runs", lambda r: F.struct((r["head"] + 1).alias("head"), r["body"].alias("body"),
                                                      r["tail"].alias("tail"), r["loss"].alias("loss")))
    moved = out.where("conv_id = 2").select(chat_format.under_loss(F.col("formatted"), off).alias("t")).first().t
    assert moved[0] != rows[4][3]


# ---- 7 --------------------------------------------------------------------

def test_warc_long_payload_and_clashing_names(spark):
    long = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 200_000
    rows = [(1, "http://a", long), (2, "http://b", long), (3, "http://c", "short"), (4, None, None), (5, "http://d", "short")]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
           for r in warc.resolved(warc.archived(pages)).collect()}
    for i, _, html in rows:
        raw = (html or "").encode()
        assert got[i] == (len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if i == 2 else "response", 1 if i == 2 else None)


# ---- 10 -------------------------------------------------------------------

def test_pii_long_text_with_thousands_of_spans(spark):
    text = " ".join(f"write u{i}@ex{i % 50}.org or 10.0.{i % 256}.{i % 250} now" for i in range(4_000))
    docs = spark.createDataFrame([(1, text), (2, "nothing here")], "doc_id long, text string")
    r = {x.doc.doc_id: x for x in pii.found(docs).collect()}
    spans = [(s.kind, s.start, s.end) for s in r[1].spans]
    mail = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert [s for s in spans if s[0] == "email"] == [("email", m.start(), m.end()) for m in mail.finditer(text)]
    assert len([s for s in spans if s[0] == "ip"]) == 4_000 and not r[2].spans
    clean = {x.doc_id: x.text for x in pii.sanitised(docs).collect()}
    assert "@ex" not in clean[1] and "10.0." not in clean[1] and clean[2] == "nothing here"


def test_queries_keep_their_columns(spark):
    sf = "/root/testdata/sf0.001"
    assert Q.QUERIES["op2_collision_neighbours"](spark, sf).columns == ["query_id", "rank", "vec_id", "score"]
    assert Q.QUERIES["op1_chat_format"](spark, sf).columns == [
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
