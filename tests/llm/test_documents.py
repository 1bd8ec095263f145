"""Brute-force checks of the operators on documents."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import lm, mixing, packing, pii, quality, simhash
from meterlake.llm import queries as Q
from meterlake.llm.encode import WordEncoder, default_tokenizer

from .conftest import ODD_ROWS

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


# ---- 9: quality -----------------------------------------------------------

def brute_stats(text):
    t, w = text or "", words(text)
    windows = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    repeated = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t),
            len(lines) - len(set(lines)), len(repeated))


def test_text_stats_match_brute_force(spark):
    texts = [r[0] for r in Q.read(spark, SF, "documents").select("text").collect()]
    texts += ["a b c d e a b c d e", "x\n x\nx\n\nx", "a b c d a b c d a b c d a b c d", "# <b> |\r\n#", "", None]
    for t in texts:
        assert quality.text_stats(t) == brute_stats(t)


def test_bad_host_is_rejected_and_clean_hosts_stay(spark):
    good, bad = "one two three four five six seven eight nine ten eleven", "too short"
    rows = [(i, good, "en", f"h{i % 4}", 1) for i in range(40)]
    rows += [(100 + i, bad, "en", "junk", 1) for i in range(60)] + [(200, good, "en", "junk", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == set(range(40))
    report = {r.doc.doc_id: r for r in quality.quality_report(docs).collect()}
    assert report[200].failed is False and report[200].kept is False and report[200].shrunk_rate > 0.8


def test_quality_odd_rows(odd, none):
    out = quality.quality_report(odd)
    assert out.count() == len(ODD_ROWS)
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    assert quality.keep_good(none).count() == 0 and quality.quality_report(none).count() == 0


# ---- 3: mixing ------------------------------------------------------------

def brute_targets(sizes, limit=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > limit * sizes[s]}
        if not over:
            target.update({s: unit * weight[s] for s in free})
            break
        for s in over:
            target[s] = limit * sizes[s]
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 5, None: 70}, {"a": 1}, {"a": 0, "b": 0}, {"a": 7, "b": 0, "c": 9000, "d": 3},
    {f"s{i:02}": (i * 7919) % 1000 + 1 for i in range(25)}])
def test_targets_match_resharing(spark, sizes):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = brute_targets(sizes)
    assert set(got) == set(want)
    for s in want:
        assert math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9)


def test_mix_takes_near_targets_and_is_stable(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 50 + 1), "en", f"s{i % 5}", 1) for i in range(6000)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    plan = mixing.mix_plan(docs)
    per = plan.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"),
                                     F.first("target").alias("target")).collect()
    for r in per:
        assert abs(r.taken - r.target) < 0.06 * r.target
    assert plan.where("copies > 3").count() == 0
    one = sorted(r.doc_id for r in mixing.mixed(docs).collect())
    assert one == sorted(r.doc_id for r in mixing.mixed(docs.repartition(7)).collect())


def test_mix_odd_rows(odd, none):
    out = mixing.mixed(odd)
    assert out.dtypes == odd.dtypes
    assert mixing.mix_plan(odd).count() == len(ODD_ROWS)
    assert mixing.mixed(none).count() == 0


# ---- 4: packing -----------------------------------------------------------

def test_ids_equal_the_tokenizer():
    enc = WordEncoder(default_tokenizer())
    texts = [r[1] for r in ODD_ROWS[:8]] + ["don't I'LL it's. x.y., a.. ..", "<|ENDOFTEXT|> A<|endoftext|>B",
                                            "É é Σς ªº ﬁ 가 日本 12 3a", "é \x85 \xa0x", "A.B, C."]
    flat, n = enc.ids([None if t is None else t.encode() for t in texts])
    at = 0
    for t, k in zip(texts, n):
        assert flat[at:at + k].tolist() == enc.tokenizer.encode(t or "", add_special_tokens=False).ids
        at += k
    assert enc.lengths([None if t is None else t.encode() for t in texts]).tolist() == n.tolist()


def check_packing(rows, texts, size):
    enc = WordEncoder(default_tokenizer()).tokenizer
    by_doc = collections.defaultdict(list)
    by_seq = collections.defaultdict(list)
    for r in rows:
        assert len(r.ids) == r.length <= size
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for doc_id, text in texts.items():
        ids = enc.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted(by_doc[doc_id], key=lambda r: r.start)
        assert [i for r in own for i in r.ids] == ids
        assert all(r.doc_tokens == len(ids) for r in own)
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
    padding = 0
    for own in by_seq.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        used = sum(r.length for r in own)
        assert used <= size
        padding += size - used
    return padding / (len(by_seq) * size)


def test_packing_is_whole_and_dense(spark):
    docs = Q.read(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert check_packing(packing.packed(docs, size=512).collect(), texts, 512) < 0.03


def test_packing_odd_rows(odd, none):
    out = packing.packed(odd, size=64)
    assert out.where("doc_id = 4").agg(F.sum("length")).first()[0] == 2 * out.where("doc_id = 5").agg(
        F.sum("length")).first()[0]
    check_packing(packing.packed(odd.dropDuplicates(["doc_id"]), size=64).collect(),
                  {r[0]: r[1] for r in ODD_ROWS}, 64)
    assert out.where("doc_id = 2").agg(F.sum("length")).first()[0] == 1
    assert packing.packed(none).count() == 0


@pytest.mark.parametrize("histogram", [{5: 3}, {10: 1, 1: 100}, {7: 10, 3: 9, 2: 1, 1: 4}, {}])
def test_patterns_cover_the_histogram(histogram):
    made = collections.Counter()
    for lengths, packs in packing.shortest_pack_first(histogram, 10):
        assert sum(lengths) <= 10 and packs > 0
        for x in lengths:
            made[x] += packs
    assert made == collections.Counter(histogram)


# ---- 8: SimHash -----------------------------------------------------------

def brute_fp(text):
    import xxhash
    w = [x.lower() for x in words(text)]
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, bits=3):
    up = list(range(len(ids)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                up[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        r = root(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [least.get(root(i)) for i in range(len(ids))]


def test_simhash_matches_brute_force(spark):
    rows = Q.read(spark, SF, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in Q.QUERIES["op8_simhash_near_dedup"](spark, SF).collect()}
    ids, fps = [r.doc_id for r in rows], [brute_fp(r.text) for r in rows]
    for d, fp, c in zip(ids, fps, brute_components(ids, fps)):
        assert got[d].fingerprint == f"{fp:016x}" and got[d].component_id == c


def test_links_join_every_near_pair(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    fps = set(base.tolist())
    for b in base:  # chains and dense balls
        x = int(b)
        for _ in range(rng.integers(0, 25)):
            for bit in rng.integers(0, 64, rng.integers(1, 4)):
                x ^= 1 << int(bit)
            fps.add(x)
    fps |= {int(base[0]) ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(i)}
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = {r.fp: r.root for r in simhash.groups(
        spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    want = brute_components(signed, fps)
    assert [got[x] for x in signed] == want


def test_golay_keys_meet_within_one_bit():
    rng = np.random.default_rng(1)
    w = rng.integers(0, 1 << 23, 5000)
    flipped = w ^ (1 << rng.integers(0, 23, len(w)))
    near = simhash.near_indices(w)
    assert (near == simhash.golay_index(flipped)[:, None]).any(axis=1).all()
    assert set(np.unique((near >= 0).sum(axis=1))) <= {1, 6}


def test_simhash_odd_rows(odd, none):
    out = simhash.near_duplicates(odd).collect()
    assert len(out) == len(ODD_ROWS)
    by = collections.defaultdict(set)
    for r in out:
        by[r.doc_id].add((r.fp, r.component_id))
    assert by[1] == by[2] == by[3] == {(0, 1)}
    kept = simhash.keep_one(odd)
    assert kept.dtypes == odd.dtypes
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect() if r.doc_id in (1, 2, 3, 4, 5)) \
        == [(False, 1), (False, 4)]
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


# ---- 10: personal data ----------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    def luhn(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            x = int(c) * (1 + i % 2)
            total += x - 9 if x > 9 else x
        return total % 10 == 0

    def good(kind, v):
        d = re.sub("[^0-9]", "", v)
        return (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in v.split("."))
                or kind == "card" and 16 <= len(d) <= 19 and luhn(d) or kind == "phone" and 8 <= len(d) <= 15)
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "")
            if good(k, m.group())]


def test_base_spans_match_brute_force(spark):
    import random
    rnd = random.Random(3)
    parts = ["a", "B", "0", "1", "5", "255", "256", ".", "@", "-", "+", " ", "%", "(", ")", "é", "𝔘", "_", "\n",
             "4111 1111 1111 1111", "4111111111111111", " 10.0.0.1", "x@y.z", "+1 (555) 123-4567"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    texts += [None, "", "a@b.c%d@e.f", "1.2.3.4.5.6.7.8", "0001.2.3.4 999999999999.1.1.1", "5" * 30_000,
              "a" * 50_000 + "@", "a@" * 20_000, "+1" * 20_000, "1." * 20_000]
    texts += [r.text for r in Q.read(spark, SF, "documents").select("text").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.with_base_spans(df).select("doc_id", "spans").collect():
        assert [(s.kind, s.start, s.end) for s in r.spans] == brute_spans(texts[r.doc_id])


def secret_corpus():
    rows = [(i, f"plain talk about ordinary things number {'abcdefgh'[i % 8] * 3}", "en", "s", 0)
            for i in range(1000)]
    for i in range(4):  # 'zanzibarcode' only with this address; 'plain' everywhere
        rows[i] = (i, f"plain zanzibarcode note {'qwer'[i] * 4} mail kim{7}@host.example today", "en", "s", 0)
    rows[9] = (9, "zanzibar plain and clean", "en", "s", 0)
    return rows


def test_disclosing_terms(spark):
    docs = spark.createDataFrame(secret_corpus(), "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in pii.sanitised(docs).collect()}
    assert len(out) == 1000
    for i in range(4):
        assert "zanzibarcode" not in out[i].text and "[EMAIL]" in out[i].text and "plain" in out[i].text
        assert out[i].n_chars == len(out[i].text)
    assert out[9].text == "zanzibar plain and clean"
    assert all(out[i].text == secret_corpus()[i][1] for i in range(10, 1000))
    found = {r.doc.doc_id: r for r in pii.found(docs).collect()}
    text = secret_corpus()[0][1]
    more = [(s.kind, text[s.start:s.end]) for s in found[0].more]
    assert ("remove", "zanzibarcode") in more and not any(t == "plain" for _, t in more)


def test_generalised_and_removed(spark):
    rows = secret_corpus()
    rows[500] = (500, "a zanzibarcode elsewhere", "en", "s", 0)  # 4 of 5: share below 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r.text for r in pii.sanitised(docs, min_share=0.5).collect()}
    assert out[0].startswith("plain [TERM] ") and out[500] == rows[500][1]


def test_disclosing_terms_go_from_every_document(spark, tmp_path):
    """In the registered query and the pipeline, also where the entity is not."""
    from corpus_pipeline import pii_stage
    rows = secret_corpus()
    rows[500] = (500, "a Zanzibarcode elsewhere, zanzibarcode", "en", "s", 0)
    rows[501] = (501, "a zanzibarcode elsewhere with other@host.example", "en", "s", 0)
    rows[502] = (502, None, "en", "s", 0)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in pii_stage(spark, docs, None).collect()}
    assert len(out) == 1000 and out[502].text is None
    assert out[0].text.startswith("plain [TERM] ") and out[500].text == "a [TERM] elsewhere, [TERM]"
    assert out[501].text == "a [TERM] elsewhere with [EMAIL]" and out[500].n_chars == len(out[500].text)
    assert all(out[i].text == rows[i][1] for i in range(10, 1000) if i not in (500, 501))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.spans for r in Q.QUERIES["op10_pii"](spark, str(tmp_path)).collect()}
    assert got[500] == "generalise:2:14,generalise:26:38" and got[10] == ""


def test_terms_inside_base_spans_do_not_count(spark):
    """A name in other people's addresses is masked there and hides nothing."""
    rows = secret_corpus()
    for i in range(500, 520):
        rows[i] = (i, f"plain note to zanzibarcode.x{i}@host.example", "en", "s", 0)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r.text for r in pii.sanitised(docs, everywhere=True).collect()}
    assert all("zanzibarcode" not in out[i] and "[TERM]" not in out[i] for i in range(4))
    assert all(out[i] == "plain note to [EMAIL]" for i in range(500, 520))


def test_running_sum_blocks(spark):
    n = 1000
    got = spark.range(1).select(pii.running_sum(F.sequence(F.lit(1), F.lit(n)).cast("array<bigint>"))).first()[0]
    assert got == np.cumsum(np.arange(1, n + 1)).tolist()
    assert spark.range(1).select(pii.running_sum(F.array().cast("array<bigint>"))).first()[0] == []


def test_overlapping_spans_are_one(spark):
    text = "call +10.20.30.40 now"  # a phone number that holds an address
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.sanitised(docs).first().text == "call [PHONE] now"


def test_pii_odd_rows(odd, none):
    out = pii.sanitised(odd)
    assert out.dtypes == odd.dtypes
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")
    assert sorted(map(key, out.collect())) == sorted(map(key, odd.collect()))
    assert pii.sanitised(none).count() == 0


def test_pii_query_digest(spark):
    texts = {r.doc_id: r.text for r in Q.read(spark, SF, "documents").select("doc_id", "text").collect()}
    for r in Q.QUERIES["op10_pii"](spark, SF).collect():
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in brute_spans(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert r.spans.startswith(want)


def test_pii_runs_no_python(spark):
    for made in (pii.found(Q.read(spark, SF, "documents")), pii.sanitised(Q.read(spark, SF, "documents"))):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- 6: language model ----------------------------------------------------

def brute_lm(texts):
    toks = {d: [x.lower() for x in words(t)] + [b"\n"] for d, t in texts.items()}
    fold = {d: zlib.crc32(str(d).encode()) % 7 for d in texts}
    train = collections.Counter(w for d in texts if fold[d] != 2 for w in toks[d])
    return toks, fold, train


def test_lm_base_is_exact_and_model_is_better(spark):
    docs = Q.read(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    toks, fold, train = brute_lm(texts)
    n, v = sum(train.values()), len(train)
    got = {r.doc_id: r for r in lm.scores(docs, chunk_tokens=5000).collect()}
    assert set(got) == set(texts)
    for d, r in got.items():
        base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in toks[d])
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (
            len(toks[d]), sum(train[w] > 0 for w in toks[d]), n, fold[d] == 2)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    again = {r.doc_id: r.score for r in lm.scores(docs, chunk_tokens=70_000).collect()}
    assert all(math.isclose(again[d], r.score, rel_tol=1e-6) for d, r in got.items())


def test_lm_matches_a_direct_model(spark):
    """The scores follow from the counts and the learned weights."""
    rows = [(i, t, None, None, None) for i, t in enumerate(
        ["a b a b c", "a b", "", None, "b c b", "a c a b a", "c", "a b c a", "b b b", "a a b"] * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    texts = {r[0]: r[1] for r in rows}
    toks, fold, train = brute_lm(texts)
    n, v = sum(train.values()), len(train)

    def pairs(keep):
        c = collections.Counter()
        for d in texts:
            if keep(fold[d]):
                c.update(zip([b"^"] + toks[d][:-1], toks[d]))
        return c

    def uni(keep):
        c = collections.Counter(w for d in texts if keep(fold[d]) for w in toks[d])
        c[b"^"] = sum(keep(fold[d]) for d in texts)
        return c
    kept, tune = lambda f: f not in (2, 3), lambda f: f == 3
    k2, k1, t2 = pairs(kept), uni(kept), pairs(tune)
    nk = sum(c for w, c in k1.items() if w != b"^")
    counts = collections.Counter()
    for (u, w), times in t2.items():
        counts[(k2[u, w], k1[u], k1[w])] += times
    weights = np.full((48, 3), 1 / 3)
    weights[0] = [0, 0.5, 0.5]
    before = -np.inf
    for _ in range(lm.MAX_ROUNDS):
        e, ll = collections.defaultdict(lambda: np.zeros(3)), 0.0
        for (c2, cu, cw), times in counts.items():
            b = cu.bit_length()
            p = weights[b] * [c2 / cu if cu else 0, cw / nk, 1 / (v + 1)]
            e[b] += times * p / p.sum()
            ll += times * math.log(p.sum())
        for b in range(1, 48):
            x = e[b] if b in e else sum(e.values())
            w = np.maximum(x / x.sum(), lm.LEAST_WEIGHT)
            weights[b] = w / w.sum()
        if ll - before < 1e-5 * abs(ll):
            break
        before = ll
    a2, a1 = pairs(lambda f: f != 2), uni(lambda f: f != 2)
    for r in lm.scores(docs).collect():
        want = 0.0
        for u, w in zip([b"^"] + toks[r.doc_id][:-1], toks[r.doc_id]):
            x = weights[a1[u].bit_length()]
            want += math.log10(x[0] * (a2[u, w] / a1[u] if a1[u] else 0) + x[1] * a1[w] / n + x[2] / (v + 1))
        assert math.isclose(r.score, want, rel_tol=1e-6), (r, want)


def test_lm_odd_rows(odd, none):
    out = lm.scores(odd).collect()
    assert len(out) == len(ODD_ROWS)
    assert all(r.n_tokens == 1 for r in out if r.doc_id in (1, 2, 3))
    assert lm.scores(none).count() == 0


def test_planes_round_trip():
    rng = np.random.default_rng(0)
    for top in (1, 200, 70_000, 2**40, 2**63):
        x = rng.integers(0, top, 77).astype(np.uint64)
        assert (lm.unplanes(lm.planes(x)) == x).all() and (lm.uncounts(lm.counts(x)) == x).all()
        assert (lm.from_sorted_planes(lm.sorted_planes(np.sort(x))) == np.sort(x)).all()
    assert len(lm.unplanes(lm.planes(np.zeros(0, np.uint64)))) == 0
    assert lm.range_edges(np.array([0, 2**63, 2**64 - 1], np.uint64), 2).tolist() == [0, 1, 3]
