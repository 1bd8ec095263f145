"""The trie against one built turn by turn, with blocks of every size."""

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from meterlake.llm import prefix_trie as T
from meterlake.llm import queries as Q
from meterlake.llm.order import numbered, text_order

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string"


def brute(convs):
    """{conv_id: [(role, text)]} -> sorted node rows."""
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    rows = []
    for p, who in members.items():
        below = [q for q in members if q[:len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in members)]
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(p))
        rows.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(kids), len(leaves),
                     sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q),
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def conversations(rows):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}


def got(df):
    assert df.columns == COLUMNS
    return sorted([tuple(r) for r in df.collect()], key=str)


def some(n, seed, letters="ab", longest=6):
    rng = random.Random(seed)
    return [(c, t, "user", rng.choice(letters) * (1 + (c % 3 == 0)))
            for c in range(n) for t in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("most,most_bytes", [(4096, 4 << 20), (1, 1 << 20), (3, 1 << 20), (4096, 1), (2, 60)])
def test_blocks_of_every_size(spark, most, most_bytes):
    """Nodes within blocks, over many blocks, and copies cut apart by blocks."""
    rows = some(60, most) + [(1000 + c, t, "user", "a") for c in range(40) for t in range(3)]
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    out = T.trie(T.sequences(T.placed(df)), most, most_bytes)
    assert got(out) == brute(conversations(rows))


def test_query_matches_sql_and_brute_force(spark):
    rows = [tuple(r) for r in Q.read(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    convs = conversations(rows)
    built = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = convs.get(c - c % 5, [])[:h] + convs[c][h:]
    want = got(Q.QUERIES["op12_prefix_trie"](spark, SF))
    assert want == brute(built)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    sql = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({Q.ORACLE['op12_prefix_trie']})").fetchall()
    assert sorted(sql, key=str) == want


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, None, None), (1, 0, "user", ""), (2, 0, "user", "é" * 3), (2, 0, "user", "a"),
            (3, 0, "user", "a"), (3, 1, "user", "x" * 2_000_000), (4, 0, "user", "a"), (None, 0, "user", "a"),
            (-7, 5, "tool", "a"), (5, 0, "us", "era"), (6, 0, "use", "ra")]
    df = spark.createDataFrame(rows, TURNS)
    for name in ("pos", "key", "member", "digest", "size", "part", "at", "n", "top", "depth", "items", "block"):
        df = df.selectExpr("*", f"'{name}' AS {name}")
    assert got(T.prefix_trie(df)) == brute(conversations(rows))
    assert T.prefix_trie(df.limit(0)).count() == 0


def test_turnless_conversations_are_members_of_the_root(spark):
    from pyspark.sql import functions as F

    rows = [(1, 0, "user", "a"), (7, 0, "user", "b"), (8, 0, "user", "c"), (8, 1, "user", "d")]
    df = spark.createDataFrame(rows, TURNS)
    base = T.branched(df, shared=F.lit(1), base=F.lit(99).cast("long"))
    out = got(T.trie(T.sequences(base)))
    assert out == brute({1: [], 7: [], 8: [("user", "d")]})
    alone = T.trie(T.sequences(T.branched(df.where("conv_id = 1"), F.lit(1), F.lit(99).cast("long"))))
    assert got(alone) == brute({1: []})


def test_one_conversation_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK_TURNS", 4)
    rows = [(c, t, "user", "x") for c in (1, 2) for t in range(50 + c)]
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    assert got(T.prefix_trie(df)) == brute(conversations(rows))


def test_range_minimum_extents():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64, 65):
        values = rng.integers(0, 4, n)
        t = T.RangeMin(values)
        for at in range(n):
            for depth in range(5):
                r = at
                while r + 1 < n and values[r + 1] >= depth:
                    r += 1
                left = at
                while left > 0 and values[left] >= depth:
                    left -= 1
                one = np.array([at]), np.array([depth])
                assert t.right(*one)[0] == r and t.left(*one)[0] == left
            z = np.arange(at, n)
            assert t.least(np.full(len(z), at), z).tolist() == [values[at:k + 1].min() for k in z]


def test_places_of_a_hot_group(spark):
    """A group over many partitions is numbered as one, its neighbours too."""
    from pyspark.sql import functions as F

    rows = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id") % 40).alias("g"),
                                      F.hash("id").cast("string").alias("t"))
    rows = rows.unionByName(spark.range(50).select(F.lit(None).cast("long").alias("g"), F.col("id").cast("string").alias("t")))
    out = numbered(rows, "g", [F.col("t")], "t")
    want = [(r.g, r.t) for r in rows.collect()]
    want.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    place, expected = collections.Counter(), []
    for g, t in want:
        expected.append((g, t, place[g]))
        place[g] += 1
    assert sorted([tuple(r) for r in out.select("g", "t", "pos").collect()], key=str) == sorted(expected, key=str)
    assert len(text_order()) == 3
