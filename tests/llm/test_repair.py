"""Repair against exhaustive dynamic programming, with blocks of every size."""

import hashlib
import random
import zlib

import duckdb
import pytest

from meterlake.llm import queries as Q
from meterlake.llm import repair as R

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
TURNS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def brute(rows):
    """(cost, audit, repaired turns) of rows (role, text) by trying, row by row,
    every state with its least (cost, audit)."""
    seen, faults = set(), []
    for role, text in rows:
        bare = text.strip(SPACE)
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "k")
        seen.add((role, text))
    states = {"": (0, "", ())}  # last kept initial -> (cost, audit, turns)

    def better(table, state, entry):
        if state not in table or entry[:2] < table[state][:2]:
            table[state] = entry

    def inserted(table):
        for _ in range(2):
            for s, (c, a, t) in list(table.items()):
                new = "a" if s == "u" else "u"
                better(table, new, (c + 5, a + "I", t + (("assistant" if new == "a" else "user", ""),)))
        return table

    for (role, text), fault in zip(rows, faults):
        now = {}
        for s, (c, a, t) in inserted(dict(states)).items():
            better(now, s, (c + 2, a + "D", t))
            if fault in "bd":
                continue
            extra = 5 if fault == "t" else 0
            new = "a" if s == "u" else "u"
            better(now, new, (c + 1 + extra, a + "R", t + (("assistant" if new == "a" else "user", text),)))
            if role[:1] == new or (role[:1] == "s" and s == ""):
                better(now, role[:1], (c + extra, a + "K", t + ((role, text),)))
        states = now
    end = inserted(dict(states))
    cost, audit, turns = min(v for s, v in end.items() if s in ("", "a"))
    return cost, audit, turns, faults


def brute_report(convs):
    """{conv_id: [(turn, role, text)] in order}"""
    out = []
    for c, rows in convs.items():
        cost, audit, turns, faults = brute([r[1:] for r in rows])
        known = [r[0] for r in rows if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        text = "\n".join(f"{r}:{t}" for r, t in turns)
        out.append((c, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def ordered(rows):
    """Rows as the operator orders them, per conversation."""
    convs = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " ")):
        convs.setdefault(c, []).append((turn, " " if role is None else role, " " if text is None else text))
    return convs


def damaged(rows):
    out = []
    for c, turn, role, text in rows:
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(x for x in text if x not in ".!?")
        elif kind == 4:
            role = "user"
        out += [(c, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def some(n, longest, seed):
    rng = random.Random(seed)
    return [(c, t + rng.randrange(2), rng.choice(["user", "assistant", "assistant", "system", "tool", ""]),
             rng.choice(["Yes.", f"No {t}!", "cut", " \n", f"Well {t}?", "é"]))
            for c in range(n) for t in range(rng.randrange(longest))]


@pytest.mark.parametrize("block", [256, 1, 3])
def test_blocks_of_every_size(spark, monkeypatch, block):
    monkeypatch.setattr(R, "BLOCK", block)
    rows = some(80, 12, block)
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    got = R.report(R.edits(df))
    assert got.columns == COLUMNS
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_report(ordered(rows))


def test_search_matches_dynamic_programming():
    rng = random.Random(7)
    for _ in range(400):
        rows = [(rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b.", "c", "d!", ""]))
                for _ in range(rng.randrange(9))]
        cost, audit, _, faults = brute(rows)
        codes = [("x" if r[0] not in "sua" else r[0]) + f for (r, _), f in zip(rows, faults)]
        parts, cut = [], rng.randrange(1, 4)
        for i in range(0, len(codes), cut):
            parts.append(R.block_paths("".join(codes[i:i + cut]), i == 0))
        states = R.joined([[p[:4] for p in b] for b in parts])
        got = "".join(next(p[4] for p in b if p[:2] == s) for b, s in zip(parts, states))
        got += R.closing(states[-1][1] if states else R.START)
        assert got == audit
        total = sum(next(p[2] for p in b if p[:2] == s) for b, s in zip(parts, states))
        assert total + 5 * len(R.closing(states[-1][1] if states else R.START)) == cost


def test_query_matches_sql_and_brute_force(spark):
    rows = [tuple(r) for r in Q.read(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    out = Q.QUERIES["op13_conversation_repair"](spark, SF)
    assert out.columns == COLUMNS
    got = sorted([tuple(r) for r in out.collect()], key=str)
    want = {r[0]: r for r in brute_report(ordered(damaged(rows)))}
    empty = hashlib.sha256(b"").hexdigest()
    assert got == sorted([want.get(c, (c, 0, 0, 0, 0, 0, 0, "", empty)) for c in {r[0] for r in rows}], key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    sql = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({Q.ORACLE['op13_conversation_repair']})").fetchall()
    assert sorted(sql, key=str) == got


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, "user", "Hi."), (1, 3, "assistant", "x" * 1_000_000 + "."), (1, 3, "assistant", "Yes."),
            (None, 0, "user", "a."), (None, 1, "assistant", "b."), (2, 0, "", "a."), (3, 5, "system", "s."), (3, 9, "user", "u."),
            (4, 0, "user", "same."), (4, 1, "user", "same."), (4, 2, "user", "same."), (5, 0, "user", None)]
    df = spark.createDataFrame(rows, TURNS)
    for name in ("pos", "code", "block", "mark", "initial", "kind", "edit", "place", "before", "fault"):
        df = df.selectExpr("*", f"'{name}' AS {name}")
    got = R.report(R.edits(df)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_report(ordered(rows))
    assert R.report(R.edits(df.limit(0))).count() == 0
    turns = R.repaired(df).where("conv_id = 3").orderBy("place").collect()
    assert [(r.role, r.text) for r in turns] == [("user", "s."), ("assistant", "u.")]


def test_one_hot_conversation(spark, monkeypatch):
    """A conversation of a third of all rows over many blocks and partitions."""
    rng = random.Random(3)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"{t}{rng.choice(['.', ''])}") for t in range(3000)]
    rows += [(c, t, "user", f"{t}.") for c in range(100, 700) for t in range(4)]
    df = spark.createDataFrame(rows, TURNS).repartition(6)
    got = {r.conv_id: tuple(r) for r in R.report(R.edits(df)).where("conv_id = 7").collect()}
    assert got[7] == brute_report(ordered(rows[:3000]))[0]
