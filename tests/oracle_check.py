"""Run registered queries in Spark and their oracle SQL in DuckDB; compare
like the driver does (column names sorted, row count, order-insensitive
value hash).  Usage: python tests/oracle_check.py [sf_dir] [key ...]"""

from __future__ import annotations

import hashlib
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from meterlake.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, con, sf_dir, key, fn, sql, verbose=True):
    t = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    ts = time.time() - t
    res = {"key": key, "spark_rows": len(srows), "spark_sec": round(ts, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res["oracle_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"COLUMNS {sorted(scols)} vs {sorted(dcols)}"
        return res
    hs, ls = digest(scols, srows)
    hd, ld = digest(dcols, drows)
    if hs == hd:
        res["status"] = "ok"
    else:
        res["status"] = "MISMATCH"
        if verbose:
            a, b = set(ls), set(ld)
            res["only_spark"] = sorted(a - b)[:3]
            res["only_oracle"] = sorted(b - a)[:3]
            res["cols"] = sorted(scols)
    return res


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    keys = argv[2:]
    import __spark_entry__ as E
    from meterlake.session import get_spark
    spark = get_spark()
    con = duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in (keys or list(qs)):
        try:
            r = compare(spark, con, sf, k, qs[k], sqls.get(k))
        except Exception as e:  # noqa: BLE001
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{bad} failing of {len(keys or qs)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
