"""Scalar Column functions (all JVM-side, codegen-friendly).

Each mirrors a pandas/NumPy idiom of the reference with its exact null
semantics; see the notes per function.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted numeric text: what pandas.to_numeric parses.  Spark's cast also
# accepts '1.0d' / '1.0f', which pandas rejects, hence the guard.
NUMERIC_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
# Text tokens that mean "missing" after upper-casing and stripping.
NULL_TOKENS = ["NAN", "NA", "NONE", "NULL", ""]
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
EPS = 1e-6


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


INF_TEXT = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"]
WHITESPACE = " \t\n\x0b\x0c\r"


def to_double_or_null(c: str | Column) -> Column:
    """H1: text -> DOUBLE; unparsable and NaN -> NULL.

    ``try_cast`` also accepts Java literal suffixes ('1.0d', '2f') that
    pandas rejects; only text that parsed *and* contains a d/f needs the
    check (inf spellings are the legitimate ones), so the common path is one
    cast and two byte searches, no regex."""
    c = col(c)
    v = c.try_cast("double")
    low = F.lower(c)
    suspicious = (F.instr(low, "d") > 0) | (F.instr(low, "f") > 0)
    ok = ~suspicious | F.btrim(low, F.lit(WHITESPACE)).isin(*INF_TEXT)
    return F.when(ok & ~F.isnan(v), v)


def to_timestamp_or_null(c: str | Column, *formats: str) -> Column:
    """H2: text -> TIMESTAMP_NTZ with explicit formats; unparsable -> NULL."""
    c = col(c)
    fmts = formats or (TS_FORMAT,)
    parsed = [F.try_to_timestamp(c, F.lit(f)) for f in fmts]
    v = parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)
    return v.cast("timestamp_ntz")


def truncate_to_long(c: str | Column) -> Column:
    """H3: DOUBLE -> BIGINT truncating toward zero (pandas astype(int64))."""
    return col(c).try_cast("bigint")


def normalize_text(c: str | Column) -> Column:
    """H4: upper-case and strip surrounding whitespace (the ASCII set of
    Python ``str.strip``; Spark's ``trim`` alone strips spaces only)."""
    return F.upper(F.btrim(col(c), F.lit(WHITESPACE)))


def null_tokens(c: str | Column, tokens=NULL_TOKENS) -> Column:
    """H5: token list -> NULL."""
    c = col(c)
    return F.when(~c.isin(*tokens), c)


def flag(cond: Column) -> Column:
    """H9: boolean -> 0/1 INT, NULL compares false."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def cyclic(c: str | Column, period: float) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*x/period."""
    a = F.lit(2 * math.pi) * col(c) / F.lit(float(period))
    return F.sin(a), F.cos(a)


def safe_ratio(a: str | Column, b: str | Column, eps: float = EPS) -> Column:
    """A / (b + eps); NULL instead of an ANSI divide error."""
    return F.try_divide(col(a), col(b) + F.lit(eps))


def run_name(prefix: str, ts: Column | None = None) -> Column:
    """H15: '<prefix>_yyyyMMdd_HHmmss'."""
    ts = ts if ts is not None else F.current_timestamp()
    return F.concat(F.lit(prefix + "_"), F.date_format(ts, "yyyyMMdd_HHmmss"))


def weekday_mon0(ts: str | Column) -> Column:
    """Monday = 0 ... Sunday = 6 (pandas dt.dayofweek)."""
    return F.weekday(col(ts))
