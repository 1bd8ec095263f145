"""Personal data: patterns plus information-theoretic sanitisation (operator
10).  DataFrame functions only.

Base spans are pattern matches (email, ip, card, phone), leftmost and
non-overlapping per kind, with failing matches dropped.  They also are the
protected entities: from the whole corpus the operator counts documents with
an entity e, with a term t and with both, and measures what t gives away of e:

    IC(e) = -log2 p(e)      PMI(e; t) = log2 p(e, t) / (p(e) p(t))

A term exceeds the disclosure thresholds if, for an entity, PMI >= ``min_bits``,
PMI / IC >= ``min_share`` and the pair was seen in at least ``min_texts``
different texts.  It is removed if it occurs with that entity only (share 1),
else generalised to a placeholder: with ``everywhere`` (as the registered query
and the pipeline have it) in every document, since it gives the entity away
also where the entity is not written next to it; without, in documents that
hold the entity.  Since PMI
never exceeds IC, entities with IC < ``min_bits`` (an address in every
footer) need no pairs, which is exact and bounds what one entity can bring.
Copies are collapsed by text digest before pairing and keep their number, so
counts cover every document.

Terms are runs of at least ``min_letters`` letters, lower-cased, outside base
spans.

Defined results: null text has no spans and stays null; empty text has none;
repeated rows are treated alike; a very long text is one cell and searched
whole; an empty table gives an empty table; extra
columns ride along in one struct, so their names never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import col, stored, whole_row

# The kinds in report order and what they match.  Written so
# that no attempt starts inside a run that was already tried and no group is
# re-entered, which keeps matching linear on any text.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]",
          "generalise": "[TERM]", "remove": ""}

MIN_BITS = 6.0
MIN_SHARE = 0.9
MIN_TEXTS = 3
MIN_LETTERS = 3
LETTERS = r"\p{L}+"
NOT_LETTERS = r"\P{L}+"


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: an expression named inside
    a lambda would be computed anew for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running_sum(values: Column) -> Column:
    """Prefix sums of an array, in blocks: appending to an array copies it, so
    the cost of one long array is kept near n * block instead of n * n."""
    block = 256

    def sums(xs: Column, start: Column) -> Column:
        first = F.struct(start.cast("long").alias("s"), F.array().cast("array<bigint>").alias("a"))
        return F.aggregate(xs, first, lambda acc, x: F.struct(
            (acc["s"] + x).alias("s"), F.concat(acc["a"], F.array(acc["s"] + x)).alias("a")),
            lambda acc: acc["a"])

    def cut(xs: Column) -> Column:
        return F.transform(
            F.when(F.size(xs) > 0, F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / block).cast("int")))
            .otherwise(F.array().cast("array<int>")), lambda b: F.slice(xs, b * block + 1, block))

    def joined(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + x))
        before = F.zip_with(sums(totals, F.lit(0)), totals, lambda end, own: end - own)
        return F.flatten(F.zip_with(blocks, before, sums))

    return bound(values, lambda xs: bound(cut(xs), joined))


def starts_of(gaps: Column, matches: Column) -> Column:
    """Code-point start of each match, from the texts between (``gaps``, one
    more than matches) and the matches themselves.  The last entry, one more,
    is where the text ends."""
    def lengths(xs: Column) -> Column:
        return F.transform(xs, lambda x: F.length(x).cast("long"))

    earlier = F.concat(F.array(F.lit(0).cast("long")), lengths(matches))
    return running_sum(F.zip_with(lengths(gaps), earlier, lambda gap, match: gap + match))


def located(matches: Column, starts: Column, kind: str) -> Column:
    """array<struct<kind, start, end, value>>."""
    return F.zip_with(matches, F.slice(starts, F.lit(1), F.size(matches)), lambda m, s: F.struct(
        F.lit(kind).alias("kind"), s.alias("start"), (s + F.length(m)).alias("end"), m.alias("value")))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.split(F.reverse(digits), "")
    marks = F.transform(back, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(marks, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                        & (F.substring(F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))), -3, 3)
                           .cast("int") <= 255))
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def may_hold(kind: str, text: Column) -> Column:
    """Cheap necessary condition, so most texts skip the extraction."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return F.rlike(text, F.lit({"ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
                                "card": r"[0-9](?:[\x20-]?[0-9]){15}"}[kind]))


def with_base_spans(docs: DataFrame, text: str = "text", as_col: str = "spans") -> DataFrame:
    """``docs`` plus array<struct<kind, start, end, value>> by kind as listed,
    then start."""
    t = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<string>")
    step = docs.withColumns(
        {f"_m_{k}": F.when(may_hold(k, t), F.regexp_extract_all(t, F.lit(p), F.lit(0))).otherwise(none)
         for k, p in PATTERNS.items()})
    step = step.withColumns(
        {f"_g_{k}": F.when(F.size(f"_m_{k}") > 0, F.split(t, p, -1)).otherwise(none)
         for k, p in PATTERNS.items()})
    step = step.withColumns(
        {f"_s_{k}": F.when(F.size(f"_m_{k}") > 0, starts_of(F.col(f"_g_{k}"), F.col(f"_m_{k}")))
         .otherwise(F.array().cast("array<bigint>")) for k in KINDS})

    def spans(kind: str) -> Column:
        return F.filter(located(F.col(f"_m_{kind}"), F.col(f"_s_{kind}"), kind),
                        lambda s: valid(kind, s["value"]))

    parts = [spans(k) for k in KINDS]
    return step.withColumn(as_col, F.concat(*parts)).drop(
        *[f"_{x}_{k}" for x in "mgs" for k in KINDS])


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def n_of(kind: str, spans: Column) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def terms_of(text: Column, min_letters: int) -> Column:
    words = F.array_distinct(F.split(F.lower(text), NOT_LETTERS))
    return F.filter(words, lambda w: F.length(w) >= min_letters)


def disclosing(rows: DataFrame, hits: DataFrame, min_bits: float, min_share: float,
               min_texts: int, min_letters: int, everywhere: bool = False) -> DataFrame:
    """digest, generalise, remove: the terms of each text in ``hits`` (digest,
    text, spans), or ``everywhere`` in ``rows``, that exceed the thresholds,
    from all of ``rows`` (text)."""
    n_docs = rows.count()
    texts = stored(hits.groupBy("digest").agg(
        F.first("text").alias("text"), F.first("spans").alias("spans"),
        F.count("*").alias("weight")), "texts-with-entities")
    entities = F.array_distinct(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["value"])))
    held = texts.select("digest", "weight", "text", "spans", F.explode(entities).alias("entity"))
    per_entity = held.groupBy("entity").agg(F.sum("weight").alias("n_e"))
    ic = F.log2(F.lit(float(max(n_docs, 1))) / F.col("n_e"))
    secret = stored(per_entity.select("entity", "n_e", ic.alias("ic")).where(F.col("ic") >= min_bits),
                    "entities")
    bare = F.aggregate("spans", F.col("text"), lambda t, s: F.replace(t, s["value"], F.lit(" ")))
    pairs = stored(held.select("digest", "weight", "entity", terms_of(bare, min_letters).alias("terms"))
                   .join(secret, "entity")
                   .select("digest", "weight", "entity", "n_e", "ic", F.explode("terms").alias("term")),
                   "pairs")
    together = pairs.groupBy("entity", "term").agg(
        F.sum("weight").alias("n_et"), F.count("*").alias("n_texts"),
        F.first("n_e").alias("n_e"), F.first("ic").alias("ic")).where(F.col("n_texts") >= min_texts)
    # Documents of a term outside base spans: those of the whole texts, put
    # right by the terms that differ without the spans, so rows are read once.
    raw, rest = terms_of(F.col("text"), min_letters), terms_of(bare, min_letters)

    def times(terms: Column, n: Column) -> Column:
        return F.transform(terms, lambda t: F.struct(t.alias("term"), n.alias("n")))

    changes = texts.select("weight", raw.alias("raw"), rest.alias("rest")).select(F.explode(F.concat(
        times(F.array_except("raw", "rest"), -F.col("weight")),
        times(F.array_except("rest", "raw"), F.col("weight")))).alias("x")).select("x.*")
    per_term = (rows.select(F.explode(raw).alias("term")).withColumn("n", F.lit(1).cast("long"))
                .unionByName(changes).groupBy("term").agg(F.sum("n").alias("n_t")))
    pmi = F.log2(F.col("n_et") * F.lit(float(max(n_docs, 1))) / (F.col("n_e") * F.greatest("n_t", "n_et")))
    told = stored(
        per_term.join(stored(together, "together"), "term")
        .select("entity", "term", pmi.alias("pmi"), (pmi / F.col("ic")).alias("share"))
        .where((F.col("pmi") >= min_bits) & (F.col("share") >= min_share)), "disclosing")
    whole = F.col("share") >= 1 - 1e-9
    if everywhere:  # terms inside base spans may come along; they get no spans of their own
        terms = stored(told.groupBy("term").agg(F.max(whole).alias("whole")), "disclosing-terms")
        told_in = (rows.select(F.md5("text").alias("digest"),
                               F.explode(terms_of(F.col("text"), min_letters)).alias("term"))
                   .join(terms, "term"))
    else:
        told_in = pairs.join(told, ["entity", "term"]).withColumn("whole", whole)
    return (told_in.groupBy("digest", "term").agg(F.max("whole").alias("whole"))
            .groupBy("digest").agg(
                F.collect_list(F.when(~F.col("whole"), F.col("term"))).alias("generalise"),
                F.collect_list(F.when(F.col("whole"), F.col("term"))).alias("remove")))


def with_term_spans(hits: DataFrame) -> DataFrame:
    """``hits`` (text, spans, generalise, remove) with the term spans added."""
    any_term = F.size(F.concat("generalise", "remove")) > 0
    words = hits.withColumn("_w", F.when(any_term, F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0)))
                            .otherwise(F.array().cast("array<string>")))
    words = words.withColumn("_s", F.when(F.size("_w") > 0, starts_of(
        F.split("text", LETTERS, -1), F.col("_w"))).otherwise(F.array().cast("array<bigint>")))

    def of(kind: str) -> Column:
        found = F.filter(located(F.col("_w"), F.col("_s"), kind),
                         lambda s: F.array_contains(F.col(kind), F.lower(s["value"])))
        return F.filter(found, lambda s: ~F.exists(
            "spans", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))

    return words.withColumn("more", F.concat(of("generalise"), of("remove"))).drop("_w", "_s")


def rebuilt(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind's label; spans that
    overlap are replaced as one, under the label of the first."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")

    def add(kept: Column, s: Column) -> Column:
        last = F.element_at(kept, -1)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
                         last["kind"].alias("kind"))
        return F.when((F.size(kept) > 0) & (F.get(kept, F.size(kept) - 1)["end"] > s["start"]),
                      F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(grown))) \
            .otherwise(F.concat(kept, F.array(s)))

    merged = F.aggregate(order, empty, add)
    label = F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv])

    def join(kept: Column) -> Column:
        parts = F.transform(kept, lambda s, i: F.concat(
            F.substring(text, (F.coalesce(F.get(kept, i - 1)["end"], F.lit(0)) + 1).cast("int"),
                        (s["start"] - F.coalesce(F.get(kept, i - 1)["end"], F.lit(0))).cast("int")),
            label[s["kind"]]))
        tail = F.substring(text, (F.element_at(kept, -1)["end"] + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(parts, ""), tail)

    return F.when(F.size(spans) > 0, F.element_at(F.transform(F.array(merged), join), 1)).otherwise(text)


def found(docs: DataFrame, text_col: str = "text", min_bits: float = MIN_BITS,
          min_share: float = MIN_SHARE, min_texts: int = MIN_TEXTS,
          min_letters: int = MIN_LETTERS, everywhere: bool = False) -> DataFrame:
    """doc (struct of the input row), text, spans (base), more (the method's)
    per row.  Only rows with base spans are stored; the others come from a
    second scan and, with ``everywhere``, meet the texts that hold a disclosing
    term there."""
    rows = docs.select(whole_row(docs).alias("doc"), col(docs, text_col).alias("text"))
    spanned = with_base_spans(rows)
    hits = stored(spanned.where(F.size("spans") > 0).withColumn("digest", F.md5("text")), "pii-hits")
    terms = stored(disclosing(rows.select("text"), hits, min_bits, min_share, min_texts, min_letters,
                              everywhere), "pii-terms")
    none = F.array().cast("array<string>")

    def with_more(some: DataFrame) -> DataFrame:
        joined = (some.join(terms, "digest", "left")
                  .withColumns({k: F.coalesce(F.col(k), none) for k in ("generalise", "remove")}))
        return with_term_spans(joined).select("doc", "text", "spans", "more")

    clean = spanned.where(F.size("spans") == 0)
    clean = (with_more(clean.withColumn("digest", F.md5("text"))) if everywhere
             else clean.select("doc", "text", "spans", F.col("spans").alias("more")))
    return with_more(hits).unionAll(clean)


def sanitised(docs: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """``docs`` with masked texts (and ``n_chars``, where there is such a
    column, brought up to date); ``how`` as in ``found``."""
    out = found(docs, text_col, **how).withColumn(
        "clean", rebuilt(F.col("text"), F.concat("spans", "more")))
    changed = F.size(F.concat("spans", "more")) > 0
    return out.select(*[
        (F.col("clean") if c == text_col
         else F.when(changed, F.length("clean")).otherwise(F.col("doc").getField(c))
         .cast(docs.schema[c].dataType) if c == "n_chars"
         else F.col("doc").getField(c)).alias(c) for c in docs.columns])
