"""Fitted transformers K1-K12 as parameter tables.

``fit`` runs distributed aggregations and returns a small parameter table
``(group, feature, stat, category, value)`` — its size is bounded by the
number of features and ``MAX_CATEGORIES``, not by the data — which is collected to
build one ``select`` (``apply``).  A nominal column of more categories has its
numbers in a table of their own and becomes one sparse vector.  Output column names follow the reference's
``group__column`` convention.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake import schema as S
from meterlake.operators.clean import present
from meterlake.operators.quantile import quantiles

MAX_CATEGORIES = 10_000
PARAM_SCHEMA = "group string, feature string, stat string, category string, value double"


@dataclass
class Preprocessor:
    """Fitted parameters of the four-group column transformer."""
    num_skew: list[str]
    num_lin: list[str]
    cat_nom: list[str]
    cat_ord: list[str]
    medians: dict[str, float] = field(default_factory=dict)
    mins: dict[str, float] = field(default_factory=dict)
    maxs: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)
    ordinal: dict[str, list[str]] = field(default_factory=dict)
    # Nominal columns of more than MAX_CATEGORIES: (categories, folder of their numbers).
    sparse: dict[str, tuple[int, str]] = field(default_factory=dict)

    # ---------------------------------------------------------------- table form
    def to_table(self, spark) -> DataFrame:
        rows = []
        for g, cols in (("num_skew", self.num_skew), ("num_lin", self.num_lin)):
            for c in cols:
                rows += [(g, c, "median", None, self.medians.get(c)),
                         (g, c, "min", None, self.mins.get(c)), (g, c, "max", None, self.maxs.get(c))]
        for c in self.cat_nom:
            rows.append(("cat_nom", c, "mode", self.modes.get(c), None))
            rows += [("cat_nom", c, "category", v, float(i)) for i, v in enumerate(self.categories.get(c, []))]
            if c in self.sparse:
                rows.append(("cat_nom", c, "numbers", self.sparse[c][1], float(self.sparse[c][0])))
        for c in self.cat_ord:
            rows.append(("cat_ord", c, "mode", self.modes.get(c), None))
            rows += [("cat_ord", c, "level", v, float(i)) for i, v in enumerate(self.ordinal[c])]
        return spark.createDataFrame(rows, PARAM_SCHEMA)

    @classmethod
    def from_table(cls, params: DataFrame) -> Preprocessor:
        p = cls([], [], [], [])
        for r in params.orderBy("group", "feature", "stat", "value").collect():
            g, c = r["group"], r["feature"]
            lst = getattr(p, g)
            if c not in lst:
                lst.append(c)
            if r["stat"] == "median":
                p.medians[c] = r["value"]
            elif r["stat"] == "min":
                p.mins[c] = r["value"]
            elif r["stat"] == "max":
                p.maxs[c] = r["value"]
            elif r["stat"] == "mode":
                p.modes[c] = r["category"]
            elif r["stat"] == "category":
                p.categories.setdefault(c, []).append(r["category"])
            elif r["stat"] == "numbers":
                p.sparse[c] = (int(r["value"]), r["category"])
            elif r["stat"] == "level":
                p.ordinal.setdefault(c, []).append(r["category"])
        return p

    # ---------------------------------------------------------------- apply
    def columns(self) -> list[Column]:
        out = []
        for c in self.num_skew:
            x = F.log1p(impute(F.col(c).cast("double"), self.medians[c]))
            x = F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)
            out.append(minmax(x, self.mins[c], self.maxs[c]).alias(f"num_skew__{c}"))
        for c in self.num_lin:
            x = impute(F.col(c).cast("double"), self.medians[c])
            out.append(minmax(x, self.mins[c], self.maxs[c]).alias(f"num_lin__{c}"))
        for c in self.cat_nom:
            if c in self.sparse:
                out.append(F.col(f"_{c}_onehot").alias(f"cat_nom__{c}"))
                continue
            x = F.coalesce(F.col(c), F.lit(self.modes[c]))
            out += onehot_drop_first(x, c, self.categories.get(c, []))
        for c in self.cat_ord:
            x = F.coalesce(F.col(c), F.lit(self.modes[c]))
            out.append(ordinal(x, self.ordinal[c]).alias(f"cat_ord__{c}"))
        return out

    def output_names(self) -> list[str]:
        names = [f"num_skew__{c}" for c in self.num_skew] + [f"num_lin__{c}" for c in self.num_lin]
        for c in self.cat_nom:
            names += [f"cat_nom__{c}"] if c in self.sparse else [
                f"cat_nom__{c}_{v}" for v in self.categories.get(c, [])[1:]]
        return names + [f"cat_ord__{c}" for c in self.cat_ord]

    def transform(self, df: DataFrame, keep: Sequence[str] = (S.ROW_ID,)) -> DataFrame:
        """A column of very many categories becomes one sparse vector (``onehot_sparse``)
        by a join with its numbers; all others are expressions."""
        kept = present(df, keep)
        for c, (n, path) in self.sparse.items():
            codes = df.sparkSession.read.parquet(path)
            filled = F.coalesce(F.col(c).cast("string"), F.lit(self.modes[c]))
            df = _joined_codes(df.withColumn(f"_{c}_value", filled), f"_{c}_value", codes, f"_{c}_code")
            df = df.withColumn(f"_{c}_onehot", sparse_vector(F.col(f"_{c}_code"), n))
        return df.select(*kept, *self.columns())


def impute(x: Column, value: float | None) -> Column:
    """K1 apply: NULL -> fitted median."""
    return x if value is None else F.coalesce(x, F.lit(float(value)))


def minmax(x: Column, lo: float | None, hi: float | None) -> Column:
    """K4 apply: (x - min) / (max - min); a constant column has scale 1, so it
    becomes x - min; no clipping."""
    if lo is None or hi is None:
        return F.lit(None).cast("double")
    if hi == lo:
        return x - F.lit(float(lo))
    return (x - F.lit(float(lo))) / F.lit(float(hi - lo))


def onehot_drop_first(x: Column, name: str, categories: list[str]) -> list[Column]:
    """K5 apply: alphabetical categories, first dropped, unknown -> all zeros."""
    return [F.coalesce(x == F.lit(v), F.lit(False)).cast("double").alias(f"cat_nom__{name}_{v}")
            for v in categories[1:]]


def ordinal(x: Column, levels: list[str]) -> Column:
    """K6 apply: level index, unknown -> -1."""
    e = F.lit(-1.0)
    for i, v in reversed(list(enumerate(levels))):
        e = F.when(x == F.lit(v), F.lit(float(i))).otherwise(e)
    return e


def fit(df: DataFrame, num_skew: Sequence[str] = S.NUM_SKEW, num_lin: Sequence[str] = S.NUM_LIN,
        cat_nom: Sequence[str] = S.CAT_NOM, cat_ord: Sequence[str] = S.CAT_ORD,
        ordinal_levels: dict[str, list[str]] | None = None) -> Preprocessor:
    """K7 fit: exact medians (K1), min/max after impute [+ log1p] (K3/K4), modes
    (K2), sorted categories (K5).  Three distributed passes, bounded results."""
    num_skew, num_lin = present(df, num_skew), present(df, num_lin)
    cat_nom, cat_ord = present(df, cat_nom), present(df, cat_ord)
    ordinal_levels = ordinal_levels or {S.LOAD_TYPE: S.LOAD_ORDER}
    p = Preprocessor(num_skew, num_lin, cat_nom, cat_ord)
    nums = num_skew + num_lin
    if nums:
        med = quantiles(df, nums, [0.5]).select("column", "q").collect()
        p.medians = {r["column"]: r["q"] for r in med}
        # a median imputation cannot move min / max, so the scaler bounds come
        # from one pass independent of the medians; values without a log
        # (-1 and below) are left out of the bounds and NULL in their own rows
        exprs = []
        for c in nums:
            x = F.col(c).cast("double")
            if c in num_skew:
                x = F.log1p(x)
                x = F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)
            exprs += [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
        row = df.agg(*exprs).first()
        p.mins = {c: row[f"{c}__min"] for c in nums}
        p.maxs = {c: row[f"{c}__max"] for c in nums}
    cats = cat_nom + cat_ord
    if cats:
        # one value-count pass gives modes and levels
        from meterlake.operators.profile import value_counts
        from meterlake.session import scratch_path
        vc = value_counts(df, cats).select("column", "value", "n")
        top = F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("v")))
        seen = {r["column"]: r for r in vc.groupBy("column").agg(F.count(F.lit(1)).alias("k"), top.alias("top")).collect()}
        p.modes = {c: seen[c]["top"]["v"] if c in seen else None for c in cats}
        few = [c for c in cat_nom if c not in seen or seen[c]["k"] <= MAX_CATEGORIES]
        levels = vc.where(F.col("column").isin(few)).select("column", "value").collect() if few else []
        p.categories = {c: sorted(r["value"] for r in levels if r["column"] == c) for c in few}
        for c in cat_nom:
            if c not in few:
                path = scratch_path(df.sparkSession, "category_numbers")
                numbered_categories(df.select(F.col(c).cast("string").alias(c)), [c]).select("value", "code").write.parquet(path)
                p.sparse[c] = (seen[c]["k"], path)
        p.ordinal = {c: list(ordinal_levels[c]) for c in cat_ord}
    return p


def split_80_20(df: DataFrame, key: str = S.ROW_ID, seed: int = 42, pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """K9: deterministic per-row split, independent of partitioning."""
    # (key * 2654435761 + seed) mod 1000, reduced first so that no key overflows
    h = F.pmod(F.pmod(F.col(key), F.lit(1000)) * F.lit(2654435761 % 1000) + F.lit(seed), F.lit(1000))
    return df.where(h < pct * 10), df.where(h >= pct * 10)


def standard_scale(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (S.ROW_ID,)) -> DataFrame:
    """(x - mean) / population std; constant column -> 0.  Statistics are
    one scalar subquery (computed once, no join)."""
    st = df.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c)
                           for c in cols]).alias("st")).scalar()
    out = []
    for c in cols:
        m, s = st.getField(c).getField("m"), st.getField(c).getField("s")
        out.append(F.when(s > 0, (F.col(c) - m) / s).otherwise(F.lit(0.0)).alias(c))
    return df.select(*present(df, keep), *out)


def numbered_categories(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, code): the distinct values of every column numbered from 0
    in their order, however many there are.

    The values are range-partitioned by (column, value); a task numbers its own
    as they are sorted, and what earlier tasks hold is added.  The driver sees a
    count per task and column."""
    from meterlake.operators.quantile import sized
    from meterlake.session import scratch_path

    spark = df.sparkSession
    kinds = {c: f.dataType for c, f in zip(cols, df.select(*cols).schema.fields)}
    kind = kinds[cols[0]] if len(set(map(str, kinds.values()))) == 1 else "string"
    long = df.select(*[F.col(c).cast(kind).alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    rows = (long.where(F.col("value").isNotNull()).distinct().repartitionByRange("column", "value")
            .sortWithinPartitions("column", "value"))
    path = scratch_path(spark, "categories")  # fixed before it is counted
    rows.select("column", "value", F.spark_partition_id().alias("part"),
                F.monotonically_increasing_id().alias("at")).write.parquet(path)
    rows = spark.read.parquet(path)
    counts = rows.groupBy("part", "column").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).collect()
    before, seen = [], dict.fromkeys(cols, 0)
    for r in sorted(counts, key=lambda r: r["part"]):
        before.append((r["part"], r["column"], seen[r["column"]] - r["first"]))
        seen[r["column"]] += r["n"]
    shift = sized(spark.createDataFrame(before, "part int, column string, shift long"))[0]
    return rows.join(shift, ["part", "column"]).select(
        "column", "value", (F.col("at") + F.col("shift")).alias("code"))


def _with_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with ``_<column>_code``, NULL for a missing value.  A code table is
    broadcast behind its size check, beyond that the join shuffles."""
    codes = numbered_categories(df, cols)
    for c in cols:
        table = codes.where(F.col("column") == c).select(F.col("value").cast(df.schema[c].dataType).alias("value"), "code")
        df = _joined_codes(df, c, table, f"_{c}_code")
    return df


def _joined_codes(df: DataFrame, col: str, codes: DataFrame, out: str) -> DataFrame:
    from meterlake.operators.quantile import sized

    table = codes.select(F.col("value").alias(f"_{col}"), F.col("code").alias(out))
    return df.join(sized(table)[0], F.col(col) == F.col(f"_{col}"), "left").drop(f"_{col}")


def sparse_vector(code: Column, categories: int) -> Column:
    """struct<size, indices, values> of a category number, the first category
    dropped: at most one entry."""
    some = code > 0
    return F.struct(
        F.lit(max(categories - 1, 0)).alias("size"),
        F.when(some, F.array((code - 1).cast("int"))).otherwise(F.array().cast("array<int>")).alias("indices"),
        F.when(some, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"))


def category_codes(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (S.ROW_ID,)) -> DataFrame:
    """Dense codes from 0 in the order of the values; NULL -> -1."""
    out = _with_codes(df.select(*present(df, keep), *cols), cols)
    return out.select(*present(df, keep), *[
        F.coalesce(F.col(f"_{c}_code"), F.lit(-1)).cast("bigint").alias(c) for c in cols])


def onehot_sparse(df: DataFrame, col: str, keep: Sequence[str] = (S.ROW_ID,)) -> DataFrame:
    """K5 for any number of categories: the one-hot row of ``col``, first category
    dropped, as a sparse vector ``size``, ``indices``, ``values`` (at most one
    entry; none for the first category and for a missing value)."""
    out = _with_codes(df.select(*present(df, keep), *([] if col in keep else [col])), [col])
    n = df.agg(F.count_distinct(col)).first()[0]
    return out.select(*present(df, keep), sparse_vector(F.col(f"_{col}_code"), n).alias("onehot"))
