"""Model fitting L1-L9, K10, A6 on MLlib.

* linear regression (normal equations), random forest and gradient-boosted trees
  (MLlib on small tables, else ``operators/forest.py`` and ``operators/gbt.py``);
* PCA keeping 95 % variance behind a centring step;
* RuleFit (Friedman & Popescu 2008): boosted shallow trees -> every non-root
  node is a rule (conjunction of splits on its path) -> 0/1 rule columns plus
  winsorised linear terms -> lasso path (log grid, then bisection) to the
  weakest penalty that keeps at most ``max_rules`` rules.  The path needs one
  scan: it is solved by coordinate descent on the design's sums of products.
  The result is a ``RuleModel`` (one projection to score).

Only metadata-sized objects reach the driver: tree node tables, coefficient
vectors, sums of products of the rules, explained-variance vectors.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import (GBTRegressor, LinearRegression, RandomForestRegressionModel,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.operators import forest as FO
from meterlake.operators import gbt as GB
from meterlake.operators.gram import LassoStatistics, centred_gram, moments_of, reduced
from meterlake.operators.quantile import quantiles
from meterlake.operators.score import RuleModel
from meterlake.session import scratch_path

FEATURES = "features"
# Histograms that a task of a forest holds at a time: every core of an executor holds as much.
FOREST_MB = 128
TRAIN_ROWS = 50_000
# Nodes of trees that the driver holds at a time.
FOREST_NODES = 1_000_000
# Forests of at most so many rows x trees are fitted by MLlib, in the driver's memory.
SMALL_NODES = 100_000
# Boosted trees on at most so many rows are fitted by MLlib.
SMALL_ROWS = 20_000


def assemble(df: DataFrame, cols: Sequence[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def dealt(df: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``df`` in partitions of at most about ``rows``: a tree task reads its whole
    partition, several times its stored size, in every pass.  Left as it is
    where its partitions are no larger."""
    parts = -(-df.count() // rows)
    return df.repartition(parts) if parts > df.rdd.getNumPartitions() else df


def _training(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    return dealt(df.select(*[F.col(f"`{c}`") for c in cols], label))


# ---------------------------------------------------------------- L1, L3, L4
def fit_linear(df: DataFrame, cols: Sequence[str], label: str = "label") -> PipelineModel:
    """L1: ordinary least squares with intercept (normal equations)."""
    lr = LinearRegression(featuresCol=FEATURES, labelCol=label, solver="normal", regParam=0.0)
    return Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol=FEATURES,
                                            handleInvalid="keep"), lr]).fit(df)


class ForestParts:
    """A forest as several saved models of a few trees each.  The driver holds
    one of them at a time, and so do the executors: rows are scored model by
    model, the sum of predictions so far written beside them."""

    def __init__(self, kind, parts: list[tuple[str, int]], importances: np.ndarray):
        self.kind, self.parts, self.featureImportances = kind, parts, DenseVector(importances)

    @property
    def stages(self) -> list:
        return [self]

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        spark, trees = df.sparkSession, sum(n for _, n in self.parts)
        rows = df.withColumn("_sum", F.lit(0.0))
        for path, n in self.parts:
            one = self.kind.load(path).setPredictionCol("_one")
            at = scratch_path(spark, "forest_scores")
            one.transform(rows).withColumn("_sum", F.col("_sum") + n * F.col("_one")).drop("_one").write.parquet(at)
            rows = spark.read.parquet(at)
        return rows.withColumn(out, F.col("_sum") / trees).drop("_sum")


def grown(rf: RandomForestRegressor, data: DataFrame):
    """``rf`` fitted on assembled rows: above ``SMALL_NODES`` a ``Forest``, its trees
    grown by the tasks; else one model where its trees are small, or
    ``ForestParts``.  A tree has at most about one node a row."""
    trees, n = rf.getNumTrees(), data.count()
    if n * trees > SMALL_NODES:
        return FO.fit_forest(data, rf.getFeaturesCol(), rf.getLabelCol(), trees, rf.getMaxDepth(),
                             rf.getMinInstancesPerNode(), rf.getSeed())
    few = min(max(1, FOREST_NODES // max(n, 1)), trees)
    if few == trees:
        return rf.fit(data)
    parts, importances = [], 0.0
    for i, first in enumerate(range(0, trees, few)):
        n = min(few, trees - first)
        model = rf.copy({rf.numTrees: n, rf.seed: rf.getSeed() + i}).fit(data)
        importances = importances + n * model.featureImportances.toArray()
        parts.append((scratch_path(data.sparkSession, "forest_trees"), n))
        model.write().save(parts[-1][0])
    return ForestParts(RandomForestRegressionModel, parts, importances / max(importances.sum(), 1e-300))


def fit_forest(df: DataFrame, cols: Sequence[str], label: str = "label", num_trees: int = 100,
               max_depth: int = 20, min_leaf: int = 2, seed: int = 42) -> PipelineModel:
    """L3: random forest (sqrt feature subsets); sklearn's min-split has no MLlib knob."""
    rf = RandomForestRegressor(featuresCol=FEATURES, labelCol=label, numTrees=num_trees,
                               maxDepth=max_depth, minInstancesPerNode=min_leaf,
                               featureSubsetStrategy="sqrt", seed=seed, maxMemoryInMB=FOREST_MB,
                               cacheNodeIds=True)
    asm = VectorAssembler(inputCols=list(cols), outputCol=FEATURES, handleInvalid="keep")
    return PipelineModel([asm, grown(rf, asm.transform(_training(df, cols, label)))])


def fit_gbt(df: DataFrame, cols: Sequence[str], label: str = "label", rounds: int = 100,
            step: float = 0.1, max_depth: int = 6, subsample: float = 0.8,
            col_sample: str = "0.8", seed: int = 42) -> PipelineModel:
    """L4: gradient boosting (row sampling per round, column sampling per node)."""
    gbt = GBTRegressor(featuresCol=FEATURES, labelCol=label, maxIter=rounds, stepSize=step,
                       maxDepth=max_depth, subsamplingRate=subsample,
                       featureSubsetStrategy=col_sample, seed=seed)
    asm = VectorAssembler(inputCols=list(cols), outputCol=FEATURES, handleInvalid="keep")
    return PipelineModel([asm, boosted(gbt, asm.transform(_training(df, cols, label)))])


def boosted(gbt: GBTRegressor, data: DataFrame):
    """``gbt`` fitted on assembled rows; on more than ``SMALL_ROWS`` by ``operators/gbt.py``."""
    if data.count() <= SMALL_ROWS:
        return gbt.fit(data)
    share = gbt.getFeatureSubsetStrategy()
    return GB.fit_boosted(GB.rows_of(data, gbt.getFeaturesCol(), gbt.getLabelCol(), gbt.getSeed()), gbt.getMaxIter(),
                          gbt.getStepSize(), gbt.getMaxDepth(), gbt.getSubsamplingRate(),
                          1.0 if share in ("auto", "all") else float(share), gbt.getSeed())


def fit_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """L1, one feature: slope / intercept / r2 as one aggregate."""
    return df.agg(F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("slope"),
                  F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("intercept"),
                  F.regr_r2(F.col(y).cast("double"), F.col(x).cast("double")).alias("r2"),
                  F.regr_count(F.col(y), F.col(x)).alias("n"))


def feature_importance(model: PipelineModel, cols: Sequence[str]) -> DataFrame:
    """Importances of the last (tree) stage, sorted descending."""
    spark = _spark()
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(cols, [float(v) for v in imp]))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def top_k(df: DataFrame, by: str, k: int = 10, tie: str | None = None) -> DataFrame:
    """top-k by a column (TakeOrderedAndProject)."""
    order = [F.desc(by)] + ([F.col(tie)] if tie else [])
    return df.orderBy(*order).limit(k)


def _spark():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


def predict_ml(model, df: DataFrame, out: str = "prediction") -> DataFrame:
    """M1: apply a fitted PipelineModel (it assembles its own features)."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    pcol = out if isinstance(last, ForestParts | FO.Forest | GB.Boosted) else last.getOrDefault("predictionCol") if last is not model else out
    res = model.transform(df)
    if pcol != out:
        res = res.withColumnRenamed(pcol, out)
    return res.drop(FEATURES)


# ---------------------------------------------------------------- K10, L8
def fit_pca95(df: DataFrame, cols: Sequence[str], variance: float = 0.95) -> tuple[PipelineModel, int, list[float]]:
    """Centre (no scaling), one PCA fit with k = d, keep the smallest k with
    cumulative explained variance > ``variance``: the first k of its components."""
    d = len(cols)
    asm = VectorAssembler(inputCols=list(cols), outputCol="raw_features", handleInvalid="keep")
    ctr = StandardScaler(inputCol="raw_features", outputCol="centered", withMean=True, withStd=False)
    full = Pipeline(stages=[asm, ctr, PCA(k=d, inputCol="centered", outputCol="components")]).fit(df)
    ev = full.stages[-1].explainedVariance.toArray().tolist()
    cum = np.cumsum(ev)
    k = int(np.argmax(cum > variance) + 1) if (cum > variance).any() else d
    first = VectorSlicer(inputCol="components", outputCol=FEATURES, indices=list(range(k)))
    return PipelineModel([*full.stages, first]), k, ev


def pca_check(df: DataFrame, cols: Sequence[str], variance: float = 0.95) -> DataFrame:
    """The fitted components seen from their own projections: total variance
    (the features', if the rotation keeps lengths), whether they are
    uncorrelated, and whether their variances give the same k."""
    from pyspark.ml.functions import vector_to_array

    model, k, _ = fit_pca95(df, cols, variance)
    d = len(cols)
    parts = vector_to_array("components")
    rows = model.transform(df).select(*[parts[i].alias(f"p{i}") for i in range(d)])
    n, _, s = moments_of(reduced(rows, rows.columns, centred_gram)[0])
    cov = s / max(n - 1, 1)
    share = np.cumsum(np.diag(cov)) / max(np.trace(cov), 1e-300)
    again = int(np.argmax(share > variance) + 1) if (share > variance).any() else d
    apart = np.abs(cov - np.diag(np.diag(cov))).max(initial=0.0) <= 1e-9 * max(np.trace(cov), 1e-300)
    return df.sparkSession.createDataFrame(
        [(n, float(np.trace(cov)), d, int(apart), int(again == k))],
        "rows long, total_variance double, components int, uncorrelated int, same_k int")


def fit_pca_regressor(df: DataFrame, cols: Sequence[str], kind: str = "linear", label: str = "label",
                      **kw) -> tuple[PipelineModel, int]:
    """Centre -> PCA(95 %) -> regressor."""
    pca_model, k, _ = fit_pca95(df, cols)
    reg = {"linear": LinearRegression(solver="normal", regParam=0.0),
           "forest": RandomForestRegressor(numTrees=kw.get("num_trees", 100), maxDepth=kw.get("max_depth", 20),
                                           minInstancesPerNode=2, featureSubsetStrategy="sqrt", seed=42,
                                           maxMemoryInMB=FOREST_MB, cacheNodeIds=True),
           "gbt": GBTRegressor(maxIter=kw.get("rounds", 100), stepSize=0.1, maxDepth=kw.get("max_depth", 6),
                               subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42)}[kind]
    reg.setFeaturesCol(FEATURES).setLabelCol(label)
    data = pca_model.transform(df if kind == "linear" else _training(df, cols, label))
    return PipelineModel([*pca_model.stages, {"forest": grown, "gbt": boosted}.get(kind, type(reg).fit)(reg, data)]), k


# ---------------------------------------------------------------- L5, L7 RuleFit
def _tree_sizes(n_trees: int, mean_size: int, seed: int) -> list[int]:
    rng = np.random.default_rng(seed)
    return [int(2 + math.floor(rng.exponential(max(mean_size - 2, 1e-9)))) for _ in range(n_trees)]


def _rules_from_trees(nodes: list, names: Sequence[str]) -> list[str]:
    """Every non-root node -> conjunction of the splits on its path."""
    by_tree: dict[int, dict[int, object]] = {}
    for r in nodes:
        by_tree.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    rules = []
    for tree in by_tree.values():
        children = {c for nd in tree.values() for c in (nd["leftChild"], nd["rightChild"]) if c >= 0}
        root = next(i for i in tree if i not in children)
        stack = [(root, [])]
        while stack:
            nid, path = stack.pop()
            nd = tree[nid]
            if path:
                rules.append(" AND ".join(path))
            if nd["leftChild"] >= 0:
                f = names[nd["split"]["featureIndex"]]
                t = repr(float(nd["split"]["leftCategoriesOrThreshold"][0]))
                stack.append((nd["leftChild"], path + [f"`{f}` <= {t}"]))
                stack.append((nd["rightChild"], path + [f"`{f}` > {t}"]))
    return rules


def _simplify(rule: str) -> str:
    """Keep the tightest bound per (feature, direction); sort the terms."""
    lo: dict[str, float] = {}
    hi: dict[str, float] = {}
    for term in rule.split(" AND "):
        f, op, v = term.rsplit(" ", 2)
        v = float(v)
        if op == "<=":
            hi[f] = min(hi.get(f, v), v)
        else:
            lo[f] = max(lo.get(f, v), v)
    terms = [f"{f} > {lo[f]!r}" for f in sorted(lo)] + [f"{f} <= {hi[f]!r}" for f in sorted(hi)]
    return " AND ".join(sorted(terms))


def rule_design(cols: Sequence[str], rules: Sequence[str], linear: Sequence[tuple[str, float, float]]):
    """Gram of [1, rules as 0/1, winsorised linear terms (column, least,
    greatest), label] of a batch of rows (cols..., label).  A comparison with a
    missing value is false; rows without a label or a linear term take no part."""
    place = {c: i for i, c in enumerate(cols)}
    parsed = [[(place[f.strip("`")], op, float(v)) for f, op, v in (t.rsplit(" ", 2) for t in r.split(" AND "))]
              for r in rules]
    ends = [(place[c], lo, hi) for c, lo, hi in linear]

    def make(x: np.ndarray) -> list[np.ndarray]:
        x = x[~np.isnan(x[:, [*(i for i, _, _ in ends), -1]]).any(axis=1)]
        z = np.ones((len(x), len(parsed) + len(ends) + 1))
        for j, terms in enumerate(parsed):
            for i, op, v in terms:
                z[:, j] *= x[:, i] <= v if op == "<=" else x[:, i] > v
        for j, (i, lo, hi) in enumerate(ends):
            z[:, len(parsed) + j] = np.clip(x[:, i], lo, hi)
        z[:, -1] = x[:, -1]
        return centred_gram(z)

    return make


def kkt(df: DataFrame, model: RuleModel, label: str = "label", tol: float = 1e-6) -> DataFrame:
    """Optimality of a fitted rule model's penalty, from a scan of its own: the
    correlation of every rule of the pool with the residuals may not pass the
    penalty, and equals it, with the coefficient's sign, where the rule is kept."""
    active = {cond: c for _, cond, c in model.rules}
    e = F.col(label) - model.prediction()
    held = [F.coalesce(F.expr(r), F.lit(False)).cast("double") for r in model.pool]
    one = df.where(F.col(label).isNotNull()).select(e.alias("e"), *[z.alias(f"z{i}") for i, z in enumerate(held)]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("e").alias("e"), F.stddev_samp("e").alias("sd"),
        *[F.struct(F.sum(F.col(f"z{i}") * F.col("e")).alias("ze"), F.stddev_pop(f"z{i}").alias("sd")).alias(f"s{i}")
          for i in range(len(held))]).first()
    slack, over, off = tol * max(model.penalty, one["sd"] or 0.0), 0, 0
    for i, cond in enumerate(model.pool):
        s = one[f"s{i}"]
        if not s["sd"]:
            continue
        g = s["ze"] / (one["n"] * s["sd"])
        if cond in active:
            off += abs(g - math.copysign(model.penalty, active[cond])) > slack
        else:
            over += abs(g) > model.penalty + slack
    centred = abs(one["e"] or 0.0) <= tol * max(one["n"], 1) * (one["sd"] or 1.0)
    return df.sparkSession.createDataFrame(
        [(one["n"], over, off, int(centred))], "rows long, zero_over_penalty long, kept_off_penalty long, centred int")


def fit_rulefit(df: DataFrame, cols: Sequence[str], label: str = "label", max_rules: int = 30,
                tree_size: int = 4, n_trees: int = 100, exp_rand_tree_size: bool = True,
                include_linear: bool = True, trim: float = 0.025, seed: int = 42,
                lambdas: int = 12, bisect_steps: int = 4, sample_fraction: float = 1.0
                ) -> tuple[RuleModel, DataFrame]:
    """Returns (RuleModel, rule table with support and importance).

    Every boosting round sees all rows unless ``sample_fraction`` asks for a
    row sample per round."""
    spark = df.sparkSession
    cols = list(cols)
    sizes = _tree_sizes(n_trees, tree_size, seed) if exp_rand_tree_size else [tree_size] * n_trees
    depths: dict[int, int] = {}
    for t in sizes:
        dd = max(1, math.ceil(math.log2(max(t, 2))))
        depths[dd] = depths.get(dd, 0) + 1
    data = assemble(_training(df, cols, label), cols).select(FEATURES, label)
    rules: list[str] = []
    binned = GB.rows_of(data, FEATURES, label, seed) if data.count() > SMALL_ROWS else None
    for dd, cnt in sorted(depths.items()):
        if binned:
            rules += GB.fit_boosted(binned, cnt, 0.01, dd, sample_fraction, seed=seed + dd).rules(cols)
            continue
        gbt = GBTRegressor(featuresCol=FEATURES, labelCol=label, maxIter=cnt, maxDepth=dd, stepSize=0.01,
                           subsamplingRate=sample_fraction, seed=seed + dd).fit(data)
        path = scratch_path(spark, f"rulefit_trees_d{dd}")
        gbt.write().save(path)
        nodes = spark.read.parquet(path + "/data").collect()   # metadata-sized
        rules += _rules_from_trees(nodes, cols)
    rules = sorted({_simplify(r) for r in rules})
    rule_ids = [f"rule_{i}" for i in range(len(rules))]

    bounds: dict[str, dict[float, float]] = {}
    wins: dict[str, str] = {}
    if include_linear and cols:
        q = quantiles(df, cols, [trim, 1 - trim]).collect()
        for r in q:
            bounds.setdefault(r["column"], {})[r["p"]] = r["q"]
        wins = {c: f"least(greatest(`{c}`, {bounds[c][trim]!r}), {bounds[c][1 - trim]!r})" for c in cols
                if c in bounds}

    # One pass over the rows: sums of products of all rule and linear columns
    # and the label.  The whole penalty path, supports and the terms' scales
    # come from that matrix.
    n_rules, ends = len(rules), [(c, bounds[c][trim], bounds[c][1 - trim]) for c in wins]
    stats = LassoStatistics(reduced(df, [*cols, label], rule_design(cols, rules, ends))[0])
    lin_terms = [(f"lin_{c}", f"(0.4 * {wins[c]} / {sd!r})", 0.4 / sd) if live else None
                 for c, sd, live in zip(wins, stats.sample_sd[n_rules:-1].tolist(), stats.live[n_rules:])]

    def kept(lam, start):
        b = stats.solve(lam, start)
        return b, int(np.count_nonzero(b[:n_rules]))

    # from strong to weak penalty; keep the last fit within max_rules
    y_sd = float(stats.sample_sd[-1]) or 1.0
    grid = [y_sd * 10 ** (1 - 4 * i / (lambdas - 1)) for i in range(lambdas)]
    chosen, ok_lam, bad_lam, lam, warm = None, None, None, grid[0], None
    for lam in grid:
        b, nz = kept(lam, warm)
        if nz <= max_rules:
            chosen = warm = b
            ok_lam = lam
        else:
            bad_lam = lam
            break
    while chosen is None:  # even the strongest penalty kept too many: go on upward
        bad_lam, lam = lam, lam * 10
        if lam > grid[0] * 1e6:
            raise ValueError(f"no penalty keeps at most {max_rules} rules")
        b, nz = kept(lam, None)
        if nz <= max_rules:
            chosen, ok_lam = b, lam
    if bad_lam is not None:
        # refine between the last feasible and the first infeasible penalty
        for _ in range(bisect_steps):
            mid = math.sqrt(ok_lam * bad_lam)
            b, nz = kept(mid, chosen)
            if nz <= max_rules:
                chosen, ok_lam = b, mid
            else:
                bad_lam = mid
    coefs, intercept = stats.coefficients(chosen)
    supports = dict(zip(rule_ids, stats.mean[:n_rules]))
    rm_rules, rm_linear, table = [], [], []
    for j, (rid, cond) in enumerate(zip(rule_ids, rules)):
        c = float(coefs[j])
        if c != 0.0:
            s = float(supports[rid])
            rm_rules.append((rid, cond, c))
            table.append((rid, "rule", cond, c, s, abs(c) * math.sqrt(s * (1 - s))))
    for j, term in enumerate(lin_terms):
        if term is None:  # a constant feature
            continue
        nm, e, unit = term
        c = float(coefs[n_rules + j]) / unit
        if c != 0.0:
            rm_linear.append((e, c))
            table.append((nm, "linear", e, c, 1.0, abs(c) * 0.4))  # the term is scaled to std 0.4
    model = RuleModel(intercept, rm_rules, rm_linear, penalty=float(ok_lam), pool=rules)
    rule_table = spark.createDataFrame(
        table, "rule_id string, kind string, condition string, coefficient double, support double, "
               "importance double")
    return model, rule_table


# ---------------------------------------------------------------- A6
def save_rule_model(model: RuleModel, path: str) -> None:
    model.to_table(_spark()).write.mode("overwrite").parquet(path)


def load_rule_model(spark, path: str) -> RuleModel:
    rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["position"])
    intercept = next(r["coefficient"] for r in rows if r["kind"] == "intercept")
    rules = [(r["term"], r["expression"], r["coefficient"]) for r in rows if r["kind"] == "rule"]
    linear = [(r["expression"], r["coefficient"]) for r in rows if r["kind"] == "linear"]
    return RuleModel(intercept, rules, linear)
