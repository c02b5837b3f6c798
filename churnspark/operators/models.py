"""Model fitting and model tables (M1-M13) with Spark ML.

Fits run as distributed Spark ML jobs on the assembled ``features`` vector;
class balance enters through ``weightCol`` (or, for the multilayer network
that has no weight column, by replicating positive rows).  Everything after
a fit (coefficients, importances, search traces) is a small table.
"""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnspark import schemas as S
from churnspark.operators.evaluate import roc_auc, threshold_table
from churnspark.operators.prefix import cumulative
from churnspark.operators.split import with_weights
from churnspark.session import cut_lineage


def prob1(col: str = "probability") -> Column:
    return vector_to_array(F.col(col))[1]


# ---------------------------------------------------------------- M1, M2, M13
def fit_dummy(train: DataFrame, label: str = "churn_value", strategy: str = "most_frequent",
              key: str = "customerid", seed: int = 42):
    """M1 / M2: returns a function DataFrame -> DataFrame adding ``score``.

    most_frequent: constant 1.0 if the label mode is 1 else 0.0;
    stratified: 1.0 when a seeded uniform draw (hash of the key) < the
    positive rate, else 0.0."""
    r = train.agg(F.avg(F.col(label).cast("double")).alias("p")).first()["p"]
    if strategy == "most_frequent":
        mode = 1.0 if r > 0.5 else 0.0
        return lambda df: df.withColumn("score", F.lit(mode))
    u = (F.xxhash64(F.col(key), F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1)).cast("double")
         / float(1 << 53))
    return lambda df: df.withColumn("score", (u < F.lit(r)).cast("double"))


def rule_score(df: DataFrame, charge: float = 65.0, tenure: int = 12, use_charge: bool = True) -> DataFrame:
    """Month-to-month AND monthly > 65 AND tenure < 12 -> 1 (fallback
    without the charge rule)."""
    cond = (F.col("contract") == "Month-to-month") & (F.col("tenure_months") < tenure)
    if use_charge:
        cond = cond & (F.col("monthly_charges") > charge)
    return df.withColumn("score", F.coalesce(cond, F.lit(False)).cast("double"))


def fit_group_rate(train: DataFrame, by: Sequence[str], label: str = "churn_value"):
    """A closed-form scorer: the positive rate of a row's group in ``train``, or
    of all of ``train`` for a group not met there.  Returns a function
    DataFrame -> DataFrame adding ``score``.  One aggregate (the groups and the
    total); the join is left to the planner, as groups may be many."""
    y = F.col(label).cast("double")
    rates = train.groupBy(*by).agg(F.avg(y).alias("_rate"))
    whole = train.agg(F.avg(y)).first()[0]

    def score(df: DataFrame) -> DataFrame:
        r = rates.select(*[F.col(c).alias(f"_{c}") for c in by], "_rate")
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        return (df.join(r, same, "left").withColumn("score", F.coalesce("_rate", F.lit(whole)))
                  .drop("_rate", *[f"_{c}" for c in by]))
    return score


# ---------------------------------------------------------------- M3-M6
def fit_logistic(train: DataFrame, label: str = "churn_value", C: float = 1.0, penalty: str = "l2",
                 features: str = "features", max_iter: int = 100):
    """M3: class-balanced logistic regression; the sklearn objective
    C*sum(w*loss) + penalty maps to regParam = 1 / (C * sum(w))."""
    t = with_weights(train, label)
    sw = t.agg(F.sum("weight")).first()[0]
    lr = LogisticRegression(featuresCol=features, labelCol=label, weightCol="weight",
                            regParam=1.0 / (C * sw), elasticNetParam=1.0 if penalty == "l1" else 0.0,
                            standardization=False, maxIter=max_iter)
    return lr.fit(t)


def fit_forest(train: DataFrame, label: str = "churn_value", trees: int = 200, depth: int = 8,
               features: str = "features", seed: int = 42):
    """M4: class-balanced random forest."""
    t = with_weights(train, label)
    return RandomForestClassifier(featuresCol=features, labelCol=label, weightCol="weight", numTrees=trees,
                                  maxDepth=depth, seed=seed).fit(t)


def fit_gbt(train: DataFrame, label: str = "churn_value", iters: int = 200, depth: int = 4,
            step: float = 0.05, subsample: float = 0.8, features: str = "features", seed: int = 42,
            validation: str | None = None):
    """M5: gradient-boosted trees (optional early stop on a validation flag)."""
    g = GBTClassifier(featuresCol=features, labelCol=label, maxIter=iters, maxDepth=depth, stepSize=step,
                      subsamplingRate=subsample, seed=seed)
    if validation:
        g = g.setValidationIndicatorCol(validation).setValidationTol(1e-4)
    return g.fit(train)


def fit_mlp(train: DataFrame, label: str = "churn_value", hidden: Sequence[int] = (128, 64),
            features: str = "features", max_iter: int = 100, seed: int = 42, pos_weight: int | None = None):
    """M6: multilayer network (L-BFGS).  Spark's network has no weight
    column, so positives are replicated ``pos_weight`` times (integer,
    default round(n_neg / n_pos)): an explode, i.e. a bounded expansion."""
    width = len(train.select(features).first()[0])
    if pos_weight is None:
        r = train.agg(F.sum(1 - F.col(label)).alias("neg"), F.sum(label).alias("pos")).first()
        pos_weight = max(1, round(r["neg"] / max(r["pos"], 1)))
    rep = F.when(F.col(label) == 1, F.lit(int(pos_weight))).otherwise(F.lit(1))
    t = train.withColumn("_r", F.explode(F.sequence(F.lit(1), rep))).drop("_r")
    mlp = MultilayerPerceptronClassifier(featuresCol=features, labelCol=label,
                                         layers=[width, *hidden, 2], maxIter=max_iter, seed=seed)
    return mlp.fit(t.withColumn(label, F.col(label).cast("double")))


# ---------------------------------------------------------------- M7, M9
def early_stop(history: DataFrame, patience: int = 10, min_delta: float = 1e-4,
               run: str = "run", step: str = "epoch", value: str = "value") -> DataFrame:
    """M7: per run, walk the validation losses in epoch order and stop after
    ``patience`` epochs without an improvement larger than ``min_delta``;
    returns the stop epoch and the true best epoch.  The per-run array is
    bounded by the epoch count."""
    arr = F.array_sort(F.collect_list(F.struct(F.col(step).alias("e"), F.col(value).alias("v"))))
    g = history.groupBy(run).agg(arr.alias("h"))
    init = F.struct(F.lit(float("inf")).alias("best"), F.lit(-1).alias("best_e"), F.lit(0).alias("wait"),
                    F.lit(-1).alias("stop"))

    def step_fn(acc, x):
        done = acc["stop"] >= 0
        better = x["v"] < acc["best"] - min_delta
        wait = F.when(better, F.lit(0)).otherwise(acc["wait"] + 1)
        return F.when(done, acc).otherwise(F.struct(
            F.when(better, x["v"]).otherwise(acc["best"]).alias("best"),
            F.when(better, x["e"]).otherwise(acc["best_e"]).alias("best_e"),
            wait.alias("wait"),
            F.when(wait >= patience, x["e"]).otherwise(F.lit(-1)).alias("stop")))

    r = g.select(run, F.aggregate("h", init, step_fn).alias("a"), F.array_max(F.transform("h", lambda x: x["e"]))
                 .alias("last"))
    best_true = g.select(run, F.array_min(F.transform("h", lambda x: F.struct(x["v"], x["e"]))).alias("m"))
    return (r.join(best_true, run).select(
        run, F.when(F.col("a.stop") >= 0, F.col("a.stop")).otherwise(F.col("last")).alias("stop_epoch"),
        F.col("a.best_e").alias("best_epoch_patience"), F.col("m.e").alias("best_epoch"),
        F.col("m.v").alias("best_value")))


def convergence(trials: DataFrame, study: str = "study", trial: str = "trial", value: str = "value",
                floor: float = -1e7) -> DataFrame:
    """M9: best-so-far value per study, bad trials (<= floor) dropped.  The
    window runs over one study's trials (a few hundred rows)."""
    w = Window.partitionBy(study).orderBy(trial).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return trials.where(F.col(value) > floor).withColumn("best_so_far", F.max(value).over(w))


# ---------------------------------------------------------------- M8
class BusinessValueEvaluator(Evaluator):
    """Custom evaluator for the search: business value at the best threshold
    of the grid (A13: recall >= SLO if any threshold reaches it, else the best
    value overall).  ``value_and_recall`` also tells the recall there."""

    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "probability", TypeConverters.toString)

    def __init__(self, labelCol: str = "churn_value", probabilityCol: str = "probability",
                 slo: float = S.SLO_RECALL_MIN, costs: S.CostModel = S.DEFAULT_COSTS):
        super().__init__()
        self._set(labelCol=labelCol, probabilityCol=probabilityCol)
        self.slo, self.costs = slo, costs

    def value_and_recall(self, dataset: DataFrame) -> tuple[float, float]:
        s = dataset.select(F.lit("m").alias("model"), prob1(self.getOrDefault(self.probabilityCol)).alias("score"),
                           F.col(self.getOrDefault(self.labelCol)).cast("int").alias("label"))
        rank = F.struct(F.col("recall") >= self.slo, F.col("business_value"), -F.col("threshold"))
        r = threshold_table(s, costs=self.costs).agg(F.max_by(F.struct("business_value", "recall"), rank).alias("b")).first()
        return (float(r.b.business_value), float(r.b.recall)) if r.b else (0.0, 0.0)

    def _evaluate(self, dataset: DataFrame) -> float:
        return self.value_and_recall(dataset)[0]

    def isLargerBetter(self) -> bool:
        return True


class LogRange(NamedTuple):
    """A parameter drawn evenly on the log scale between two positive bounds."""
    low: float
    high: float


def random_grid(space: dict, n: int, seed: int = 42) -> list[dict]:
    """``n`` different seeded trials from a dict of candidate lists and
    ``LogRange``; all combinations when the lists have no more than ``n``."""
    rnd = random.Random(seed)
    keys = sorted(space)
    if not any(isinstance(space[k], LogRange) for k in keys):
        full = [dict(zip(keys, c)) for c in itertools.product(*(list(space[k]) for k in keys))]
        return rnd.sample(full, min(n, len(full)))
    return [{k: math.exp(rnd.uniform(math.log(c.low), math.log(c.high))) if isinstance(c, LogRange) else rnd.choice(list(c))
             for k, c in ((k, space[k]) for k in keys)} for _ in range(n)]


def trial_value(values: Sequence[float], recalls: Sequence[float], slo: float = S.SLO_RECALL_MIN) -> float:
    """A trial's score: the mean of its folds' values, or -1e8 when the *mean*
    recall misses the SLO (one weak fold alone does not sink it)."""
    return -1e8 if sum(recalls) / len(recalls) < slo else sum(values) / len(values)


def search(train: DataFrame, estimator, param_space: dict, n_trials: int = 10, fold: str = "fold",
           parallelism: int = 4, seed: int = 42, evaluator: BusinessValueEvaluator | None = None):
    """M8: seeded random search, k-fold by an existing ``fold`` column; folds x
    trials run as parallel Spark jobs.  Returns the best trial's model, fitted
    on all rows, and a table of the trials."""
    spark = train.sparkSession
    ev = evaluator or BusinessValueEvaluator(labelCol=estimator.getLabelCol())
    trials = random_grid(param_space, n_trials, seed)
    params = {p.name: p for p in estimator.params}
    maps = [{params[k]: v for k, v in t.items()} for t in trials]
    folds = sorted(r[0] for r in train.select(fold).distinct().collect())

    @inheritable_thread_target(spark)
    def one(job):
        i, f = job
        m = estimator.fit(train.where(F.col(fold) != f), maps[i])
        return ev.value_and_recall(m.transform(train.where(F.col(fold) == f)))

    with ThreadPool(parallelism) as pool:
        res = pool.map(one, [(i, f) for i in range(len(trials)) for f in folds], chunksize=1)
    k = len(folds)
    got = [tuple(zip(*res[i * k:(i + 1) * k])) for i in range(len(trials))]
    rows = [(i, json.dumps(t), trial_value(v, r, ev.slo), sum(r) / k) for i, (t, (v, r)) in enumerate(zip(trials, got))]
    best = max(rows, key=lambda r: (r[2], -r[0]))[0]
    table = spark.createDataFrame(rows, "trial int, params string, value double, mean_recall double")
    return estimator.fit(train, maps[best]), table


# ---------------------------------------------------------------- M10-M12
def coefficients(model, names: Sequence[str], k: int = 10) -> DataFrame:
    """Logistic coefficients with names, top-k by absolute value."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    rows = [(n, float(c)) for n, c in zip(names, model.coefficients.toArray())]
    df = spark.createDataFrame(rows, "feature string, coefficient double")
    return df.orderBy(F.abs("coefficient").desc(), "feature").limit(k)


def importances(model, names: Sequence[str], k: int = 20) -> DataFrame:
    """Tree feature importances, top-k."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(k)


def permutation_importance(scored_fn, df: DataFrame, cols: Sequence[str], key: str, label: str,
                           seed: int = 7) -> DataFrame:
    """AUC drop when one column's values are permuted across rows.

    The permutation pairs rank r by one seeded hash of the key with rank r by
    another (distributed prefix ranks and an equi-join on the rank): no sort of
    the whole table in one task, and one pass for all columns.  The variants (the
    rows as they are, and once per column with that column from the partner) are
    scored and ranked together, as models of one table.  ``key`` must be unique;
    rows without a key are left out.  ``scored_fn`` maps a frame to one with
    ``score`` and keeps further columns.  A row for each column."""
    def ranked(frame: DataFrame, n: int) -> DataFrame:
        c = cumulative(frame.withColumn("_h", F.xxhash64(key, F.lit(n))), None, "_h", {"_o": F.lit(1).cast("bigint")},
                       distinct=False, tiebreak=[key])
        return c.withColumnRenamed("cum__o", "_rk").drop("_h", "_o", "prev__o", "all__o")

    rows = df.where(F.col(key).isNotNull())
    donors = ranked(rows.select(key, *cols), seed).select("_rk", F.struct(*cols).alias("_from"))
    both = cut_lineage(ranked(rows, 1).join(donors, "_rk").drop("_rk"))
    every = both.drop("_from").withColumn("_variant", F.lit(""))
    for c in cols:
        every = every.unionByName(both.withColumn(c, F.col("_from")[c]).drop("_from").withColumn("_variant", F.lit(c)))
    auc = roc_auc(scored_fn(every).select(F.col("_variant").alias("model"), "score", F.col(label).alias("label"))).collect()
    of = {r.model: float(r.roc_auc) for r in auc if r.roc_auc is not None}  # one row a column
    return df.sparkSession.createDataFrame([(c, of[""], of[c], of[""] - of[c]) for c in cols if c in of],
                                           "feature string, base_auc double, permuted_auc double, drop double")
