"""Sampling, splitting, folds and class weights.

Splits are repeatable and exact in size without a global sort: each row gets
``xxhash64(key, seed)``; its rank inside its label comes from distributed
prefix counts (``cumulative`` with the key as tie-break, so the order is
total and a retried task reproduces the same assignment).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.operators.prefix import cumulative


def hash_rank(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Add ``_rank`` (1-based, per label, by seeded hash) and ``_n`` (label size)."""
    h = df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed)))
    c = cumulative(h, [label], "_h", {"_one": F.lit(1).cast("bigint")}, distinct=False, tiebreak=[key])
    return c.withColumnsRenamed({"cum__one": "_rank", "all__one": "_n"}).drop("_one", "prev__one", "_h")


def stratified_split(df: DataFrame, label: str, key: str, test_frac: float = 0.2,
                     seed: int = 42, val_frac: float = 0.0) -> DataFrame:
    """V1 / V2: ``split`` column = test for rank <= round(n_label * test_frac),
    then validation for the next round(n_label * val_frac), else train."""
    r = hash_rank(df, label, key, seed)
    t = F.round(F.col("_n") * test_frac)
    v = F.round(F.col("_n") * (test_frac + val_frac))
    split = F.when(F.col("_rank") <= t, "test")
    if val_frac:
        split = split.when(F.col("_rank") <= v, "validation")
    return r.withColumn("split", split.otherwise("train")).drop("_rank", "_n")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """V3: ``fold`` = (rank - 1) mod k inside each label: sizes differ by at
    most one per label."""
    r = hash_rank(df, label, key, seed)
    return r.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_n")


def oof_scores(df: DataFrame, fit: Callable[[DataFrame], object], fold: str = "fold",
               k: int = 5, prob_col: str = "probability") -> DataFrame:
    """V4: out-of-fold probability per row: fit on k-1 folds, score the held
    fold, union.  The driver loops over the k folds only."""
    from pyspark.ml.functions import vector_to_array
    out = None
    for i in range(k):
        m = fit(df.where(F.col(fold) != i))
        s = m.transform(df.where(F.col(fold) == i))
        s = s.withColumn("oof_score", vector_to_array(prob_col)[1]).drop(
            "rawPrediction", "probability", "prediction")
        out = s if out is None else out.unionByName(s)
    return out


def oof_table(df: DataFrame, fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]], path: str,
              keep: Sequence[str], fold: str = "fold", parallelism: int = 4) -> DataFrame:
    """V4 as a job that survives losses: ``keep`` and ``score`` for every row, out of fold.

    ``fit`` takes the rows of the other folds and returns a function that adds
    ``score``.  The folds are fitted and scored side by side; each writes its
    rows to its own folder ``path/<fold>=i``.  A fold whose folder is complete
    is not fitted again, so after a failure the same call does only what is
    missing.  All folds are tried before a failure is raised.  Rows without a
    fold are in no fold's training or test rows and get no score."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def complete(i) -> bool:
        mark = jvm.org.apache.hadoop.fs.Path(f"{path}/{fold}={i}/_SUCCESS")
        return bool(mark.getFileSystem(conf).exists(mark))

    @inheritable_thread_target(spark)
    def one(i):
        try:
            score = fit(df.where(F.col(fold) != i))
            score(df.where(F.col(fold) == i)).select(*keep, "score").write.mode("overwrite").parquet(f"{path}/{fold}={i}")
        except Exception as e:  # noqa: BLE001 - raised below, once the other folds are written
            return i, e

    folds = [r[0] for r in df.select(fold).distinct().where(F.col(fold).isNotNull()).orderBy(fold).collect()]
    with ThreadPool(parallelism) as pool:
        failed = [x for x in pool.map(one, [i for i in folds if not complete(i)], chunksize=1) if x]
    if failed:
        raise RuntimeError(f"folds {[i for i, _ in failed]} of {len(folds)} failed") from failed[0][1]
    if not folds:
        return df.select(*keep, F.lit(None).cast("double").alias("score"), fold).limit(0)
    return spark.read.parquet(path)


def check_oof(df: DataFrame, oof: DataFrame, key: str, fold: str = "fold") -> DataFrame:
    """One row: rows with a fold, scored rows, rows scored in their own fold exactly once, rows without a score."""
    a = df.where(F.col(fold).isNotNull()).groupBy(key, fold).agg(F.count(F.lit(1)).alias("a"))
    b = oof.groupBy(key, fold).agg(F.count(F.lit(1)).alias("b"), F.count("score").alias("scored"))
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return a.join(b, [key, fold], "full").agg(
        n("a").alias("rows"), n("b").alias("out_rows"), n(F.when(F.col("a") == F.col("b"), F.col("a"))).alias("once"),
        n(F.col("b") - F.col("scored")).alias("null_scores"))


def fold_metrics(oof: DataFrame, threshold: float = 0.5, label: str = "label", fold: str = "fold") -> DataFrame:
    """``model, fold, metric, value`` of out-of-fold scores: rates at the threshold and ROC-AUC of every fold."""
    from churnspark.operators.evaluate import confusion, rates, roc_auc
    keys = ["model", fold]
    m = rates(confusion(oof, threshold, keys=keys, label=label)).join(roc_auc(oof, keys=keys, label=label), keys)
    names = ["precision", "recall", "f1", "specificity", "accuracy", "npv", "mcc", "roc_auc"]
    return m.select(*keys, F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in names])))


def cv_summary(metrics: DataFrame, keys: Sequence[str] = ("model", "metric")) -> DataFrame:
    """V5: mean and population std of each metric over folds."""
    return metrics.groupBy(*keys).agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
                                      F.count(F.lit(1)).cast("bigint").alias("folds"))


def split_balance(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """V6: positive rate per split and the gap to the overall rate (pp)."""
    overall = df.agg(F.avg(F.col(label).cast("double")).alias("_all"))
    g = df.groupBy(split).agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                              F.avg(F.col(label).cast("double")).alias("positive_rate"))
    j = g.withColumn("_j", F.lit(1)).join(F.broadcast(overall.withColumn("_j", F.lit(1))), "_j")
    return j.select(split, "n", "positive_rate", ((F.col("positive_rate") - F.col("_all")) * 100).alias("gap_pp"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """V7: pos_weight = n_neg / max(n_pos, 1) and balanced weights n / (2 n_c)."""
    g = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label)).alias("n_pos"))
    return g.select((F.col("n") - F.col("n_pos")).cast("bigint").alias("n_neg"), F.col("n_pos").cast("bigint"),
                    ((F.col("n") - F.col("n_pos")) / F.greatest(F.col("n_pos"), F.lit(1))).alias("pos_weight"),
                    (F.col("n") / (2.0 * F.col("n_pos"))).alias("weight_pos"),
                    (F.col("n") / (2.0 * (F.col("n") - F.col("n_pos")))).alias("weight_neg"))


def with_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced ``weightCol`` for Spark ML estimators (one-row table broadcast)."""
    w = class_weights(df, label).select("weight_pos", "weight_neg").withColumn("_j", F.lit(1))
    j = df.withColumn("_j", F.lit(1)).join(F.broadcast(w), "_j").drop("_j")
    return j.withColumn(out, F.when(F.col(label) == 1, F.col("weight_pos")).otherwise(F.col("weight_neg"))) \
            .drop("weight_pos", "weight_neg")


def cost_weight(pos_weight: float, fn_cost: float, fp_cost: float, scale: float = 10.0) -> float:
    """V8: class ratio x cost ratio / 10."""
    return pos_weight * (fn_cost / fp_cost) / scale


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """V9: fixed-size seeded sample (TakeOrdered on a hash; n is bounded)."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key)).limit(n)


def training_window(df: DataFrame, ts: str, months: int = 12) -> DataFrame:
    """Rows from the most recent ``months`` months of the table."""
    mx = df.agg(F.max(ts).alias("_mx")).withColumn("_j", F.lit(1))
    j = df.withColumn("_j", F.lit(1)).join(F.broadcast(mx), "_j")
    return j.where(F.col(ts) >= F.col("_mx") - F.expr(f"INTERVAL {int(months)} MONTHS")).drop("_j", "_mx")
