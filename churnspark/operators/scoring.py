"""Scoring in batch and (through ``churnspark.streaming``) as a stream
(I1-I10): the whole path raw record -> decision is one lazy plan of column
expressions plus the fitted ML stages, so it runs wherever the data is."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark import schemas as S
from churnspark.functions.features import add_features
from churnspark.operators import clean as C


def prepare(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw record -> cleaned feature row: P1 -> P2 -> P6 -> P13 -> P8 -> P14
    -> P11 -> P12 -> F7 (no imputation: the fitted preprocessor imputes)."""
    df = C.alias_columns(C.snake_columns(raw))
    df = C.select_inputs(df, keep=[k for k in keep if k in df.columns])
    df = C.canonicalize(df)
    df = df.withColumns({c: F.col(c).try_cast("double") for c in ("monthly_charges", "total_charges")})
    df = df.withColumn("tenure_months", F.col("tenure_months").try_cast("int"))
    df = C.normalize_phone(df)
    df, _ = C.normalize_no_service(df)
    df, _ = C.fix_inconsistent_services(df)
    return add_features(df)


def decide(df: DataFrame, threshold: float | Column = S.DEFAULT_THRESHOLD, cost: float = 73.52,
           version: str = "v1", prob: str = "probability") -> DataFrame:
    """Probability (6 decimals), churn / no_churn by >= threshold, action
    cost when churn, model version."""
    p = F.round(vector_to_array(F.col(prob))[1], 6) if prob == "probability" else F.round(F.col(prob), 6)
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    churn = p >= t
    return df.withColumns({
        "churn_probability": p,
        "prediction": F.when(churn, "churn").otherwise("no_churn"),
        "action_cost": F.when(churn, F.lit(cost)).otherwise(F.lit(0.0)),
        "model_version": F.lit(version),
        "threshold": t})


def score(raw: DataFrame, preprocessor, model, threshold=S.DEFAULT_THRESHOLD, keep: Sequence[str] = ("customerid",),
          version: str = "v1") -> DataFrame:
    """The full path from raw records to decisions, one lazy plan."""
    x = preprocessor.transform(prepare(raw, keep))
    return decide(model.transform(x), threshold, version=version).select(
        *keep, "churn_probability", "prediction", "action_cost", "model_version", "threshold")


def mlp_forward(df: DataFrame, weights: Sequence[tuple[np.ndarray, np.ndarray]], features: str = "features_arr",
                out: str = "score", layer_norm: bool = False, keep: Sequence[str] = (),
                hidden_activation: str = "relu") -> DataFrame:
    """Forward pass of a given network (linear -> [layer norm] -> ReLU
    (or sigmoid) ... -> linear -> sigmoid) over Arrow batches with NumPy; the
    weights are a size-bounded broadcast."""
    ws = [(np.asarray(w, dtype=np.float64), np.asarray(b, dtype=np.float64)) for w, b in weights]
    sc = df.sparkSession.sparkContext.broadcast(ws)

    def fwd(batches):
        layers = sc.value
        for pdf in batches:
            x = np.stack(pdf[features].to_numpy()) if len(pdf) else np.zeros((0, layers[0][0].shape[1]))
            for i, (w, b) in enumerate(layers):
                x = x @ w.T + b
                if i < len(layers) - 1:
                    if layer_norm:
                        mu = x.mean(axis=1, keepdims=True)
                        sd = x.std(axis=1, keepdims=True)
                        x = (x - mu) / np.sqrt(sd * sd + 1e-5)
                    x = np.maximum(x, 0.0) if hidden_activation == "relu" else 1.0 / (1.0 + np.exp(-x))
            res = pdf[list(keep)].copy() if keep else pd.DataFrame(index=pdf.index)
            res[out] = 1.0 / (1.0 + np.exp(-x[:, 0]))
            yield res

    schema = T.StructType([df.schema[k] for k in keep] + [T.StructField(out, T.DoubleType())])
    return df.select(*keep, features).mapInPandas(fwd, schema)


def resolve_threshold(spark, sources: Sequence[str], default: float = S.DEFAULT_THRESHOLD) -> tuple[float, str]:
    """I4: first readable JSON source with a ``threshold`` (top level or under
    ``test_metrics``) wins; unreadable or missing sources fall through."""
    for path in sources:
        try:
            d = spark.read.option("multiLine", True).json(path)
            for c in ("threshold", "test_metrics.threshold"):
                try:
                    v = d.select(F.col(c)).first()
                except Exception:  # noqa: BLE001 - absent key: try the next spelling
                    continue
                if v is not None and v[0] is not None:
                    return float(v[0]), path
        except Exception:  # noqa: BLE001 - unreadable file: next source
            continue
    return float(default), "default"


def priority_tier(p: Column) -> Column:
    """>= .70 high, .50-.69 medium, .30-.49 low, else none."""
    out = None
    for bound, name in S.PRIORITY_TIERS:
        out = F.when(p >= bound, F.lit(name)) if out is None else out.when(p >= bound, F.lit(name))
    return out.otherwise(F.lit("none"))


def score_bands(df: DataFrame, score: str = "score", label: str = "label", keys: Sequence[str] = ()) -> DataFrame:
    """Bands <25, 25-50, 50-75, >75 (%) with n, churners and rate."""
    s = F.col(score)
    band = None
    for bound, name in S.SCORE_BANDS:
        band = F.when(s < bound, F.lit(name)) if band is None else band.when(s < bound, F.lit(name))
    band = band.otherwise(F.lit(">75"))
    return df.groupBy(*keys, band.alias("band")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.sum(F.col(label)).cast("bigint").alias("churners"),
        F.avg(F.col(label).cast("double")).alias("rate"))


def contact_list(df: DataFrame, k: int, by: str | None = None, score: str = "score", key: str = "id",
                 salts: int = 64) -> DataFrame:
    """I8: the k highest-risk rows (ties by key), globally or per segment.

    Per segment the top-k runs in two stages: top-k inside (segment, salt)
    (salt = hash of the key), then top-k of the <= salts*k survivors, so a
    huge segment is ranked by many tasks.  The limit is the feature."""
    order = [F.col(score).desc(), F.col(key).asc()]
    if by is None:
        return df.orderBy(*order).limit(k)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(key)), F.lit(salts)))
    w1 = Window.partitionBy(by, "_salt").orderBy(*order)
    s1 = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k).drop("_r", "_salt")
    w2 = Window.partitionBy(by).orderBy(*order)
    return s1.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)


def readiness(spark, model_path: str | None, preprocessor_path: str | None, version: str,
              threshold: float) -> DataFrame:
    """One-row readiness table (artifacts present, version, threshold).

    Presence is checked through the Hadoop filesystem of each path, so model
    folders may live on any shared storage."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def ok(p):
        if not p:
            return False
        hp = jvm.org.apache.hadoop.fs.Path(p)
        return bool(hp.getFileSystem(conf).exists(hp))

    return spark.createDataFrame([(ok(model_path), ok(preprocessor_path), version, float(threshold))],
                                 "model_loaded boolean, preprocessor_loaded boolean, version string, threshold double")


def batch_score_job(raw: DataFrame, preprocessor, model, out_path: str, score_date: str,
                    threshold=S.DEFAULT_THRESHOLD, keep: Sequence[str] = ("customerid",)) -> DataFrame:
    """Nightly scoring to a dated partition (S12): overwriting only that
    partition makes a retried run harmless."""
    from churnspark.sources.io import write_predictions
    s = score(raw, preprocessor, model, threshold, keep).withColumn("score_date", F.lit(score_date))
    write_predictions(s, out_path)
    return s


def nightly_scores(records: DataFrame, scorer: Callable[[DataFrame], DataFrame], out_path: str, score_date: str,
                   log_root: str | None = None, run_id: str | None = None) -> int:
    """I7 with any scorer: one night's customers into the dated table (S12), and
    a row in the run log (S13).  The night's date is replaced as a whole, so a
    run that was cut short or saw half its input is simply run again; other
    dates are not touched.  Returns the rows that the date now has, counted in
    the written table: what was scored need not be computed twice for it."""
    from churnspark.sources.io import log_run, write_predictions
    spark = records.sparkSession
    write_predictions(scorer(records).withColumn("score_date", F.lit(score_date)), out_path)
    n = spark.read.parquet(out_path).where(F.col("score_date").cast("string") == score_date).count()
    if log_root:
        log_run(spark, log_root, run_id or score_date, "nightly", {"score_date": score_date}, {"rows": n}, {"job": "nightly"})
    return n
