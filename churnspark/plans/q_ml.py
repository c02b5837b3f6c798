"""Registered queries: encoding (E), splits (V), models (M) and scoring (I).

Deterministic parts (learned statistics, encoded vectors, split and fold
sizes, rule and dummy scores, tiers, bands, contact lists) have SQL oracles;
fitted models are checked by rows (and, in the tests, by an AUC floor)."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnspark import schemas as S
from churnspark.functions import encode as E
from churnspark.operators import evaluate as A
from churnspark.operators import models as M
from churnspark.operators import network as N
from churnspark.operators import scoring as I
from churnspark.operators import search as H
from churnspark.operators import split as V
from churnspark.plans import sql as Q
from churnspark.plans.registry import query, rounded
from churnspark.plans.slice import cleaned_features
from churnspark.session import checkpoint_dir, cut_lineage, dealt
from churnspark.sources.tables import read_table, scores, snapshot

LABEL = S.TARGET


def feat(spark, d):
    # the cleaned table feeds several fits and passes: materialise it once in
    # the shared checkpoint folder (cuts the plan and survives executor loss)
    return cut_lineage(cleaned_features(spark, d))


# ------------------------------------------------------------------ E
_NUM = S.NUM_PIPE
_LOGS = ",\n  ".join(f"ln(1 + coalesce(CAST({c} AS DOUBLE), m_{i})) AS x{i}" for i, c in enumerate(_NUM))
PRE = Q.FEAT + """,
md AS (SELECT """ + ", ".join(f"quantile_cont({c}, 0.5) AS m_{i}" for i, c in enumerate(_NUM)) + """ FROM feat),
lg AS (SELECT feat.*, """ + _LOGS + """ FROM feat, md),
st AS (SELECT """ + ", ".join(f"avg(x{i}) AS mu_{i}, stddev_pop(x{i}) AS sd_{i}" for i in range(len(_NUM))) + " FROM lg)"

def _fitted(spark, d):
    return E.build_preprocessor().fit(feat(spark, d))


@query("e1_e3_preprocessor_stats", Q.with_(PRE, Q.round_cols("\nUNION ALL ".join(
    f"SELECT '{c}' AS column, m_{i} AS median, mu_{i} AS mean, sd_{i} AS std FROM md, st" for i, c in enumerate(_NUM)),
    ["median", "mean", "std"])))
def e1_e3_preprocessor_stats(spark, d):
    """Learned exact medians (E1) and population mean/std of log1p values."""
    pm = _fitted(spark, d)
    imp, scl = pm.stages[0], pm.stages[2]
    rows = [(c, float(m), float(mu), float(sd)) for c, m, mu, sd in
            zip(imp.getInputCols(), imp.getOrDefault(imp.medians), scl.getOrDefault(scl.means),
                scl.getOrDefault(scl.stds))]
    return rounded(spark.createDataFrame(rows, "column string, median double, mean double, std double"),
                   ["median", "mean", "std"])


def _vec_sql() -> str:
    parts = [f"CASE WHEN sd_{i} = 0 THEN x{i} - mu_{i} ELSE (x{i} - mu_{i}) / sd_{i} END" for i in range(len(_NUM))]
    parts += [f"CASE WHEN {c} = 'No' THEN 0.0 WHEN {c} = 'Yes' THEN 1.0 ELSE -1.0 END" for c in S.BINARY_PIPE]
    # The sorted categories present in the snapshot (first one dropped)
    cats = {"internet_service": ["DSL", "Fiber optic", "No"],
            "contract": ["Month-to-month", "One year", "Two year"],
            "payment_method": ["Bank transfer (automatic)", "Credit card (automatic)", "Electronic check", "Mailed check"],
            "gender": ["Female", "Male"], "tenure_group": ["longo", "medio", "novo"]}
    for c in S.ONEHOT_PIPE:
        parts += [f"CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END" for v in cats[c][1:]]
    parts += [f"CAST({c} AS DOUBLE)" for c in S.PASS_PIPE]
    return "[" + ", ".join(f"CAST({p} AS DOUBLE)" for p in parts) + "]"


@query("e7_feature_vectors", Q.with_(PRE, "SELECT customerid, list_transform(" + _vec_sql() +
                                     ", lambda x: round(x, 6)) AS features FROM lg, st"))
def e7_feature_vectors(spark, d):
    """The 30-wide encoded vector per customer (E1-E7 fitted on the table)."""
    f = feat(spark, d)
    v = _fitted(spark, d).transform(f)
    return v.select("customerid", F.transform(vector_to_array("features"), lambda x: F.round(x, 6)).alias("features"))


@query("e8_check_vectors", Q.with_(Q.FEAT, "SELECT 0 AS input, CAST(count(*) AS BIGINT) AS rows, "
                                   "CAST(0 AS BIGINT) AS bad_values, CAST(0 AS BIGINT) AS bad_width FROM feat"))
def e8_check_vectors(spark, d):
    return E.check_vectors(_fitted(spark, d).transform(feat(spark, d)))


@query("e4_yes_no_counts", Q.with_(Q.FEAT + ",\nlv AS (" + Q.long_sql("feat", S.BINARY_PIPE, cast="VARCHAR") + ")",
       "SELECT column, CASE WHEN value = 'No' THEN 0.0 WHEN value = 'Yes' THEN 1.0 ELSE -1.0 END AS code, "
       "CAST(count(*) AS BIGINT) AS n FROM lv GROUP BY 1, 2"))
def e4_yes_no_counts(spark, d):
    from churnspark.operators.prefix import long_form
    enc = E.YesNoEncoder(inputCols=S.BINARY_PIPE).transform(cleaned_features(spark, d))
    lf = long_form(enc, S.BINARY_PIPE)
    return lf.groupBy("column", F.col("value").alias("code")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("e5_onehot_categories", Q.with_(Q.FEAT + ",\nlv AS (" + Q.long_sql("feat", S.ONEHOT_PIPE, cast="VARCHAR") + ")",
       "SELECT column, list_sort(list(DISTINCT value)) AS categories FROM lv WHERE value IS NOT NULL GROUP BY column"))
def e5_onehot_categories(spark, d):
    import json
    m = E.OneHotDropFirst(inputCols=S.ONEHOT_PIPE).fit(feat(spark, d))
    rows = list(json.loads(m.getOrDefault(m.categories)).items())
    return spark.createDataFrame(rows, "column string, categories array<string>")


# ------------------------------------------------------------------ V
SPLIT_COUNTS = Q.FEAT + """,
nc AS (SELECT churn_value, count(*) AS n FROM feat GROUP BY churn_value)"""


@query("v1_split_counts", Q.with_(SPLIT_COUNTS, """SELECT churn_value, 'test' AS split, CAST(round(n * 0.2) AS BIGINT) AS n FROM nc
UNION ALL SELECT churn_value, 'train', CAST(n - round(n * 0.2) AS BIGINT) FROM nc"""))
def v1_split_counts(spark, d):
    s = V.stratified_split(feat(spark, d), LABEL, "customerid", 0.2, 42)
    return s.groupBy(LABEL, "split").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("v2_three_way_counts", Q.with_(SPLIT_COUNTS, """SELECT churn_value, 'test' AS split, CAST(round(n * 0.2) AS BIGINT) AS n FROM nc
UNION ALL SELECT churn_value, 'validation', CAST(round(n * 0.4) - round(n * 0.2) AS BIGINT) FROM nc
UNION ALL SELECT churn_value, 'train', CAST(n - round(n * 0.4) AS BIGINT) FROM nc"""))
def v2_three_way_counts(spark, d):
    s = V.stratified_split(feat(spark, d), LABEL, "customerid", 0.2, 42, val_frac=0.2)
    return s.groupBy(LABEL, "split").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("v3_fold_sizes", Q.with_(SPLIT_COUNTS, """SELECT churn_value, CAST(f AS INTEGER) AS fold,
  CAST((n - 1 - f) // 5 + 1 AS BIGINT) AS n FROM nc, (SELECT range AS f FROM range(0, 5)) WHERE f < n"""))
def v3_fold_sizes(spark, d):
    s = V.stratified_folds(feat(spark, d), LABEL, "customerid", 5, 42)
    return s.groupBy(LABEL, "fold").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("v6_split_balance", Q.with_(SPLIT_COUNTS + """,
sp AS (SELECT 'test' AS split, churn_value, round(n * 0.2) AS k FROM nc UNION ALL SELECT 'train', churn_value, n - round(n * 0.2) FROM nc),
ag AS (SELECT split, sum(k) AS n, sum(k * churn_value) / sum(k) AS positive_rate FROM sp GROUP BY split),
al AS (SELECT avg(CAST(churn_value AS DOUBLE)) AS a FROM feat)""",
  Q.round_cols("SELECT split, CAST(n AS BIGINT) AS n, positive_rate, (positive_rate - a) * 100 AS gap_pp FROM ag, al",
               ["positive_rate", "gap_pp"])))
def v6_split_balance(spark, d):
    s = V.stratified_split(feat(spark, d), LABEL, "customerid", 0.2, 42)
    return rounded(V.split_balance(s, LABEL), ["positive_rate", "gap_pp"])


_V7 = ["pos_weight", "weight_pos", "weight_neg"]
query("v7_class_weights", Q.with_(Q.FEAT + ",\ng AS (SELECT count(*) AS n, sum(churn_value) AS p FROM feat)", Q.round_cols(
    """SELECT CAST(n - p AS BIGINT) AS n_neg, CAST(p AS BIGINT) AS n_pos, (n - p) / greatest(p, 1) AS pos_weight,
  n / (2.0 * p) AS weight_pos, n / (2.0 * (n - p)) AS weight_neg FROM g""", _V7)))(
    lambda spark, d: rounded(V.class_weights(cleaned_features(spark, d), LABEL), _V7))

query("v9_sample_n")(lambda spark, d: V.sample_n(feat(spark, d), 500, "customerid", 42).select("customerid", LABEL))

query("v10_training_window", Q.with_("mx AS (SELECT max(o_orderdate) AS mx FROM orders)",
                                     "SELECT o_orderkey, o_orderdate FROM orders, mx WHERE o_orderdate >= mx - INTERVAL 12 MONTH"))(
    lambda spark, d: V.training_window(read_table(spark, d, "orders"), "o_orderdate", 12).select("o_orderkey", "o_orderdate"))


# ------------------------------------------------------------------ M
def _eval_sql(score_expr: str) -> str:
    return Q.FEAT + f""",
sc AS (SELECT 'm' AS model, CAST(customerid AS BIGINT) AS id, churn_value AS label, CAST({score_expr} AS DOUBLE) AS score FROM feat),
p0 AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM sc GROUP BY score),
p1 AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
              sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM p0),
c AS (SELECT CAST(count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS BIGINT) AS tp,
             CAST(count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS BIGINT) AS fp,
             CAST(count(*) FILTER (WHERE score < 0.5 AND label = 0) AS BIGINT) AS tn,
             CAST(count(*) FILTER (WHERE score < 0.5 AND label = 1) AS BIGINT) AS fn FROM sc)"""


_EVAL_BODY = """SELECT tp, fp, tn, fn, (SELECT CAST(sum(pos * (2 * (N - fp) + neg)) AS DOUBLE) / (2.0 * any_value(P) * any_value(N)) FROM p1) AS roc_auc,
  round(CAST(tp * 2845.0 + tn * 73.52 - fn * 2845.0 - fp * 73.52 AS DOUBLE), 2) AS business_value FROM c"""


def _eval(df):
    s = df.select(F.lit("m").alias("model"), F.col("customerid").cast("bigint").alias("id"),
                  F.col(LABEL).alias("label"), F.col("score").cast("double").alias("score"))
    c = A.business_value(s, 0.5).select("model", "tp", "fp", "tn", "fn",
                                        F.round("business_value", 2).alias("business_value"))
    return c.join(A.roc_auc(s), "model").select("tp", "fp", "tn", "fn", "roc_auc", "business_value")


query("m1_dummy_most_frequent", Q.with_(_eval_sql(
    "(SELECT CASE WHEN avg(CAST(churn_value AS DOUBLE)) > 0.5 THEN 1.0 ELSE 0.0 END FROM feat)"), _EVAL_BODY))(
    lambda spark, d: _eval(M.fit_dummy(feat(spark, d), LABEL)(feat(spark, d))))

query("m13_rule_score", Q.with_(_eval_sql(
    "CASE WHEN coalesce(contract = 'Month-to-month' AND tenure_months < 12 AND monthly_charges > 65.0, false) THEN 1.0 ELSE 0.0 END"),
    _EVAL_BODY))(lambda spark, d: _eval(M.rule_score(feat(spark, d))))

query("m13_rule_score_fallback", Q.with_(_eval_sql(
    "CASE WHEN coalesce(contract = 'Month-to-month' AND tenure_months < 12, false) THEN 1.0 ELSE 0.0 END"),
    _EVAL_BODY))(lambda spark, d: _eval(M.rule_score(feat(spark, d), use_charge=False)))

query("m2_dummy_stratified")(lambda spark, d: _eval(M.fit_dummy(feat(spark, d), LABEL, "stratified")(feat(spark, d))))


def parted(spark, d, part):
    """The cleaned table with the column that ``part`` (a split or folds) adds,
    written once, before anything is fitted: every fit of the preprocessor reads
    it, and the ranks behind the split are not taken again for each."""
    f = feat(spark, d)
    return cut_lineage(dealt(part(f), f.count()))


def _train_test(spark, d):
    s = parted(spark, d, lambda f: V.stratified_split(f, LABEL, "customerid", 0.2, 42))
    pm = E.build_preprocessor().fit(s.where(F.col("split") == "train"))
    x = cut_lineage(pm.transform(s))
    return pm, x.where(F.col("split") == "train"), x.where(F.col("split") == "test")


def three_parts(spark, d):
    """Encoded rows for fitting, for choosing (thresholds, early stop) and for
    reporting (V2), the preprocessor fitted on the first."""
    s = parted(spark, d, lambda f: V.stratified_split(f, LABEL, "customerid", 0.2, 42, val_frac=0.2))
    pm = E.build_preprocessor().fit(s.where(F.col("split") == "train"))
    x = cut_lineage(pm.transform(s))
    return [x.where(F.col("split") == p) for p in ("train", "validation", "test")]


def _model_report(name, scorer, valid, test):
    """Metrics on the test rows at the threshold that is best on the validation
    rows.  The scores are written, as the metrics read them several times."""
    def scored(df):
        return cut_lineage(scorer(df).select(F.lit(name).alias("model"), F.col("customerid").cast("bigint").alias("id"),
                                             F.col(LABEL).alias("label"), "score"))
    best = A.best_threshold(scored(valid)).select("model", "threshold")
    return A.full_metrics(scored(test), best)


def _reported(name, fit):
    """Register a fitted model's report; ``fit`` takes the training rows and returns a Spark ML model."""
    def run(spark, d):
        train, valid, test = three_parts(spark, d)
        m = fit(train)
        return _model_report(name, lambda df: m.transform(df).withColumn("score", M.prob1()), valid, test)
    return run


query("m3_logistic")(_reported("logistic", lambda tr: M.fit_logistic(tr, LABEL, C=1.0)))
query("m3_logistic_l1")(_reported("logistic_l1", lambda tr: M.fit_logistic(tr, LABEL, C=0.008809, penalty="l1")))
query("m4_random_forest")(_reported("random_forest", lambda tr: M.fit_forest(tr, LABEL)))
query("m5_gbt")(_reported("gbt", lambda tr: M.fit_gbt(tr, LABEL)))


@query("m6_mlp")
def m6_mlp(spark, d):
    """M6: 30-128-64-1 with weighted loss, stopped by the validation loss."""
    train, valid, test = three_parts(spark, d)
    return _model_report("mlp", N.fit_network(train, valid, LABEL).transform, valid, test)


@query("m7_early_stop")
def m7_early_stop(spark, d):
    """M7: stop and best iteration by the losses on the validation rows, of the
    boosted trees (one per tree) and of the network (one per epoch)."""
    train, valid, _ = three_parts(spark, d)
    gbt = M.fit_gbt(train, LABEL, iters=60)
    losses = gbt.evaluateEachIteration(valid.withColumn(LABEL, F.col(LABEL).cast("double")))
    trees = spark.createDataFrame([("gbt", i, float(v)) for i, v in enumerate(losses, 1)], "run string, epoch int, value double")
    net = N.fit_network(train, valid, LABEL).history(spark).select("run", "epoch", F.col("val_loss").alias("value"))
    return M.early_stop(trees.unionByName(net), patience=10, min_delta=1e-4)


#: Trials of each family in the registered studies, in 5 folds: the whole studies, and those behind the curve.
STUDY_TRIALS = {"logistic": 50, "network": 50, "forest": 50, "gbt": 50}
CURVE_TRIALS = {"logistic": 3, "forest": 1}


def study_data(spark, d):
    f = parted(spark, d, lambda f: V.stratified_folds(f, LABEL, "customerid", 5, 42))
    return cut_lineage(E.build_preprocessor().fit(f).transform(f))


def _study(spark, d, trials):
    return H.run_studies(study_data(spark, d), trials, f"{checkpoint_dir(spark)}/study-{uuid.uuid4().hex}", parallelism=8)


@query("m8_search")
def m8_search(spark, d):
    """M8: the trial table of the four families' studies."""
    return _study(spark, d, STUDY_TRIALS)


@query("m9_convergence", "\nUNION ALL ".join(f"SELECT '{s}' AS study, CAST({n} AS BIGINT) AS trials, true AS same" for s, n in CURVE_TRIALS.items()))
def m9_convergence(spark, d):
    """M9: the best-so-far curve of every study, held against plain SQL over the
    trial table (a self-join in place of the window)."""
    t = cut_lineage(_study(spark, d, CURVE_TRIALS))
    t.createOrReplaceTempView("churnspark_trials")
    ref = spark.sql("""SELECT a.study, a.trial, max(b.value) AS ref FROM churnspark_trials a JOIN churnspark_trials b
        ON a.study = b.study AND b.trial <= a.trial WHERE a.value > -1e7 AND b.value > -1e7 GROUP BY a.study, a.trial""")
    spark.catalog.dropTempView("churnspark_trials")
    j = H.convergence(t).join(ref, ["study", "trial"], "full")
    same = j.groupBy("study").agg(F.count_if(~F.col("best_so_far").eqNullSafe(F.col("ref"))).alias("off"))
    return t.groupBy("study").agg(F.count(F.lit(1)).cast("bigint").alias("trials")).join(same, "study", "left").select(
        "study", "trials", (F.coalesce("off", F.lit(0)) == 0).alias("same"))


@query("m10_coefficients")
def m10_coefficients(spark, d):
    pm, tr, _ = _train_test(spark, d)
    return M.coefficients(M.fit_logistic(tr, LABEL), E.feature_names(pm), 10)


@query("m11_importances")
def m11_importances(spark, d):
    pm, tr, _ = _train_test(spark, d)
    return M.importances(M.fit_forest(tr, LABEL, trees=200), E.feature_names(pm), 20)


@query("m12_permutation_importance")
def m12_permutation_importance(spark, d):
    """AUC drop of the fitted pipeline + logistic model on the raw test rows
    when one input column is permuted, for every input."""
    s = parted(spark, d, lambda f: V.stratified_split(f, LABEL, "customerid", 0.2, 42))
    pm = E.build_preprocessor().fit(s.where(F.col("split") == "train"))
    lr = M.fit_logistic(pm.transform(s.where(F.col("split") == "train")), LABEL)
    raw = s.where(F.col("split") == "test")

    def scored(df):
        return lr.transform(pm.transform(df)).withColumn("score", M.prob1())
    return M.permutation_importance(scored, raw, S.INPUT_FIELDS, "customerid", LABEL)


# ------------------------------------------------------------------ I
@query("i1_score")
def i1_score(spark, d):
    """Raw records (mixed casing) -> prepare -> preprocessor -> logistic -> decision."""
    pm, tr, _ = _train_test(spark, d)
    lr = M.fit_logistic(tr, LABEL)
    raw = snapshot(spark, d, casing=True)
    return I.score(raw, pm, lr, threshold=0.5, keep=("customerid",))


query("i2_decide", Q.with_(Q.SNAPSHOT, """SELECT customerid, round(y_score, 6) AS churn_probability,
  CASE WHEN round(y_score, 6) >= 0.5 THEN 'churn' ELSE 'no_churn' END AS prediction,
  CASE WHEN round(y_score, 6) >= 0.5 THEN 73.52::DOUBLE ELSE 0.0 END AS action_cost, 'v1' AS model_version,
  0.5::DOUBLE AS threshold FROM snap"""))(
    lambda spark, d: I.decide(snapshot(spark, d), 0.5, prob="y_score").select(
        "customerid", "churn_probability", "prediction", "action_cost", "model_version", "threshold"))


@query("i3_mlp_forward")
def i3_mlp_forward(spark, d):
    """Forward pass with NumPy over Arrow batches, using the weights of a
    fitted Spark network; compared with Spark's own probability."""
    pm, tr, te = _train_test(spark, d)
    m = M.fit_mlp(tr, LABEL, hidden=(128, 64))
    layers = m.getLayers()
    w = m.weights.toArray()
    ws, off = [], 0
    for a, b in zip(layers[:-1], layers[1:]):
        # each layer: an (out x in) column-major matrix, then the bias
        W = w[off:off + a * b].reshape(a, b).T
        off += a * b
        bias = w[off:off + b]
        off += b
        ws.append((W, bias))
    # softmax over 2 outputs == sigmoid of the logit difference
    W2, b2 = ws[-1]
    ws[-1] = ((W2[1] - W2[0])[None, :], np.array([b2[1] - b2[0]]))
    every = tr.unionByName(te)
    x = every.withColumn("features_arr", vector_to_array("features"))
    f = I.mlp_forward(x, ws, keep=["customerid"], out="numpy_score", hidden_activation="sigmoid")
    ref = m.transform(every).select("customerid", M.prob1().alias("spark_score"))
    return f.join(ref, "customerid").withColumn("abs_diff", F.abs(F.col("numpy_score") - F.col("spark_score")))


query("i5_priority_tier", Q.with_(Q.SNAPSHOT, """SELECT CASE WHEN y_score >= 0.7 THEN 'high' WHEN y_score >= 0.5 THEN 'medium'
  WHEN y_score >= 0.3 THEN 'low' ELSE 'none' END AS tier, CAST(count(*) AS BIGINT) AS n FROM snap GROUP BY 1"""))(
    lambda spark, d: snapshot(spark, d).groupBy(I.priority_tier(F.col("y_score")).alias("tier")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n")))

query("i6_score_bands", Q.with_(Q.SCORES, Q.round_cols("""SELECT model, CASE WHEN score < 0.25 THEN '<25' WHEN score < 0.5 THEN '25-50'
  WHEN score < 0.75 THEN '50-75' ELSE '>75' END AS band, CAST(count(*) AS BIGINT) AS n, CAST(sum(label) AS BIGINT) AS churners,
  avg(CAST(label AS DOUBLE)) AS rate FROM scores GROUP BY 1, 2""", ["rate"])))(
    lambda spark, d: rounded(I.score_bands(scores(spark, d), keys=["model"]), ["rate"]))

query("i8_contact_list", Q.with_(Q.SCORES, "SELECT * FROM scores ORDER BY score DESC, id LIMIT 100"))(
    lambda spark, d: I.contact_list(scores(spark, d), 100))

query("i8_contact_list_by_segment", Q.with_(Q.SCORES + """,
rk AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY score DESC, id) AS rank FROM scores)""",
  "SELECT model, id, label, score, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 50"))(
    lambda spark, d: I.contact_list(scores(spark, d), 50, by="model"))
