"""Registered queries: jobs that write tables and read them back.

Out-of-fold scores (V4, V5), nightly scoring (I7, S12), saved pipelines and
classifiers (S8, S9), the run log (S13, S16), the vector sink (S4), the
evidence-based feature drop (P20) and the checked sinks (S3, S5, S6, S7).  Each
job writes to a folder of its own in the shared checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from churnspark import schemas as S
from churnspark.functions import encode as E
from churnspark.operators import models as M
from churnspark.operators import scoring as I
from churnspark.operators import split as V
from churnspark.plans import sql as Q
from churnspark.plans.q_ml import LABEL, PRE, _vec_sql, feat, parted
from churnspark.plans.registry import query, rounded
from churnspark.session import checkpoint_dir, cut_lineage
from churnspark.sources import io
from churnspark.sources.tables import read_table, snapshot


def _folder(spark, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


# ------------------------------------------------------------------ V4, V5
#: Out-of-fold rates of (contract, internet_service), in folds by the customer's number.
OOF = Q.FEAT + """,
fd AS (SELECT customerid, contract, internet_service, churn_value, CAST(customerid % 5 AS INTEGER) AS fold FROM feat),
gf AS (SELECT contract, internet_service, fold, count(*) AS n, sum(churn_value) AS p FROM fd GROUP BY ALL),
ga AS (SELECT contract, internet_service, sum(n) AS n, sum(p) AS p FROM gf GROUP BY ALL),
tf AS (SELECT fold, sum(n) AS n, sum(p) AS p FROM gf GROUP BY fold),
ta AS (SELECT sum(n) AS n, sum(p) AS p FROM tf),
oof AS (SELECT fd.customerid, fd.churn_value, fd.fold, CAST(CASE WHEN ga.n > gf.n THEN CAST(ga.p - gf.p AS DOUBLE) / (ga.n - gf.n)
          ELSE CAST(ta.p - tf.p AS DOUBLE) / (ta.n - tf.n) END AS DOUBLE) AS score
        FROM fd JOIN gf USING (contract, internet_service, fold) JOIN ga USING (contract, internet_service) JOIN tf USING (fold), ta)"""


def _oof(spark, d):
    f = feat(spark, d).withColumn("fold", F.pmod("customerid", F.lit(5)).cast("int"))
    return V.oof_table(f, lambda train: M.fit_group_rate(train, ["contract", "internet_service"], LABEL),
                       _folder(spark, "oof"), ["customerid", LABEL])


@query("v4_oof_rates", Q.with_(OOF, Q.round_cols("SELECT customerid, churn_value, fold, score FROM oof", ["score"])))
def v4_oof_rates(spark, d):
    """V4: every customer scored by the fit that did not see it; closed-form scorer."""
    return rounded(_oof(spark, d), ["score"])


@query("v4_oof_logistic", Q.with_(Q.FEAT, """SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS out_rows,
  CAST(count(*) AS BIGINT) AS once, CAST(0 AS BIGINT) AS null_scores, 5 AS folds, true AS better_than_chance FROM feat"""))
def v4_oof_logistic(spark, d):
    """V4 with the preprocessor and a logistic fit inside every fold of V3."""
    from churnspark.operators.evaluate import roc_auc
    f = parted(spark, d, lambda f: V.stratified_folds(f, LABEL, "customerid", 5, 42))

    def fit(train):
        pm = E.build_preprocessor().fit(train)
        lr = M.fit_logistic(pm.transform(train), LABEL)
        return lambda df: lr.transform(pm.transform(df)).withColumn("score", M.prob1())

    oof = V.oof_table(f, fit, _folder(spark, "oof"), ["customerid", LABEL])
    auc = roc_auc(oof.withColumn("model", F.lit("logistic")), label=LABEL)
    n = oof.agg(F.countDistinct("fold").cast("int").alias("folds"))
    return V.check_oof(f, oof, "customerid").join(F.broadcast(n)).join(F.broadcast(auc)).select(  # one row each
        "rows", "out_rows", "once", "null_scores", "folds", (F.col("roc_auc") > 0.6).alias("better_than_chance"))


CV_T = 0.3
CV_METRICS = ["precision", "recall", "f1", "specificity", "accuracy", "npv", "mcc", "roc_auc"]


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"


@query("v5_cv_summary", Q.with_(OOF + f""",
cf AS (SELECT fold, CAST(count(*) FILTER (WHERE score >= {CV_T} AND churn_value = 1) AS DOUBLE) AS tp,
              CAST(count(*) FILTER (WHERE score >= {CV_T} AND churn_value = 0) AS DOUBLE) AS fp,
              CAST(count(*) FILTER (WHERE score < {CV_T} AND churn_value = 0) AS DOUBLE) AS tn,
              CAST(count(*) FILTER (WHERE score < {CV_T} AND churn_value = 1) AS DOUBLE) AS fn FROM oof GROUP BY fold),
rk AS (SELECT fold, churn_value, rank() OVER w + (count(*) OVER (PARTITION BY fold, score) - 1) / 2.0 AS r
       FROM oof WINDOW w AS (PARTITION BY fold ORDER BY score)),
au AS (SELECT fold, (sum(r) FILTER (WHERE churn_value = 1) - sum(churn_value) * (sum(churn_value) + 1) / 2.0)
                    / (sum(churn_value) * sum(1 - churn_value)) AS roc_auc FROM rk GROUP BY fold),
m0 AS (SELECT *, {_ratio("tp", "tp + fp")} AS precision, {_ratio("tp", "tp + fn")} AS recall FROM cf JOIN au USING (fold)),
m1 AS (SELECT *, {_ratio("2 * precision * recall", "precision + recall")} AS f1, {_ratio("tn", "tn + fp")} AS specificity,
              {_ratio("tp + tn", "tp + tn + fp + fn")} AS accuracy, {_ratio("tn", "tn + fn")} AS npv,
              {_ratio("tp * tn - fp * fn", "sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))")} AS mcc FROM m0)""",
  Q.round_cols("\nUNION ALL ".join(
      f"SELECT 'rates' AS model, '{c}' AS metric, avg({c}) AS mean, stddev_pop({c}) AS std, CAST(count(*) AS BIGINT) AS folds FROM m1"
      for c in CV_METRICS), ["mean", "std"])))
def v5_cv_summary(spark, d):
    """V5: mean and population deviation over the folds of each metric of the out-of-fold scores."""
    m = V.fold_metrics(_oof(spark, d).withColumn("model", F.lit("rates")), CV_T, LABEL)
    return rounded(V.cv_summary(m), ["mean", "std"])


# ------------------------------------------------------------------ I7, S12
NIGHTS = ["2000-06-30", "2000-07-31"]
ACTIVE = ", ".join(f"(DATE '{n}')" for n in NIGHTS)


def active_on(spark, d, night: str):
    """Raw records of the customers with an order in the twelve months up to ``night``."""
    o = read_table(spark, d, "orders")
    day = F.lit(night).cast("timestamp_ntz")
    last = o.where(F.col("o_orderdate") <= day).groupBy(F.col("o_custkey").alias("customerid")).agg(F.max("o_orderdate").alias("d"))
    return snapshot(spark, d, casing=True).join(
        last.where(F.col("d") >= day - F.expr("INTERVAL 12 MONTHS")).select("customerid"), "customerid", "left_semi")


@query("i7_nightly_scores", Q.with_(Q.SNAPSHOT + f""",
ng AS (SELECT * FROM (VALUES {ACTIVE}) t(night)),
ac AS (SELECT night, o_custkey AS customerid FROM orders, ng WHERE o_orderdate <= night GROUP BY ALL
       HAVING max(o_orderdate) >= night - INTERVAL 12 MONTH)""",
  """SELECT CAST(night AS VARCHAR) AS score_date, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT customerid) AS BIGINT) AS customers,
  CAST(count(*) FILTER (WHERE contract = 'Month-to-month' AND tenure_months < 60 AND monthly_charges > 50) AS BIGINT) AS at_risk,
  CAST(0 AS BIGINT) AS bad_scores, CAST(3 AS BIGINT) AS runs
FROM ac JOIN snap USING (customerid) GROUP BY night"""))
def i7_nightly_scores(spark, d):
    """Two nights are scored into a dated table by the fitted
    pipeline.  The first night's run sees half the customers (its input was not
    whole) and is run again: its date is replaced, the other stays.  The runs are
    logged (S13)."""
    pm, lr = _fitted_pair(spark, d)
    out, log = _folder(spark, "nightly"), _folder(spark, "nightly-log")

    def scorer(raw):
        rule = M.rule_score(I.prepare(raw, ["customerid"]), charge=50, tenure=60).select("customerid", F.col("score").alias("rule"))
        return I.score(raw, pm, lr, 0.5).join(rule, "customerid")

    first, second = (active_on(spark, d, n) for n in NIGHTS)
    for k, (rows, night) in enumerate([(first.where("customerid % 2 = 0"), NIGHTS[0]), (second, NIGHTS[1]), (first, NIGHTS[0])]):
        I.nightly_scores(rows, scorer, out, night, log_root=log, run_id=f"{night}-{k}")
    p = F.col("churn_probability")
    runs = io.search_runs(spark, log, ["rows"]).agg(F.count(F.lit(1)).cast("bigint").alias("runs"))
    return spark.read.parquet(out).groupBy(F.col("score_date").cast("string").alias("score_date")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.countDistinct("customerid").cast("bigint").alias("customers"),
        F.count_if(F.col("rule") == 1).cast("bigint").alias("at_risk"),
        F.count_if(p.isNull() | (p < 0) | (p > 1)).cast("bigint").alias("bad_scores")).join(F.broadcast(runs))  # one row


def _fitted_pair(spark, d):
    f = feat(spark, d)
    pm = E.build_preprocessor().fit(f)
    return pm, M.fit_logistic(pm.transform(f), LABEL)


# ------------------------------------------------------------------ S8, S9
ARTEFACTS = ["preprocessor", "logistic", "forest", "gbt", "mlp"]


@query("s8_s9_reload", Q.with_(Q.FEAT, "\nUNION ALL ".join(
    f"SELECT '{a}' AS artefact, CAST(count(*) AS BIGINT) AS rows, true AS same FROM feat" for a in ARTEFACTS)))
def s8_s9_reload(spark, d):
    """The fitted preprocessor and one classifier of each family are
    saved, loaded and compared on all rows (no difference above 1e-10)."""
    f = feat(spark, d)
    pm = E.build_preprocessor().fit(f)
    x = cut_lineage(pm.transform(f))
    fits = [("preprocessor", pm, f, "features"), ("logistic", M.fit_logistic(x, LABEL), x, "probability"),
            ("forest", M.fit_forest(x, LABEL, trees=20, depth=5), x, "probability"),
            ("gbt", M.fit_gbt(x, LABEL, iters=10), x, "probability"),
            ("mlp", M.fit_mlp(x, LABEL, hidden=(8,), max_iter=20), x, "probability")]
    out = None
    for name, model, rows, col in fits:
        r = io.reload_check(model, _folder(spark, name), rows, "customerid", col).select(
            F.lit(name).alias("artefact"), "rows", "same")
        out = r if out is None else out.unionByName(r)
    return out


# ------------------------------------------------------------------ S13, S16
#: Rule scorers (M13) that are compared: charge and tenure bounds.
RULES = [(c, t) for c in (50, 65, 80) for t in (12, 24)]


@query("s13_s16_run_log", Q.with_(Q.FEAT + ",\nrl AS (SELECT * FROM (VALUES " + ", ".join(
    f"('rule-{c}-{t}', {c}, {t})" for c, t in RULES) + """) r(run_id, charge, tenure)),
cf AS (SELECT run_id, tenure, count(*) FILTER (WHERE hit AND churn_value = 1) AS tp, count(*) FILTER (WHERE hit AND churn_value = 0) AS fp,
              count(*) FILTER (WHERE NOT hit AND churn_value = 0) AS tn, count(*) FILTER (WHERE NOT hit AND churn_value = 1) AS fn
       FROM (SELECT run_id, tenure, churn_value, contract = 'Month-to-month' AND tenure_months < tenure AND monthly_charges > charge AS hit
             FROM feat, rl) GROUP BY ALL),
mt AS (SELECT run_id, tenure, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
              CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
              CAST(tp * 2845.0 + tn * 73.52 - fn * 2845.0 - fp * 73.52 AS DOUBLE) AS business_value FROM cf)""",
  Q.round_cols("""SELECT run_id, CAST(tenure AS VARCHAR) AS tenure, recall, precision, business_value,
  business_value = max(business_value) OVER () AS best FROM mt WHERE tenure = 24""", ["recall", "precision", "business_value"])))
def s13_s16_run_log(spark, d):
    """Six rule scorers are logged with their parameters and metrics,
    then searched by a parameter, compared and the best one marked.  The recall is
    logged twice (steps 0 and 1); the last step counts."""
    from churnspark.operators import evaluate as A
    log, f = _folder(spark, "runs"), feat(spark, d)
    both = None
    for c, t in RULES:  # all rules in one pass over the customers
        s = M.rule_score(f, charge=c, tenure=t).select(F.lit(f"rule-{c}-{t}").alias("model"), F.col(LABEL).alias("label"), "score")
        both = s if both is None else both.unionByName(s)
    m = A.rates(A.business_value(both, 0.5)).collect()  # one row a rule
    of = {r["model"]: r for r in m}
    for c, t in RULES:
        r = of[f"rule-{c}-{t}"]
        io.log_run(spark, log, r["model"], "rule", {"charge": c, "tenure": t},
                   [(0, "recall", -1.0), (1, "recall", r["recall"]), (0, "precision", r["precision"]),
                    (0, "business_value", r["business_value"])], {"stage": "comparison"})
    found = io.search_runs(spark, log, ["recall", "precision", "business_value"],
                           (F.col("tags")["stage"] == "comparison") & (F.col("params")["tenure"] == "24"))
    top = found.agg(F.max("business_value").alias("_top"))
    return rounded(found.join(F.broadcast(top)).select(  # one row
        "run_id", F.col("params")["tenure"].alias("tenure"), "recall", "precision", "business_value",
        (F.col("business_value") == F.col("_top")).alias("best")), ["recall", "precision", "business_value"])


# ------------------------------------------------------------------ S4, E9
@query("s4_vectors", Q.with_(PRE, "SELECT CAST(count(*) AS BIGINT) AS rows, 30 AS width, CAST(0 AS BIGINT) AS null_labels, "
                             "CAST(sum(churn_value) AS BIGINT) AS positives, CAST(sum(list_sum(list_slice(v, " + str(len(S.NUM_PIPE) + 1) + ", 30))) AS BIGINT) AS checksum, "
                             "'array<float>' AS kind FROM (SELECT churn_value, " + _vec_sql() + " AS v FROM lg, st)"))
def s4_vectors(spark, d):
    """The float32 matrix is written, read back and checked: type, width,
    labels, and the sum of the encoded columns (whole numbers, exact in float32)."""
    x = E.build_preprocessor().fit(f := feat(spark, d)).transform(f)
    path = _folder(spark, "vectors")
    io.write_vectors(x, path, width=S.N_FEATURES)
    back = io.read_vectors(spark, path, S.N_FEATURES)
    n = len(S.NUM_PIPE)
    tail = F.aggregate(F.slice("features", n + 1, S.N_FEATURES - n), F.lit(0.0), lambda a, v: a + v)
    return back.agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.max(F.size("features")).alias("width"),
                    F.count_if(F.col("label").isNull()).cast("bigint").alias("null_labels"), F.sum("label").cast("bigint").alias("positives"),
                    F.sum(tail).cast("bigint").alias("checksum"),
                    F.lit(back.schema["features"].dataType.simpleString()).alias("kind"))


@query("e9_dense", Q.with_(PRE, "SELECT customerid, list_transform(list_slice(v, " + str(len(S.NUM_PIPE) + 1) + ", 30), lambda x: CAST(x AS INTEGER)) AS encoded FROM "
                           "(SELECT customerid, " + _vec_sql() + " AS v FROM lg, st)"))
def e9_dense(spark, d):
    """The assembled vectors (sparse where that is smaller) as dense arrays; the encoded columns of every customer."""
    x = E.build_preprocessor().fit(f := feat(spark, d)).transform(f)
    n = len(S.NUM_PIPE)
    return E.to_dense(x).select("customerid", F.slice("features_arr", n + 1, S.N_FEATURES - n).cast("array<int>").alias("encoded"))


# ------------------------------------------------------------------ P4, P20
@query("p4_shape", Q.with_(Q.FEAT, "SELECT CAST(count(*) AS BIGINT) AS rows, CAST([] AS VARCHAR[]) AS missing, "
                           "['state'] AS extra, true AS rejected FROM feat"))
def p4_shape(spark, d):
    """The cleaned table's count and columns against the customer table's, and a count that is off is rejected."""
    from churnspark.operators import clean as C
    f, n = feat(spark, d), read_table(spark, d, "customer").count()
    expected = [c for c in f.columns if c != "state"]
    found = {"missing": sorted(set(expected) - set(f.columns)), "extra": sorted(set(f.columns) - set(expected))}
    rows = C.check_shape(f, n)["rows"]
    rejected = []
    for rows_, cols in ((n + 6, None), (None, expected)):
        try:
            C.check_shape(f, rows_, cols=cols)
        except C.ContractError:
            rejected.append(True)
    return spark.createDataFrame([(rows, found["missing"], found["extra"], len(rejected) == 2)],
                                 "rows bigint, missing array<string>, extra array<string>, rejected boolean")


#: Categorical columns and numbers that are candidates for the drop.
P20_CATS = [*S.CATEGORICAL_INPUTS, "tenure_group"]
P20_NUMS = ["tenure_months", "monthly_charges", "total_charges"]


def _p20_sql() -> str:
    from churnspark.plans.q_profile import CHI_SQL, GRAM
    chi = CHI_SQL[len(Q.FEAT):].lstrip(",\n")
    crit = " ".join(f"WHEN {k} THEN {v!r}" for k, v in enumerate(S.CHI2_05, 1))
    return Q.with_(GRAM + ",\n" + chi + f""",
vi AS (SELECT 'tenure_months' AS column, a * (d * f - e * e) / det AS vif FROM dt
       UNION ALL SELECT 'monthly_charges', d * (a * f - c * c) / det FROM dt UNION ALL SELECT 'total_charges', f * (a * d - b * b) / det FROM dt),
ev AS (SELECT column, 'association' AS measure, cramers_v AS strength, chi2 <= CASE dof {crit} END AND cramers_v < 0.02 AS dropped FROM cv
       UNION ALL SELECT column, 'vif', vif, vif > 10 AND vif = max(vif) OVER () FROM vi)""",
        Q.round_cols("SELECT column, measure, strength, dropped, NOT dropped AS present FROM ev", ["strength"]))


@query("p20_drop_features", _p20_sql())
def p20_drop_features(spark, d):
    """P20: columns without association with the target (chi-square p >= 0.05 and
    V < 0.02, D16) and the most collinear number (VIF above 10, D21) are dropped;
    ``present`` is read from the table that results."""
    from churnspark.operators import clean as C
    f = feat(spark, d)
    ev = C.feature_evidence(f, P20_CATS, P20_NUMS, LABEL)
    left = C.drop_by_evidence(f, ev).columns
    return rounded(ev.select("column", "measure", "strength", "dropped", F.col("column").isin(left).alias("present")), ["strength"])


# ------------------------------------------------------------------ S3, S5, S6, S7
@query("s3_s5_s6_s7_sinks", Q.with_(Q.FEAT + """,
sg AS (SELECT contract, CAST(count(*) AS BIGINT) AS n, CAST(sum(churn_value) AS BIGINT) AS churners FROM feat GROUP BY contract)""",
  """SELECT 'parquet' AS sink, contract, count(*) AS n, CAST(sum(churn_value) AS BIGINT) AS churners FROM feat GROUP BY contract
UNION ALL SELECT 'csv', * FROM sg UNION ALL SELECT 'json', * FROM sg
UNION ALL SELECT 'params', 'best', max(n), any_value(churners) FILTER (WHERE n = (SELECT max(n) FROM sg)) FROM sg"""))
def s3_s5_s6_s7_sinks(spark, d):
    """The customers as checked Parquet by contract, their report
    as CSV and JSON, and a parameter file; all read back."""
    f = feat(spark, d)
    paths = {k: _folder(spark, f"sink-{k}") for k in ("parquet", "csv", "json", "params")}
    io.write_checked(f, paths["parquet"], partition_by=["contract"])
    report = lambda df: df.groupBy("contract").agg(F.count(F.lit(1)).alias("n"), F.sum(LABEL).cast("bigint").alias("churners"))
    rows = cut_lineage(report(f))
    io.write_report_csv(rows, paths["csv"])
    io.write_report_json(rows, paths["json"])
    top = rows.orderBy(F.col("n").desc(), "contract").limit(1)
    io.write_report_json(top.select(F.struct(F.struct("n", "churners").alias("best_params")).alias("best")), paths["params"])
    back = {"parquet": report(spark.read.parquet(paths["parquet"])),
            "csv": io.read_snapshot(spark, paths["csv"], "csv", rows.schema), "json": io.read_snapshot(spark, paths["json"], "json", rows.schema),
            "params": io.read_params(spark, paths["params"], "best").select(F.lit("best").alias("contract"), "n", "churners")}
    out = None
    for k, df in back.items():
        r = df.select(F.lit(k).alias("sink"), "contract", F.col("n").cast("bigint").alias("n"), F.col("churners").cast("bigint").alias("churners"))
        out = r if out is None else out.unionByName(r)
    return out


# ------------------------------------------------------------------ I3, M12
@query("i3_forward_equals_spark", Q.with_(Q.FEAT, "SELECT CAST(count(*) AS BIGINT) AS rows, true AS same FROM feat"))
def i3_forward_equals_spark(spark, d):
    """The NumPy forward pass and Spark's own, on all rows: no difference above 1e-9."""
    from churnspark.plans.registry import QUERIES
    f = QUERIES["i3_mlp_forward"](spark, d)
    return f.agg(F.count(F.lit(1)).cast("bigint").alias("rows"), (F.max("abs_diff") < 1e-9).alias("same"))


@query("m12_importance_of_a_rule", Q.with_(Q.FEAT, "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, {str(c in ('contract', 'tenure_months')).lower()} AS matters FROM (SELECT 1)" for c in S.INPUT_FIELDS)))
def m12_importance_of_a_rule(spark, d):
    """M12 for a scorer that reads two columns (M13): permuting any other changes nothing at all."""
    r = M.permutation_importance(lambda df: M.rule_score(df, tenure=60, use_charge=False), feat(spark, d), S.INPUT_FIELDS, "customerid", LABEL)
    return r.select("feature", (F.col("drop") != 0).alias("matters"))
