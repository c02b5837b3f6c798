"""Registered queries: evaluation aggregates (A1-A28) on the two score sets
(the snapshot's tied vendor score, and lineitem's heavily tied discount)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnspark import schemas as S
from churnspark.operators import evaluate as A
from churnspark.plans import sql as Q
from churnspark.plans.registry import query
from churnspark.session import cut_lineage
from churnspark.sources.tables import scores

R6 = 6


def _r(c, d=R6):
    return F.round(F.col(c), d).alias(c)


# ------------------------------------------------------------------ SQL parts
CONF = """
  CAST(count(*) FILTER (WHERE score >= threshold AND label = 1) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE score >= threshold AND label = 0) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE score < threshold AND label = 0) AS BIGINT) AS tn,
  CAST(count(*) FILTER (WHERE score < threshold AND label = 1) AS BIGINT) AS fn"""


def div0(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


PREC, REC = div0("tp", "tp + fp"), div0("tp", "tp + fn")
F1 = div0(f"2 * {PREC} * {REC}", f"{PREC} + {REC}")

POINTS = Q.SCORES + """,
pts0 AS (SELECT model, score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
         FROM scores GROUP BY model, score),
pts AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS tp,
               sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS fp,
               sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS N
        FROM pts0),
auc AS (SELECT model, CAST(sum(pos * (2 * (N - fp) + neg)) AS DOUBLE) / (2.0 * CAST(any_value(P) AS DOUBLE)
               * CAST(any_value(N) AS DOUBLE)) AS roc_auc FROM pts GROUP BY model),
ap AS (SELECT model, sum(pos * CAST(tp AS DOUBLE) / (tp + fp)) / CAST(any_value(P) AS DOUBLE)
              AS average_precision FROM pts GROUP BY model)"""


def percent_grid(lo: int, hi: int) -> str:
    return f"grid AS (SELECT range AS t_idx, (range + {lo}) / 100 AS threshold FROM range(0, {hi - lo + 1}))"


def linspace_grid(start: float, stop: float, num: int) -> str:
    step = (stop - start) / (num - 1)
    return (f"grid AS (SELECT range AS t_idx, CASE WHEN range = {num - 1} THEN CAST('{stop!r}' AS DOUBLE) "
            f"ELSE CAST(range AS DOUBLE) * CAST('{step!r}' AS DOUBLE) + CAST('{start!r}' AS DOUBLE) END "
            f"AS threshold FROM range(0, {num}))")


def sweep_sql(grid_cte: str) -> str:
    return Q.SCORES + ",\n" + grid_cte + """,
sw AS (SELECT model, t_idx, threshold,""" + CONF + """
       FROM scores, grid GROUP BY model, t_idx, threshold)"""


VAL = "CAST(tp * 2845.0 + tn * 73.52 + fn * -2845.0 + fp * -73.52 AS DOUBLE)"

# ------------------------------------------------------------------ A1-A3
query("a1_confusion", Q.with_(Q.SCORES + ", th AS (SELECT *, 0.5::DOUBLE AS threshold FROM scores)",
                              "SELECT model, threshold," + CONF + " FROM th GROUP BY model, threshold"))(
    lambda spark, d: A.confusion(scores(spark, d), 0.5))

_RATES = ["precision", "recall", "f1", "specificity", "accuracy", "npv", "mcc"]


@query("a2_rates", Q.with_(Q.SCORES + ", th AS (SELECT *, 0.5::DOUBLE AS threshold FROM scores),"
       " c AS (SELECT model, threshold," + CONF + " FROM th GROUP BY model, threshold)",
       f"""SELECT model, tp, fp, tn, fn,
  round({PREC}, 6) AS precision, round({REC}, 6) AS recall, round({F1}, 6) AS f1,
  round({div0('tn', 'tn + fp')}, 6) AS specificity, round({div0('tp + tn', 'tp + tn + fp + fn')}, 6) AS accuracy,
  round({div0('tn', 'tn + fn')}, 6) AS npv,
  round({div0('CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn',
             'sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn))')}, 6) AS mcc FROM c"""))
def a2_rates(spark, d):
    r = A.rates(A.confusion(scores(spark, d), 0.5))
    return r.select("model", "tp", "fp", "tn", "fn", *[_r(c) for c in _RATES])


# ------------------------------------------------------------------ A4-A9
query("a4_roc_auc", Q.with_(POINTS, "SELECT model, roc_auc FROM auc"))(
    lambda spark, d: A.roc_auc(scores(spark, d)))


@query("a5_average_precision", Q.with_(POINTS, "SELECT model, round(average_precision, 6) AS average_precision FROM ap"))
def a5_average_precision(spark, d):
    return A.average_precision(scores(spark, d)).select("model", _r("average_precision"))


query("a6_roc_curve", Q.with_(POINTS, f"""SELECT model, score AS threshold, {div0('fp', 'N')} AS fpr,
  {div0('tp', 'P')} AS tpr FROM pts"""))(lambda spark, d: A.roc_curve(scores(spark, d)))

query("a7_pr_curve", Q.with_(POINTS, f"""SELECT model, score AS threshold,
  CAST(tp AS DOUBLE) / (tp + fp) AS precision, {div0('tp', 'P')} AS recall,
  CAST(P AS DOUBLE) / (P + N) AS base_rate FROM pts"""))(lambda spark, d: A.pr_curve(scores(spark, d)))

query("a8_f1_sweep", Q.with_(sweep_sql(percent_grid(5, 94)), f"""SELECT model, threshold,
  {PREC} AS precision, {REC} AS recall, {F1} AS f1 FROM sw"""))(
    lambda spark, d: A.f1_sweep(scores(spark, d)))

query("a9_best_f1_threshold", Q.with_(POINTS + """,
pr AS (SELECT model, score AS threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
              """ + div0("tp", "P") + """ AS recall FROM pts),
f AS (SELECT *, """ + div0("2 * precision * recall", "precision + recall") + """ AS f1 FROM pr)""",
  "SELECT model, arg_max(threshold, (f1, -threshold)) AS threshold, max(f1) AS f1 FROM f GROUP BY model"))(
    lambda spark, d: A.best_f1_threshold(scores(spark, d)))


@query("a10_class_report", Q.with_(Q.SCORES + ", th AS (SELECT *, 0.5::DOUBLE AS threshold FROM scores),"
       " c AS (SELECT model, threshold," + CONF + " FROM th GROUP BY model, threshold),"
       """ per0 AS (SELECT model, '0' AS class, tn AS tp_c, fn AS fp_c, fp AS fn_c FROM c
              UNION ALL SELECT model, '1', tp, fp, fn FROM c),
  per AS (SELECT model, class, """ + div0("tp_c", "tp_c + fp_c") + " AS precision, " +
       div0("tp_c", "tp_c + fn_c") + """ AS recall, CAST(tp_c + fn_c AS BIGINT) AS support FROM per0),
  per2 AS (SELECT *, """ + div0("2 * precision * recall", "precision + recall") + " AS f1 FROM per)",
       """SELECT model, class, round(precision, 6) AS precision, round(recall, 6) AS recall, support,
  round(f1, 6) AS f1 FROM per2
UNION ALL SELECT model, 'macro avg', round(avg(precision), 6), round(avg(recall), 6),
  CAST(sum(support) AS BIGINT), round(avg(f1), 6) FROM per2 GROUP BY model
UNION ALL SELECT model, 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), CAST(sum(support) AS BIGINT),
  round(sum(f1 * support) / sum(support), 6) FROM per2 GROUP BY model"""))
def a10_class_report(spark, d):
    r = A.class_report(scores(spark, d), 0.5)
    return r.select("model", "class", _r("precision"), _r("recall"), "support", _r("f1"))


def _model_thresholds(spark):
    # one literal row per model: the per-model decision thresholds
    return spark.createDataFrame([("vendor", 0.5), ("lineitem", 0.05)], "model string, threshold double")


@query("a11_confusion_grid", Q.with_(Q.SCORES + """,
  mt AS (SELECT * FROM (VALUES ('vendor', 0.5::DOUBLE), ('lineitem', 0.05::DOUBLE)) t(model, threshold)),
  th AS (SELECT s.*, mt.threshold FROM scores s JOIN mt USING (model))""",
  "SELECT model, threshold," + CONF + f", round({PREC}, 6) AS precision, round({REC}, 6) AS recall,"
  f" round({F1}, 6) AS f1 FROM th GROUP BY model, threshold"))
def a11_confusion_grid(spark, d):
    r = A.confusion_grid(scores(spark, d), _model_thresholds(spark))
    return r.select("model", "threshold", "tp", "fp", "tn", "fn", _r("precision"), _r("recall"), _r("f1"))


# ------------------------------------------------------------------ A12-A20
@query("a12_business_value", Q.with_(Q.SCORES + ", th AS (SELECT *, 0.5::DOUBLE AS threshold FROM scores),"
       " c AS (SELECT model, threshold," + CONF + " FROM th GROUP BY model, threshold)",
       f"SELECT model, threshold, tp, fp, tn, fn, round({VAL}, 2) AS business_value FROM c"))
def a12_business_value(spark, d):
    return A.business_value(scores(spark, d), 0.5).withColumn(
        "business_value", F.round("business_value", 2))


BEST_SQL = sweep_sql(percent_grid(*S.THRESHOLD_GRID)) + f""",
tv AS (SELECT *, {VAL} AS business_value, {REC} >= 0.7 AS ok FROM sw),
best AS (SELECT model, arg_max(threshold, (ok, business_value, -threshold)) AS threshold,
                arg_max(business_value, (ok, business_value, -threshold)) AS business_value,
                arg_max(ok, (ok, business_value, -threshold)) AS slo_met FROM tv GROUP BY model)"""


@query("a13_best_threshold", Q.with_(BEST_SQL, "SELECT model, threshold, round(business_value, 2) AS business_value, slo_met FROM best"))
def a13_best_threshold(spark, d):
    return A.best_threshold(scores(spark, d)).withColumn("business_value", F.round("business_value", 2))


@query("a14_full_metrics", Q.with_(BEST_SQL + """,
pts0 AS (SELECT model, score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
         FROM scores GROUP BY model, score),
pts AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS tp,
               sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS fp,
               sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS N FROM pts0),
auc AS (SELECT model, CAST(sum(pos * (2 * (N - fp) + neg)) AS DOUBLE) / (2.0 * CAST(any_value(P) AS DOUBLE)
               * CAST(any_value(N) AS DOUBLE)) AS roc_auc FROM pts GROUP BY model),
ap AS (SELECT model, sum(pos * CAST(tp AS DOUBLE) / (tp + fp)) / CAST(any_value(P) AS DOUBLE)
              AS average_precision FROM pts GROUP BY model),
th AS (SELECT s.*, b.threshold FROM scores s JOIN best b USING (model)),
c AS (SELECT model, threshold,""" + CONF + " FROM th GROUP BY model, threshold)",
  f"""SELECT c.model, threshold, tp, tn, fp, fn, round({REC}, 6) AS recall, round({PREC}, 6) AS precision,
  round({F1}, 6) AS f1, round({VAL}, 2) AS business_value, {REC} >= 0.7 AS slo_ok,
  roc_auc, round(average_precision, 6) AS pr_auc
FROM c JOIN auc USING (model) JOIN ap USING (model)"""))
def a14_full_metrics(spark, d):
    s = scores(spark, d)
    best = A.best_threshold(s).select("model", "threshold")
    m = A.full_metrics(s, best)
    return m.select("model", "threshold", "tp", "tn", "fp", "fn", _r("recall"), _r("precision"),
                    _r("f1"), F.round("business_value", 2).alias("business_value"), "slo_ok",
                    "roc_auc", F.round("pr_auc", R6).alias("pr_auc"))


@query("a15_holdout_metrics", Q.with_(POINTS + """,
th AS (SELECT *, 0.5::DOUBLE AS threshold FROM scores),
c AS (SELECT model, threshold,""" + CONF + " FROM th GROUP BY model, threshold)",
  f"""SELECT model, round(roc_auc, 2) AS test_roc_auc, round(average_precision, 2) AS test_average_precision,
  round({F1}, 2) AS test_f1, round({REC}, 2) AS test_recall, round({PREC}, 2) AS test_precision,
  round({div0('tp + tn', 'tp + tn + fp + fn')}, 2) AS test_accuracy,
  round(CAST(tp AS DOUBLE), 2) AS test_tp, round(CAST(tn AS DOUBLE), 2) AS test_tn,
  round(CAST(fp AS DOUBLE), 2) AS test_fp, round(CAST(fn AS DOUBLE), 2) AS test_fn
FROM c JOIN auc USING (model) JOIN ap USING (model)"""))
def a15_holdout_metrics(spark, d):
    return A.holdout_metrics(scores(spark, d), 0.5)


CAMPAIGN = """round(CAST((2845.0 - 73.52) * tp AS DOUBLE), 2) AS revenue_saved,
  round(CAST(73.52 * fp AS DOUBLE), 2) AS cost_fp,
  round(CAST(2845.0 * fn AS DOUBLE), 2) AS cost_fn, round(CAST(73.52 * fp + 2845.0 * fn AS DOUBLE), 2) AS cost_total,
  round(CAST((2845.0 - 73.52) * tp - (73.52 * fp + 2845.0 * fn) AS DOUBLE), 2) AS net_value"""


@query("a16_campaign_value", Q.with_(Q.SCORES + ", th AS (SELECT *, 0.5::DOUBLE AS threshold FROM scores),"
       " c AS (SELECT model, threshold," + CONF + " FROM th GROUP BY model, threshold)",
       "SELECT model, threshold, tp, fp, tn, fn, " + CAMPAIGN + " FROM c"))
def a16_campaign_value(spark, d):
    return A.campaign_value(A.confusion(scores(spark, d), 0.5))


NET_SQL = sweep_sql(linspace_grid(0.01, 0.99, 200)) + """,
nv AS (SELECT model, t_idx, threshold, tp, fp, fn, tn,
   round(CAST((2845.0 - 73.52) * tp - (73.52 * fp + 2845.0 * fn) AS DOUBLE), 2) AS net_value FROM sw)"""

query("a17_net_value_curve", Q.with_(NET_SQL, "SELECT * FROM nv"))(
    lambda spark, d: A.net_value_curve(scores(spark, d)))


@query("a18_threshold_gain", Q.with_(NET_SQL + """,
best AS (SELECT model, arg_max(threshold, (net_value, -threshold)) AS threshold, max(net_value) AS net_value
         FROM nv GROUP BY model),
th AS (SELECT *, 0.5::DOUBLE AS threshold FROM scores),
c AS (SELECT model, threshold,""" + CONF + """ FROM th GROUP BY model, threshold),
base AS (SELECT model, round(CAST((2845.0 - 73.52) * tp - (73.52 * fp + 2845.0 * fn) AS DOUBLE), 2) AS net_value_base FROM c)""",
  "SELECT model, threshold, net_value, net_value_base, round(net_value - net_value_base, 2) AS gain "
  "FROM best JOIN base USING (model)"))
def a18_threshold_gain(spark, d):
    return A.threshold_gain(scores(spark, d))


@query("a20_tradeoff", Q.with_(Q.SCORES + ", th AS (SELECT *, 0.5::DOUBLE AS threshold FROM scores),"
       " c AS (SELECT model, threshold," + CONF + " FROM th GROUP BY model, threshold)",
       """SELECT model, fp, fn, round(fp * 80.0::DOUBLE, 2) AS cost_fp, round(fn * 1200.0::DOUBLE, 2) AS cost_fn,
  round(fp * 80.0::DOUBLE + fn * 1200.0::DOUBLE, 2) AS cost_total,
  round(tp * (1200.0::DOUBLE - 80.0::DOUBLE), 2) AS churn_avoided,
  round(tp * (1200.0::DOUBLE - 80.0::DOUBLE) - (fp * 80.0::DOUBLE + fn * 1200.0::DOUBLE), 2) AS net_value,
  CASE WHEN fp * 80.0 + fn * 1200.0 > 0
       THEN round((tp * (1200.0::DOUBLE - 80.0::DOUBLE) - (fp * 80.0::DOUBLE + fn * 1200.0::DOUBLE))
                  / (fp * 80.0::DOUBLE + fn * 1200.0::DOUBLE), 2)
       ELSE 'inf'::DOUBLE END AS roi FROM c"""))
def a20_tradeoff(spark, d):
    """A19 (cost annotation) + A20 (trade-off table)."""
    return A.tradeoff(A.confusion(scores(spark, d), 0.5))


FULL_AT_HALF = POINTS + """,
th AS (SELECT *, 0.5::DOUBLE AS threshold FROM scores),
c AS (SELECT model, threshold,""" + CONF + """ FROM th GROUP BY model, threshold),
m AS (SELECT c.model, """ + REC + " AS recall, " + VAL + " AS business_value, " + REC + """ >= 0.7 AS slo_ok,
        roc_auc, average_precision AS pr_auc FROM c JOIN auc USING (model) JOIN ap USING (model))"""


def _metrics_half(spark, d):
    m = A.full_metrics(scores(spark, d), 0.5)
    return m.select("model", "recall", "business_value", "slo_ok", "roc_auc", "pr_auc")


@query("a21_compare", Q.with_(FULL_AT_HALF, """SELECT model, roc_auc, round(business_value, 2) AS business_value,
  CAST(row_number() OVER (ORDER BY roc_auc DESC, model) AS INTEGER) AS rank FROM m"""))
def a21_compare(spark, d):
    m = A.compare(_metrics_half(spark, d), "roc_auc")
    return m.select("model", "roc_auc", F.round("business_value", 2).alias("business_value"), "rank")


@query("a22_pick_winner", Q.with_(FULL_AT_HALF, """SELECT arg_max(model, (slo_ok, business_value)) AS model,
  round(arg_max(business_value, (slo_ok, business_value)), 2) AS business_value,
  max(slo_ok) AS slo_ok FROM m"""))
def a22_pick_winner(spark, d):
    w = A.pick_winner(_metrics_half(spark, d))
    return w.select("model", F.round("business_value", 2).alias("business_value"), "slo_ok")


@query("a23_model_delta", Q.with_(FULL_AT_HALF + """,
lf AS (SELECT model, 'recall' AS metric, recall AS value FROM m UNION ALL
       SELECT model, 'roc_auc', roc_auc FROM m UNION ALL SELECT model, 'pr_auc', pr_auc FROM m)""",
  """SELECT metric, round(max(value) FILTER (WHERE model = 'vendor'), 6) AS value_a,
  round(max(value) FILTER (WHERE model = 'lineitem'), 6) AS value_b,
  round(max(value) FILTER (WHERE model = 'vendor') - max(value) FILTER (WHERE model = 'lineitem'), 6) AS delta
FROM lf GROUP BY metric"""))
def a23_model_delta(spark, d):
    r = A.model_delta(_metrics_half(spark, d), "vendor", "lineitem", ["recall", "roc_auc", "pr_auc"])
    return r.select("metric", _r("value_a"), _r("value_b"), _r("delta"))


@query("a24_promote", Q.with_(BEST_SQL + """,
th AS (SELECT s.*, b.threshold FROM scores s JOIN best b USING (model)),
c AS (SELECT model, threshold,""" + CONF + """ FROM th GROUP BY model, threshold),
cand AS (SELECT model, """ + VAL + " AS business_value, " + REC + """ >= 0.7 AS slo_ok FROM c),
th5 AS (SELECT *, 0.5::DOUBLE AS threshold FROM scores WHERE model = 'vendor'),
c5 AS (SELECT model, threshold,""" + CONF + """ FROM th5 GROUP BY model, threshold),
champ AS (SELECT max(""" + VAL + """) AS champion_value FROM c5)""",
  """SELECT model, round(business_value, 2) AS business_value, slo_ok, round(champion_value, 2) AS champion_value,
  slo_ok AND (champion_value IS NULL OR business_value > champion_value) AS promote,
  CASE WHEN NOT slo_ok THEN 'recall below SLO' WHEN champion_value IS NULL THEN 'no champion'
       WHEN business_value > champion_value THEN 'beats champion' ELSE 'does not beat champion' END AS reason
FROM cand, champ"""))
def a24_promote(spark, d):
    """Candidates at their tuned thresholds vs the registry's champion (the
    vendor score at 0.5, registered as version 1)."""
    s = scores(spark, d)
    best = A.best_threshold(s).select("model", "threshold")
    cand = A.business_value(s, best).withColumn(
        "slo_ok", A.rate_cols()["recall"] >= S.SLO_RECALL_MIN).select("model", "business_value", "slo_ok")
    reg = (A.business_value(s.where(F.col("model") == "vendor"), 0.5)
           .select("model", F.lit(1).alias("version"), "business_value", F.lit("champion").alias("stage")))
    p = A.promote(cand, reg)
    return p.select("model", F.round("business_value", 2).alias("business_value"), "slo_ok",
                    F.round("champion_value", 2).alias("champion_value"), "promote", "reason")


@query("a25_release_gate", Q.with_(FULL_AT_HALF, """SELECT model,
  list_filter([CASE WHEN NOT coalesce(recall >= 0.7, false) THEN 'recall >= 0.7' END,
               CASE WHEN NOT coalesce(roc_auc >= 0.8, false) THEN 'roc_auc >= 0.8' END,
               CASE WHEN NOT coalesce(business_value >= 950000.0, false) THEN 'business_value >= 950000.0' END],
              lambda x: x IS NOT NULL) AS failed_rules FROM m"""))
def a25_release_gate(spark, d):
    return A.release_gate(_metrics_half(spark, d)).select("model", "failed_rules")


@query("a25_release_decision", Q.with_(FULL_AT_HALF + """,
mf AS (SELECT m.*, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1 FROM m JOIN c USING (model)),
old AS (SELECT roc_auc AS old_auc, f1 AS old_f1 FROM mf WHERE model = 'lineitem'),
x AS (SELECT mf.*, old.*, round(roc_auc - old_auc, 9) >= 0.005 OR round(f1 - old_f1, 9) >= 0.01 AS improves,
  list_filter([CASE WHEN coalesce(roc_auc < 0.8, true) THEN 'roc_auc < 0.8' END, CASE WHEN coalesce(recall < 0.5, true) THEN 'recall < 0.5' END],
              lambda x: x IS NOT NULL) AS reject_rules,
  coalesce(recall >= 0.7, false) AND coalesce(roc_auc >= 0.8, false) AND coalesce(business_value >= 1000000.0, false) AS passed FROM mf, old)""",
  """SELECT model, reject_rules, passed, improves,
  CASE WHEN len(reject_rules) > 0 THEN 'reject' WHEN passed AND improves THEN 'promote' ELSE 'hold' END AS decision FROM x"""))
def a25_release_decision(spark, d):
    """Automatic rejection, the required minimum and the improvement over
    the model in use (here: the lineitem scores), with a value bound of its own."""
    m = cut_lineage(A.full_metrics(scores(spark, d), 0.5))
    rules = [r for r in A.RELEASE_RULES if r[0] != "business_value"] + [("business_value", ">=", 1_000_000.0)]
    return A.release_decision(m, m.where("model = 'lineitem'"), rules).select("model", "reject_rules", "passed", "improves", "decision")


@query("a27_recalibrate", Q.with_(sweep_sql(percent_grid(*S.THRESHOLD_GRID)) + """,
w AS (SELECT *, 0.2654 * (tp + fn + tn + fp) / (tp + fn) AS w1, (1 - 0.2654) * (tp + fn + tn + fp) / (tn + fp) AS w0 FROM sw),
rw AS (SELECT model, threshold, tp * w1 AS tp, fn * w1 AS fn, fp * w0 AS fp, tn * w0 AS tn FROM w),
tv AS (SELECT *, """ + VAL + " AS business_value, " + REC + """ >= 0.7 AS ok FROM rw)""",
  """SELECT model, arg_max(threshold, (ok, business_value, -threshold)) AS threshold,
  round(arg_max(business_value, (ok, business_value, -threshold)), 2) AS business_value FROM tv GROUP BY model"""))
def a27_recalibrate(spark, d):
    r = A.recalibrate(scores(spark, d), prior=0.2654)
    return r.select("model", "threshold", F.round("business_value", 2).alias("business_value"))


@query("a28_log_loss", Q.with_(Q.SCORES + """,
cw AS (SELECT model, CAST(sum(1 - label) AS DOUBLE) / greatest(sum(label), 1) AS pos_weight FROM scores GROUP BY model),
p AS (SELECT s.*, cw.pos_weight, least(greatest(score, 1e-15), 1 - 1e-15) AS pc FROM scores s JOIN cw USING (model))""",
  """SELECT model, round(avg(-(CASE WHEN label = 1 THEN pos_weight ELSE 1.0 END)
      * (label * ln(pc) + (1 - label) * ln(1 - pc))), 6) AS log_loss FROM p GROUP BY model"""))
def a28_log_loss(spark, d):
    """Weighted log loss with pos_weight = n_neg / max(n_pos, 1) per model (V7)."""
    s = scores(spark, d)
    cw = s.groupBy("model").agg((F.sum(1 - F.col("label")) / F.greatest(F.sum("label"), F.lit(1)))
                                .alias("pos_weight"))
    return A.log_loss(s, cw).select("model", _r("log_loss"))
