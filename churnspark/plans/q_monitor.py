"""Registered queries: monitoring (R1-R29) in batch form.

Reference vs current = the cleaned snapshot split by customer id parity;
predictions = ``view`` events (score = value / (value + 50)); outcomes =
``purchase`` events; the request log = all events (``error`` = 503)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnspark import schemas as S
from churnspark.operators import clean as C
from churnspark.operators import monitor as R
from churnspark.operators.evaluate import roc_auc
from churnspark.plans import sql as Q
from churnspark.plans.registry import query, rounded
from churnspark.plans.slice import cleaned_features
from churnspark.session import cut_lineage
from churnspark.sources.tables import events, snapshot

NUM = ["tenure_months", "monthly_charges", "total_charges"]
CATS = ["contract", "internet_service", "payment_method", "gender"]
H = 7            # outcome horizon in days (the event log covers 30 days)
EPOCH = "TIMESTAMP '1970-01-01'"


def ref_cur(spark, d):
    f = cut_lineage(cleaned_features(spark, d))
    return f.where(F.col("customerid") % 2 == 0), f.where(F.col("customerid") % 2 == 1)


def preds(spark, d):
    e = events(spark, d).where(F.col("event_type") == "view")
    sc = F.col("value") / (F.col("value") + 50.0)
    return e.select(F.col("event_id").alias("pred_id"), "user_id", "ts", sc.alias("score"),
                    (sc >= 0.5).cast("int").alias("prediction"))


def outcomes(spark, d):
    return events(spark, d).where(F.col("event_type") == "purchase")


def log(spark, d):
    return R.request_log(events(spark, d))


RC = Q.FEAT + """,
ref AS (SELECT * FROM feat WHERE customerid % 2 = 0),
cur AS (SELECT * FROM feat WHERE customerid % 2 = 1)"""
EV = """ev AS (SELECT * FROM events),
pr AS (SELECT event_id AS pred_id, user_id, ts, value / (value + 50.0) AS score,
              CAST(value / (value + 50.0) >= 0.5 AS INTEGER) AS prediction FROM events WHERE event_type = 'view'),
oc AS (SELECT * FROM events WHERE event_type = 'purchase'),
lg AS (SELECT CAST(event_id AS VARCHAR) AS request_id, 'POST' AS method, '/predict' AS path,
              CASE WHEN event_type = 'error' THEN 503 ELSE 200 END AS status, value AS elapsed_ms,
              'h' || CAST(user_id % 4 AS VARCHAR) AS host, ts FROM events)"""

# ------------------------------------------------------------------ R1, R2, R25
EDGES = RC + ",\nlr AS (" + Q.long_sql("ref", NUM) + "),\nlc AS (" + Q.long_sql("cur", NUM) + """),
ed AS (SELECT column, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM lr GROUP BY column)"""


@query("r25_reference_edges", Q.with_(EDGES, "SELECT column, list_transform(edges, lambda x: round(x, 6)) AS edges, 'v1' AS version FROM ed"))
def r25_reference_edges(spark, d):
    ref, _ = ref_cur(spark, d)
    e = R.reference_edges(ref, NUM, version="v1")
    return e.withColumn("edges", F.transform("edges", lambda x: F.round(x, 6)))


@query("r1_psi", Q.with_(EDGES + """,
br AS (SELECT column, len(list_filter(edges, lambda x: x < value)) AS bin FROM lr JOIN ed USING (column)),
bc AS (SELECT column, len(list_filter(edges, lambda x: x < value)) AS bin FROM lc JOIN ed USING (column)),
ab AS (SELECT column, range AS bin FROM ed, range(0, 10)),
cn AS (SELECT ab.column, ab.bin, (SELECT count(*) FROM br WHERE br.column = ab.column AND br.bin = ab.bin) AS n_ref,
              (SELECT count(*) FROM bc WHERE bc.column = ab.column AND bc.bin = ab.bin) AS n_cur FROM ab),
sh AS (SELECT column, greatest(n_ref / sum(n_ref) OVER (PARTITION BY column), 1e-4) AS r,
              greatest(n_cur / sum(n_cur) OVER (PARTITION BY column), 1e-4) AS c FROM cn),
ps AS (SELECT column, sum((c - r) * ln(c / r)) AS psi FROM sh GROUP BY column)""",
  Q.round_cols("SELECT column, psi, CASE WHEN psi < 0.1 THEN 'none' WHEN psi < 0.2 THEN 'moderate' ELSE 'severe' END AS band FROM ps",
               ["psi"])))
def r1_psi(spark, d):
    """R1 + R2: PSI per numeric feature, current vs reference deciles."""
    ref, cur = ref_cur(spark, d)
    return rounded(R.psi(ref, cur, NUM), ["psi"])


# ------------------------------------------------------------------ R3-R5, R28
TAG = RC + ",\ntg AS (SELECT *, 0 AS _cur FROM ref UNION ALL SELECT *, 1 AS _cur FROM cur),\nlc AS (" + \
    Q.long_sql("tg", CATS, keep=["_cur"], cast="VARCHAR") + """),
ob AS (SELECT column, value, CAST(count(*) FILTER (WHERE _cur <> 1) AS DOUBLE) AS o0,
              CAST(count(*) FILTER (WHERE _cur = 1) AS DOUBLE) AS o1 FROM lc WHERE value IS NOT NULL GROUP BY column, value),
tt AS (SELECT column, sum(o0) AS c0, sum(o1) AS c1, count(*) AS r FROM ob GROUP BY column),
ex AS (SELECT ob.*, r - 1 AS dof, c0 + c1 AS n, (o0 + o1) * c0 / (c0 + c1) AS e0, (o0 + o1) * c1 / (c0 + c1) AS e1
       FROM ob JOIN tt USING (column)),
dv AS (SELECT *, CASE WHEN dof = 1 THEN abs(abs(o0 - e0) - 0.5) ELSE abs(o0 - e0) END AS d0,
              CASE WHEN dof = 1 THEN abs(abs(o1 - e1) - 0.5) ELSE abs(o1 - e1) END AS d1 FROM ex),
ch AS (SELECT column, sum(CASE WHEN e0 > 0 THEN d0 * d0 / e0 ELSE 0 END + CASE WHEN e1 > 0 THEN d1 * d1 / e1 ELSE 0 END) AS chi2,
              CAST(any_value(dof) AS BIGINT) AS dof, any_value(n) AS n FROM dv GROUP BY column)"""

query("r3_chi2_drift", Q.with_(TAG, Q.round_cols(
    "SELECT column, chi2, dof, CASE WHEN dof > 0 THEN sqrt(chi2 / n / least(dof, 1)) ELSE 0.0 END AS cramers_v FROM ch",
    ["chi2", "cramers_v"])))(
    lambda spark, d: rounded(R.chi2_drift(*ref_cur(spark, d), CATS), ["chi2", "cramers_v"]))


@query("r3_chi2_drift_p")
def r3_chi2_drift_p(spark, d):
    return R.chi2_drift(*ref_cur(spark, d), CATS, with_p=True)


KS = RC + ",\ntg AS (SELECT *, 0 AS _cur FROM ref UNION ALL SELECT *, 1 AS _cur FROM cur),\nlk AS (" + \
    Q.long_sql("tg", NUM, keep=["_cur"]) + """),
dv AS (SELECT column, value, count(*) FILTER (WHERE _cur = 0) AS r, count(*) FILTER (WHERE _cur = 1) AS c
       FROM lk WHERE value IS NOT NULL GROUP BY column, value),
cm AS (SELECT *, sum(r) OVER (PARTITION BY column ORDER BY value) AS cr, sum(c) OVER (PARTITION BY column ORDER BY value) AS cc,
              sum(r) OVER (PARTITION BY column) AS n_ref, sum(c) OVER (PARTITION BY column) AS n_cur FROM dv)"""

query("r4_ks_drift", Q.with_(KS, Q.round_cols(
    "SELECT column, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, max(abs(cr / n_ref - cc / n_cur)) AS ks "
    "FROM cm GROUP BY column, n_ref, n_cur", ["ks"])))(
    lambda spark, d: rounded(R.ks_drift(*ref_cur(spark, d), NUM), ["ks"]))


@query("r4_ks_drift_p")
def r4_ks_drift_p(spark, d):
    return R.ks_drift(*ref_cur(spark, d), NUM, with_p=True)


_R5 = ["tenure_months", "monthly_charges", "total_charges", "contract", "churn_reason"]


@query("r5_missing_drift", Q.with_(Q.SNAPSHOT + ",\nc1 AS (SELECT * REPLACE (TRY_CAST(total_charges AS DOUBLE) AS total_charges) FROM snap WHERE customerid % 2 = 1)",
  Q.round_cols("\nUNION ALL ".join(
      f"SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_missing, "
      f"count(*) FILTER (WHERE {c} IS NULL) / count(*) AS missing_rate, "
      f"count(*) FILTER (WHERE {c} IS NULL) / count(*) > 0.05 AS alert FROM c1" for c in _R5), ["missing_rate"])))
def r5_missing_drift(spark, d):
    cur = C.coerce_numeric(snapshot(spark, d), ["total_charges"]).where(F.col("customerid") % 2 == 1)
    return rounded(R.missing_drift(cur, _R5), ["missing_rate"])


query("r28_concept_shift", Q.with_(RC + """,
ra AS (SELECT contract, count(*) AS n_ref, avg(CAST(churn_value = 1 AS INTEGER)) AS rate_ref FROM ref GROUP BY contract),
rb AS (SELECT contract, count(*) AS n_cur, avg(CAST(churn_value = 1 AS INTEGER)) AS rate_cur FROM cur GROUP BY contract)""",
  Q.round_cols("""SELECT coalesce(ra.contract, rb.contract) AS contract, CAST(n_ref AS BIGINT) AS n_ref, rate_ref,
  CAST(n_cur AS BIGINT) AS n_cur, rate_cur, rate_cur - rate_ref AS change FROM ra FULL OUTER JOIN rb ON ra.contract = rb.contract""",
               ["rate_ref", "rate_cur", "change"])))(
    lambda spark, d: rounded(R.concept_shift(*ref_cur(spark, d), "contract"), ["rate_ref", "rate_cur", "change"]))

# ------------------------------------------------------------------ R6, R7, R9
query("r6_positive_rate_drift", Q.with_(EV, Q.round_cols(f"""SELECT ws AS window_start, ws + INTERVAL 7 DAY AS window_end,
  CAST(count(*) AS BIGINT) AS n, avg(CAST(prediction AS DOUBLE)) AS positive_rate,
  abs(avg(CAST(prediction AS DOUBLE)) - 0.3) > 0.1 AS alert
FROM (SELECT *, time_bucket(INTERVAL 7 DAY, ts, {EPOCH}) AS ws FROM pr) GROUP BY ws""", ["positive_rate"])))(
    lambda spark, d: rounded(R.positive_rate_drift(preds(spark, d), 0.3), ["positive_rate"]))

query("r7_score_histogram", Q.with_(EV, f"""SELECT time_bucket(INTERVAL 7 DAY, ts, {EPOCH}) AS window_start,
  CAST(least(floor(score * 10), 9) AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n FROM pr GROUP BY 1, 2"""))(
    lambda spark, d: R.score_histogram(preds(spark, d)))

OUTCOME = EV + f""",
mx AS (SELECT max(ts) AS mx FROM oc),
nx AS (SELECT p.pred_id, min(o.ts) AS nxt FROM pr p JOIN oc o ON o.user_id = p.user_id AND o.ts > p.ts
       AND o.ts <= p.ts + INTERVAL {H} DAY GROUP BY p.pred_id),
jo AS (SELECT p.pred_id, p.user_id, p.ts, p.prediction, CASE WHEN nxt IS NOT NULL THEN 1 ELSE 0 END AS outcome, nxt AS next_event_ts
       FROM pr p LEFT JOIN nx USING (pred_id), mx WHERE p.ts + INTERVAL {H} DAY <= mx.mx)"""


def joined(spark, d):
    p = preds(spark, d)
    j = R.attach_outcome(p, outcomes(spark, d), horizon_days=H)
    return j.join(p.select("pred_id", "prediction", "score"), "pred_id")


query("r8_attach_outcome", Q.with_(OUTCOME, "SELECT pred_id, user_id, ts, outcome, next_event_ts FROM jo"))(
    lambda spark, d: R.attach_outcome(preds(spark, d), outcomes(spark, d), horizon_days=H))

query("r8_latest_prediction_before", Q.with_(EV, """SELECT o.event_id, o.user_id, o.ts, arg_max(p.pred_id, p.ts) AS pred_id,
  max(p.ts) AS prediction_ts FROM oc o LEFT JOIN pr p ON p.user_id = o.user_id AND p.ts <= o.ts
GROUP BY o.event_id, o.user_id, o.ts"""))(
    lambda spark, d: R.latest_prediction_before(outcomes(spark, d), preds(spark, d)))

query("r9_rolling_metrics", Q.with_(OUTCOME + f""",
sl AS (SELECT *, time_bucket(INTERVAL 7 DAY, ts, {EPOCH}) AS b FROM jo),
ww AS (SELECT b AS ws, * FROM sl UNION ALL SELECT b - INTERVAL 7 DAY AS ws, * FROM sl)""",
  Q.round_cols("""SELECT ws AS window_start, ws + INTERVAL 14 DAY AS window_end,
  CAST(count(*) FILTER (WHERE prediction = 1 AND outcome = 1) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE prediction = 1 AND outcome = 0) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE prediction = 0 AND outcome = 0) AS BIGINT) AS tn,
  CAST(count(*) FILTER (WHERE prediction = 0 AND outcome = 1) AS BIGINT) AS fn,
  coalesce(count(*) FILTER (WHERE prediction = 1 AND outcome = 1) / nullif(count(*) FILTER (WHERE outcome = 1), 0), 0.0) AS recall,
  coalesce(count(*) FILTER (WHERE prediction = 1 AND outcome = 1) / nullif(count(*) FILTER (WHERE prediction = 1), 0), 0.0) AS precision
FROM ww GROUP BY ws""", ["recall", "precision"])))(
    lambda spark, d: rounded(R.rolling_metrics(joined(spark, d), "14 days", "7 days"), ["recall", "precision"]))

# ------------------------------------------------------------------ R10-R14, R26
query("r10_request_log", Q.with_(EV, "SELECT * FROM lg"))(lambda spark, d: log(spark, d))

query("r11_latency_stats", Q.with_(EV, Q.round_cols("""SELECT window_start, CAST(count(*) AS BIGINT) AS n,
  quantile_cont(elapsed_ms, 0.5) AS p50, quantile_cont(elapsed_ms, 0.95) AS p95,
  CASE WHEN quantile_cont(elapsed_ms, 0.95) > 500 THEN 'critical' WHEN quantile_cont(elapsed_ms, 0.5) > 200 THEN 'warning' ELSE 'ok' END AS level
FROM (SELECT *, date_trunc('day', ts) AS window_start FROM lg) GROUP BY window_start""", ["p50", "p95"])))(
    lambda spark, d: rounded(R.latency_stats(log(spark, d)), ["p50", "p95"]))

ERR = """SELECT date_trunc('day', ts) AS window_start, CAST(count(*) AS BIGINT) AS n,
  count(*) FILTER (WHERE status >= 400 AND status < 500) / count(*) AS rate_4xx,
  count(*) FILTER (WHERE status >= 500) / count(*) AS rate_5xx FROM lg GROUP BY 1"""
query("r12_error_rates", Q.with_(EV, Q.round_cols(f"SELECT *, rate_4xx > 0.05 AS alert_4xx, rate_5xx > 0.005 AS alert_5xx FROM ({ERR})",
                                                  ["rate_4xx", "rate_5xx"])))(
    lambda spark, d: rounded(R.error_rates(log(spark, d)), ["rate_4xx", "rate_5xx"]))

query("r13_availability", Q.with_(EV, Q.round_cols("""SELECT date_trunc('month', ts) AS period,
  avg(CASE WHEN status < 500 THEN 1.0 ELSE 0.0 END) AS availability,
  avg(CASE WHEN status < 500 THEN 1.0 ELSE 0.0 END) >= 0.995 AS met FROM lg GROUP BY 1""", ["availability"])))(
    lambda spark, d: rounded(R.availability(log(spark, d).withColumn("ok", F.col("status") < 500)), ["availability"]))

query("r14_failure_runs", Q.with_(EV + """,
st AS (SELECT host, ts, count(*) FILTER (WHERE status <> 503) AS okc, count(*) FILTER (WHERE status = 503) AS fc FROM lg GROUP BY host, ts),
cs AS (SELECT *, sum(okc) OVER (PARTITION BY host ORDER BY ts) AS island FROM st)""",
  """SELECT host, min(ts) AS run_start, max(ts) AS run_end, CAST(sum(fc) AS BIGINT) AS n_failures
FROM cs WHERE okc = 0 AND fc > 0 GROUP BY host, island HAVING sum(fc) >= 3"""))(
    lambda spark, d: R.failure_runs(log(spark, d), 3))


def runs(spark, d):
    e = events(spark, d)
    return e.select(F.col("event_id").alias("run_id"), F.col("ts").alias("start_ts"),
                    (F.col("value") * 60).alias("duration_s"), (F.col("event_type") != "error").alias("ok"))


query("r26_job_slo", Q.with_(EV + """,
rn AS (SELECT ts AS start_ts, value * 60 AS duration_s, event_type <> 'error' AS ok,
              date_trunc('month', ts) AS month,
              hour(ts + to_microseconds(CAST(round(value * 60 * 1000000) AS BIGINT))) < 4 AS on_time FROM events)""",
  Q.round_cols("""SELECT month, CAST(count(*) AS BIGINT) AS runs, avg(CAST(on_time AS DOUBLE)) AS on_time_rate,
  avg(CAST(ok AS DOUBLE)) AS success_rate, quantile_cont(duration_s, 0.95) AS p95_duration_s,
  quantile_cont(duration_s, 0.95) < 7200 AS duration_ok, avg(CAST(ok AS DOUBLE)) >= 0.995 AS success_ok FROM rn GROUP BY month""",
               ["on_time_rate", "success_rate", "p95_duration_s"])))(
    lambda spark, d: rounded(R.job_slo(runs(spark, d)), ["on_time_rate", "success_rate", "p95_duration_s"]))


_SLO = ["p95_ms", "p99_ms", "error_rate", "availability"]
query("r26_service_slo", Q.with_(EV, Q.round_cols("""SELECT date_trunc('day', ts) AS period, CAST(count(*) AS BIGINT) AS requests,
  avg(CAST(status >= 500 AS DOUBLE)) AS error_rate, avg(CAST(status <> 503 AS DOUBLE)) AS availability,
  quantile_cont(elapsed_ms, 0.95) AS p95_ms, quantile_cont(elapsed_ms, 0.99) AS p99_ms,
  quantile_cont(elapsed_ms, 0.95) < 200 AS p95_ok, quantile_cont(elapsed_ms, 0.99) < 500 AS p99_ok,
  avg(CAST(status >= 500 AS DOUBLE)) < 0.001 AS error_ok, avg(CAST(status <> 503 AS DOUBLE)) >= 0.999 AS available_ok
FROM lg GROUP BY 1""", _SLO)))(
    lambda spark, d: rounded(R.service_slo(log(spark, d), "day"), _SLO))


# ------------------------------------------------------------------ R15-R18, R21
def _day_metrics(spark, d):
    er = R.error_rates(log(spark, d)).select("window_start", F.lit("error_rate_5xx").alias("metric"),
                                              F.col("rate_5xx").alias("value"))
    lt = R.latency_stats(log(spark, d))
    out = er
    for q in ("p50", "p95"):
        out = out.unionByName(lt.select("window_start", F.lit(f"latency_{q}_ms").alias("metric"), F.col(q).alias("value")))
    return out


# the rules are stated here once more, literally, so that the oracle does not follow the implementation
query("r15_alerts", Q.with_(EV + f""",
mt AS (SELECT window_start, 'error_rate_5xx' AS metric, rate_5xx AS value FROM ({ERR})
       UNION ALL SELECT date_trunc('day', ts), 'latency_p50_ms', quantile_cont(elapsed_ms, 0.5) FROM lg GROUP BY 1
       UNION ALL SELECT date_trunc('day', ts), 'latency_p95_ms', quantile_cont(elapsed_ms, 0.95) FROM lg GROUP BY 1)""",
  Q.round_cols("""SELECT metric, window_start, value, '>' AS op,
  CASE metric WHEN 'error_rate_5xx' THEN 0.005::DOUBLE WHEN 'latency_p95_ms' THEN 500.0::DOUBLE ELSE 200.0::DOUBLE END AS bound,
  CASE metric WHEN 'error_rate_5xx' THEN 'P1' WHEN 'latency_p95_ms' THEN 'P2' ELSE 'P4' END AS severity,
  CASE metric WHEN 'error_rate_5xx' THEN 'pager+chat' WHEN 'latency_p95_ms' THEN 'chat' ELSE 'daily log' END AS channel
FROM mt WHERE (metric = 'error_rate_5xx' AND value > 0.005) OR (metric = 'latency_p95_ms' AND value > 500)
   OR (metric = 'latency_p50_ms' AND value > 200)""",
               ["value"])))(
    lambda spark, d: rounded(R.alerts(_day_metrics(spark, d)), ["value"]))

@query("r16_streak", Q.with_(EV + """,
hd AS (SELECT host, date_trunc('day', ts) AS day, count(*) FILTER (WHERE status >= 500) / count(*) AS rate_5xx FROM lg GROUP BY 1, 2),
bd AS (SELECT *, CAST(coalesce(rate_5xx > 0.2, false) AS INTEGER) AS bad FROM hd)""",
  Q.round_cols("""SELECT host, day, rate_5xx, bad = 1 AND coalesce(lag(bad, 1) OVER (PARTITION BY host ORDER BY day), 0) = 1
  AND lag(day, 1) OVER (PARTITION BY host ORDER BY day) = day - INTERVAL 1 DAY AS streak_alert
FROM bd""", ["rate_5xx"])))
def r16_streak(spark, d):
    lg_ = log(spark, d)
    hd = lg_.groupBy("host", F.date_trunc("day", "ts").alias("day")).agg(
        (F.count_if(F.col("status") >= 500) / F.count(F.lit(1))).alias("rate_5xx"))
    return rounded(R.streak(hd, "host", "day", F.col("rate_5xx") > 0.2, 2), ["rate_5xx"])


@query("r17_retrain_decision", Q.with_(EDGES + """,
br AS (SELECT column, len(list_filter(edges, lambda x: x < value)) AS bin FROM lr JOIN ed USING (column)),
bc AS (SELECT column, len(list_filter(edges, lambda x: x < value)) AS bin FROM lc JOIN ed USING (column)),
ab AS (SELECT column, range AS bin FROM ed, range(0, 10)),
cn AS (SELECT ab.column, ab.bin, (SELECT count(*) FROM br WHERE br.column = ab.column AND br.bin = ab.bin) AS n_ref,
              (SELECT count(*) FROM bc WHERE bc.column = ab.column AND bc.bin = ab.bin) AS n_cur FROM ab),
sh AS (SELECT column, greatest(n_ref / sum(n_ref) OVER (PARTITION BY column), 1e-4) AS r,
              greatest(n_cur / sum(n_cur) OVER (PARTITION BY column), 1e-4) AS c FROM cn),
ps AS (SELECT column, sum((c - r) * ln(c / r)) AS psi FROM sh GROUP BY column),
ag AS (SELECT max(psi) AS max_psi, CAST(count(*) FILTER (WHERE psi > 0.25) AS BIGINT) AS n_high FROM ps)""",
  Q.round_cols("""SELECT max_psi, n_high, 8.0::DOUBLE AS age_months, max_psi > 0.2 OR n_high >= 3 OR 8.0 > 6.0 AS retrain FROM ag""",
               ["max_psi"])))
def r17_retrain_decision(spark, d):
    ref, cur = ref_cur(spark, d)
    out = R.retrain_decision(R.psi(ref, cur, NUM), "2024-01-01 00:00:00",
                             now=F.to_timestamp(F.lit("2024-09-01 00:00:00")))
    return rounded(out, ["max_psi"])


FAIR = Q.SNAPSHOT + """,
vs AS (SELECT customerid AS id, churn_value AS label, y_score AS score, gender, senior_citizen FROM snap),
fg AS (SELECT gender, coalesce(count(*) FILTER (WHERE score >= 0.5 AND label = 1) / nullif(count(*) FILTER (WHERE label = 1), 0), 0.0) AS recall,
              coalesce(count(*) FILTER (WHERE score >= 0.5 AND label <> 1) / nullif(count(*) FILTER (WHERE label <> 1), 0), 0.0) AS fpr,
              CAST(count(*) AS BIGINT) AS n FROM vs GROUP BY gender),
gp AS (SELECT max(recall) - min(recall) AS recall_gap, max(fpr) - min(fpr) AS fpr_gap FROM fg)"""


def _fair_input(spark, d):
    s = snapshot(spark, d)
    return s.select(F.col("customerid").alias("id"), F.col("churn_value").alias("label"),
                    F.col("y_score").alias("score"), "gender", "senior_citizen")


_R19 = ["recall", "fpr", "recall_gap", "fpr_gap"]
query("r19_fairness", Q.with_(FAIR, Q.round_cols(
    "SELECT gender, recall, fpr, n, recall_gap, fpr_gap, recall_gap > 0.1 OR fpr_gap > 0.1 AS flag FROM fg, gp", _R19)))(
    lambda spark, d: rounded(R.fairness(_fair_input(spark, d), "gender"), _R19))

query("r18_enough", Q.with_(FAIR, Q.round_cols("SELECT gender, recall, fpr, n, n >= 200 AS enough_sample FROM fg",
                                               ["recall", "fpr"])))(
    lambda spark, d: rounded(R.enough(R.fairness(_fair_input(spark, d), "gender")
                                      .select("gender", "recall", "fpr", "n")), ["recall", "fpr"]))

@query("r21_auc_decay", Q.with_(OUTCOME + f""",
wk AS (SELECT 'events' AS model, time_bucket(INTERVAL 7 DAY, ts, {EPOCH}) AS period, outcome AS label, score
       FROM jo JOIN pr USING (pred_id, user_id, ts)),
p0 AS (SELECT model, period, score, sum(label) AS pos, sum(1 - label) AS neg FROM wk GROUP BY 1, 2, 3),
p1 AS (SELECT *, sum(neg) OVER (PARTITION BY model, period ORDER BY score DESC) AS fp,
              sum(pos) OVER (PARTITION BY model, period) AS P, sum(neg) OVER (PARTITION BY model, period) AS N FROM p0),
au AS (SELECT model, period, CAST(sum(pos * (2 * (N - fp) + neg)) AS DOUBLE) / (2.0 * any_value(P) * any_value(N)) AS roc_auc
       FROM p1 GROUP BY model, period),
bs AS (SELECT *, first_value(roc_auc) OVER (PARTITION BY model ORDER BY period) AS baseline_auc FROM au)""",
  Q.round_cols("""SELECT model, period, roc_auc, baseline_auc, (baseline_auc - roc_auc) / baseline_auc AS drop,
  (baseline_auc - roc_auc) / baseline_auc > 0.05 AS alert FROM bs""", ["roc_auc", "baseline_auc", "drop"])))
def r21_auc_decay(spark, d):
    j = joined(spark, d).select(F.lit("events").alias("model"),
                                F.window("ts", "7 days").getField("start").alias("period"),
                                F.col("outcome").alias("label"), "score")
    a = roc_auc(j, ["model", "period"])
    return rounded(R.auc_decay(a), ["roc_auc", "baseline_auc", "drop"])


# ------------------------------------------------------------------ R20, R22, R23, R27, R29
@query("r20_campaign_monitor", Q.with_(EV + """,
cl AS (SELECT ts, CAST(event_type IN ('view', 'click') AS INTEGER) AS contacted, CAST(event_type = 'purchase' AS INTEGER) AS converted,
              CAST(event_type = 'click' AS INTEGER) AS fp, CAST(event_type = 'error' AS INTEGER) AS fn FROM events),
g AS (SELECT date_trunc('week', ts) AS period, CAST(sum(contacted) AS BIGINT) AS contacted, CAST(sum(converted) AS BIGINT) AS converted,
             sum(fp) * 73.52::DOUBLE AS fp_cost, sum(fn) * 2845.0::DOUBLE AS fn_cost FROM cl GROUP BY 1)""",
  Q.round_cols("""SELECT *, coalesce(converted / nullif(contacted, 0), 0.0) AS conversion,
  contacted * 50.0::DOUBLE / nullif(converted, 0) AS cost_per_retained,
  coalesce(converted / nullif(contacted, 0), 0.0) >= 0.4 AS conversion_ok,
  coalesce(contacted * 50.0 / nullif(converted, 0) <= 75.0, false) AS cost_ok,
  (fp_cost + fn_cost) / first_value(fp_cost + fn_cost) OVER (ORDER BY period) - 1 AS cost_change,
  abs((fp_cost + fn_cost) / first_value(fp_cost + fn_cost) OVER (ORDER BY period) - 1) <= 0.15 AS cost_within FROM g""",
               ["fp_cost", "fn_cost", "conversion", "cost_per_retained", "cost_change"])))
def r20_campaign_monitor(spark, d):
    e = events(spark, d)
    t = F.col("event_type")
    cl = e.select("ts", t.isin("view", "click").cast("int").alias("contacted"),
                  (t == "purchase").cast("int").alias("converted"), (t == "click").cast("int").alias("fp"),
                  (t == "error").cast("int").alias("fn"))
    return rounded(R.campaign_monitor(cl), ["fp_cost", "fn_cost", "conversion", "cost_per_retained", "cost_change"])


@query("r22_rejection_profile", Q.with_(Q.SNAPSHOT + """,
lw AS (SELECT * REPLACE (""" + ", ".join(
    f"CASE WHEN customerid % 5 = 0 THEN lower({c}) ELSE {c} END AS {c}" for c in S.CATEGORICAL_INPUTS) + """,
    TRY_CAST(total_charges AS DOUBLE) AS total_charges) FROM snap),
er AS (""" + "\n  UNION ALL ".join(
    [f"SELECT '{c}' AS field, NULL::VARCHAR AS received FROM lw WHERE {c} IS NULL" for c in S.INPUT_FIELDS] +
    [f"SELECT '{c}', {c} FROM lw WHERE {c} IS NOT NULL AND {c} NOT IN (" + ", ".join(f"'{v}'" for v in vals) + ")"
     for c, vals in S.DOMAINS.items()] +
    [f"SELECT '{c}', CAST({c} AS VARCHAR) FROM lw WHERE {c} < {lo} OR {c} > {hi}" for c, (lo, hi) in S.RANGES.items()])
  + ")",
  "SELECT field, received, CAST(count(*) AS BIGINT) AS n FROM er GROUP BY field, received"))
def r22_rejection_profile(spark, d):
    """Validation (P17) of the snapshot with lower-cased text for every fifth
    customer, then failed fields and unknown values (R22)."""
    raw = C.coerce_numeric(snapshot(spark, d, casing=True), ["total_charges"])
    _, rejected = C.validate(raw)
    return R.rejection_profile(rejected)


query("r23_sessions", Q.with_(EV + """,
gp AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                                  OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS brk
       FROM events),
sn AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM gp)""",
  """SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, CAST(count(*) AS BIGINT) AS n_events
FROM sn GROUP BY user_id, sid"""))(lambda spark, d: R.sessions(events(spark, d)))

query("r27_amplification", Q.with_(FAIR, Q.round_cols("""SELECT gender, avg(CAST(score >= 0.5 AS DOUBLE)) AS predicted_rate,
  avg(CAST(label AS DOUBLE)) AS actual_rate, avg(CAST(score >= 0.5 AS DOUBLE)) / nullif(avg(CAST(label AS DOUBLE)), 0) AS amplification
FROM vs GROUP BY gender""", ["predicted_rate", "actual_rate", "amplification"])))(
    lambda spark, d: rounded(R.amplification(_fair_input(spark, d), "gender"),
                             ["predicted_rate", "actual_rate", "amplification"]))

# Retention actions by the campaign key in the event properties
ACTION_SQL = ("CASE CAST(json_extract(props, '$.k') AS INTEGER) % 3 WHEN 0 THEN 'discount' "
              "WHEN 1 THEN 'gift' ELSE 'service' END")


@query("r29_conversion_by_action", Q.with_(EV, Q.round_cols(f"""SELECT {ACTION_SQL} AS action, CAST(count(*) AS BIGINT) AS n,
  avg(CAST(event_type = 'purchase' AS DOUBLE)) AS conversion_rate FROM events GROUP BY 1""", ["conversion_rate"])))
def r29_conversion_by_action(spark, d):
    e = events(spark, d)
    k = F.get_json_object("props", "$.k").cast("int") % 3
    a = e.select(F.when(k == 0, "discount").when(k == 1, "gift").otherwise("service").alias("action"),
                 (F.col("event_type") == "purchase").alias("converted"))
    return rounded(R.conversion_by_action(a), ["conversion_rate"])
