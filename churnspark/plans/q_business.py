"""Registered queries: business analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnspark.operators import business as B
from churnspark.operators.evaluate import confusion
from churnspark.plans import sql as Q
from churnspark.plans.registry import query, rounded
from churnspark.plans.slice import cleaned_features
from churnspark.session import cut_lineage
from churnspark.sources.tables import customer_months, scores


# Campaign threshold policies
POLICIES = [("aggressive", 0.30), ("balanced", 0.40), ("conservative", 0.50), ("strict", 0.60)]


def feat(spark, d):
    return cut_lineage(cleaned_features(spark, d))


def vendor_costed(spark, d):
    """Snapshot score with each customer's own FN cost (residual CLTV)."""
    f = feat(spark, d)
    return f.select(F.lit("vendor").alias("model"), F.col("customerid").cast("bigint").alias("id"),
                    F.col("churn_value").cast("int").alias("label"), F.col("y_score").alias("score"),
                    B.residual().alias("fn_cost"))


RES = Q.FEAT + """,
ch AS (SELECT *, greatest(cltv - total_charges, 0.0) AS residual FROM feat WHERE churn_value = 1),
fc AS (SELECT avg(monthly_charges) FILTER (WHERE churn_value = 0) AS active_ticket FROM feat)"""

_B1 = ["mean", "pct_zero", "p10", "p25", "median", "p75", "p90"]
query("b1_residual_clv", Q.with_(RES, Q.round_cols("""SELECT avg(residual) AS mean,
  CAST(count(*) FILTER (WHERE residual = 0) AS BIGINT) AS n_zero,
  count(*) FILTER (WHERE residual = 0) * 100.0 / count(*) AS pct_zero,
  CAST(count(*) AS BIGINT) AS n, quantile_cont(residual, 0.1) AS p10, quantile_cont(residual, 0.25) AS p25,
  quantile_cont(residual, 0.5) AS median, quantile_cont(residual, 0.75) AS p75, quantile_cont(residual, 0.9) AS p90
FROM ch""", _B1)))(lambda spark, d: rounded(B.residual_clv(feat(spark, d)), _B1))


@query("b2_future_revenue", Q.with_(Q.FEAT, Q.round_cols("""SELECT churn_value,
  sum(CASE WHEN cltv - total_charges >= 0 THEN cltv - total_charges ELSE 12 * monthly_charges END) AS future_revenue,
  avg(CASE WHEN cltv - total_charges >= 0 THEN cltv - total_charges ELSE 12 * monthly_charges END) AS mean_future_revenue
FROM feat GROUP BY churn_value""", ["future_revenue", "mean_future_revenue"])))
def b2_future_revenue(spark, d):
    f = feat(spark, d).withColumn("fr", B.future_revenue())
    return rounded(f.groupBy("churn_value").agg(F.sum("fr").alias("future_revenue"),
                                                F.avg("fr").alias("mean_future_revenue")),
                   ["future_revenue", "mean_future_revenue"])


_B3 = ["active_ticket", "annual_ticket", "fp_cost"]
query("b3_fp_cost", Q.with_(Q.FEAT + ",\nt AS (SELECT avg(monthly_charges) FILTER (WHERE churn_value = 0) AS a FROM feat)",
                            Q.round_cols("SELECT a AS active_ticket, a * 12 AS annual_ticket, a * 12 * 0.1 AS fp_cost FROM t", _B3)))(
    lambda spark, d: rounded(B.fp_cost(cleaned_features(spark, d)), _B3))

_B4 = ["ratio_median", "ratio_mean", "ratio_p25", "ratio_p75", "fp_cost"]
query("b4_cost_ratio", Q.with_(RES + """,
r AS (SELECT quantile_cont(residual, 0.5) AS md, avg(residual) AS mn, quantile_cont(residual, 0.25) AS p25,
             quantile_cont(residual, 0.75) AS p75 FROM ch)""", Q.round_cols("""SELECT md / (active_ticket * 12 * 0.1) AS ratio_median,
  mn / (active_ticket * 12 * 0.1) AS ratio_mean, p25 / (active_ticket * 12 * 0.1) AS ratio_p25,
  p75 / (active_ticket * 12 * 0.1) AS ratio_p75, active_ticket * 12 * 0.1 AS fp_cost FROM r, fc""", _B4)))(
    lambda spark, d: rounded(B.cost_ratio(feat(spark, d)), _B4))

BAND_SQL = ("CASE WHEN tenure_months BETWEEN 0 AND 6 THEN '0-6' WHEN tenure_months BETWEEN 7 AND 12 THEN '7-12' "
            "WHEN tenure_months BETWEEN 13 AND 24 THEN '13-24' WHEN tenure_months BETWEEN 25 AND 48 THEN '25-48' "
            "WHEN tenure_months BETWEEN 49 AND 72 THEN '49-72' END")
_B5 = ["share", "mean_ticket", "median_residual", "ratio", "pct_zero"]
query("b5_value_by_tenure", Q.with_(RES + f""",
bd AS (SELECT *, {BAND_SQL} AS band FROM ch),
g AS (SELECT band, CAST(count(*) AS BIGINT) AS n, avg(monthly_charges) AS mean_ticket,
             quantile_cont(residual, 0.5) AS median_residual,
             count(*) FILTER (WHERE residual = 0) * 100.0 / count(*) AS pct_zero FROM bd GROUP BY band),
tt AS (SELECT count(*) AS tot FROM ch)""", Q.round_cols("""SELECT band, n, n * 100.0 / tot AS share, mean_ticket, median_residual,
  median_residual / (active_ticket * 12 * 0.1) AS ratio, pct_zero FROM g, tt, fc""", _B5)))(
    lambda spark, d: rounded(B.value_by_tenure(feat(spark, d)), _B5))

VC = RES.split(",\nch AS")[0] + """,
vc AS (SELECT 'vendor' AS model, CAST(customerid AS BIGINT) AS id, CAST(churn_value AS INTEGER) AS label,
              y_score AS score, greatest(cltv - total_charges, 0.0) AS fn_cost FROM feat)"""

_B6 = ["recall", "precision", "cost_fn", "cost_fp", "cost_total", "f1"]
_P = "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0)"
_R = "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0)"
query("b6_individual_cost_curve", Q.with_(VC + """,
grid AS (SELECT range + 1 AS i, (range + 1) / 100 AS threshold FROM range(0, 99)),
sw AS (SELECT model, threshold,
  CAST(count(*) FILTER (WHERE score >= threshold AND label = 1) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE score >= threshold AND label = 0) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE score < threshold AND label = 1) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE score < threshold AND label = 0) AS BIGINT) AS tn,
  coalesce(sum(fn_cost) FILTER (WHERE score < threshold AND label = 1), 0.0) AS cost_fn
  FROM vc, grid GROUP BY model, threshold),
m AS (SELECT *, """ + _R + " AS recall, " + _P + """ AS precision, fp * 73.52::DOUBLE AS cost_fp,
        cost_fn + fp * 73.52::DOUBLE AS cost_total FROM sw),
m2 AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM m),
bt AS (SELECT model, arg_min(threshold, (cost_total, threshold)) AS opt, arg_min(threshold, (-f1, threshold)) AS bf1 FROM m2 GROUP BY model)""",
  Q.round_cols("""SELECT m2.model, threshold, tp, fp, fn, tn, recall, precision, cost_fn, cost_fp, cost_total, f1,
  threshold = opt AS is_optimum, threshold = 0.5 AS is_default, threshold = bf1 AS is_max_f1 FROM m2 JOIN bt USING (model)""", _B6)))(
    lambda spark, d: rounded(B.individual_cost_curve(vendor_costed(spark, d)), _B6))

CONF5 = Q.SCORES + """,
c AS (SELECT model,
  CAST(count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE score < 0.5 AND label = 0) AS BIGINT) AS tn,
  CAST(count(*) FILTER (WHERE score < 0.5 AND label = 1) AS BIGINT) AS fn FROM scores GROUP BY model)"""
_B7 = ["net_savings", "savings_vs_no_model", "avoided_rate", "campaign_roi", "cost_per_retained", "cac_share"]
query("b7_campaign_metrics", Q.with_(CONF5, Q.round_cols("""SELECT model, tp, fp, tn, fn,
  tp * (2400.0 * 0.4 - 50.0) - fp * 50.0 - fn * 2400.0 AS net_savings,
  tp * (2400.0 * 0.4 - 50.0) - fp * 50.0 - fn * 2400.0 + (tp + fn) * 2400.0 AS savings_vs_no_model,
  coalesce(tp * 0.4 / nullif(tp + fn, 0), 0.0) AS avoided_rate,
  coalesce(tp * 2400.0 * 0.4 / nullif((tp + fp) * 50.0, 0), 0.0) AS campaign_roi,
  (tp + fp) * 50.0 / nullif(tp * 0.4, 0) AS cost_per_retained,
  (tp + fp) * 50.0 / nullif(tp * 0.4, 0) / 400.0 AS cac_share,
  (tp + fp) * 50.0 / nullif(tp * 0.4, 0) / 400.0 < 0.3 AS cac_ok FROM c""", _B7)))(
    lambda spark, d: rounded(B.campaign_metrics(confusion(scores(spark, d), 0.5), cac=400.0).drop("threshold"),
                             _B7))

_B9 = ["top_precision", "base_rate", "lift"]
query("b9_top_lift", Q.with_(Q.SCORES + """,
rk AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY score DESC, id) AS rn,
              count(*) OVER (PARTITION BY model) AS n, sum(label) OVER (PARTITION BY model) AS P FROM scores),
tp AS (SELECT model, any_value(n) AS n, CAST(ceil(any_value(n) * 0.1) AS BIGINT) AS k, any_value(P) AS P,
              sum(label) FILTER (WHERE rn <= ceil(n * 0.1)) AS top FROM rk GROUP BY model)""",
  Q.round_cols("""SELECT model, CAST(n AS BIGINT) AS n, k, CAST(top AS BIGINT) AS top_positives, top / k AS top_precision,
  P / n AS base_rate, (top / k) / (P / n) AS lift FROM tp""", _B9)))(
    lambda spark, d: rounded(B.top_lift(scores(spark, d)), _B9))

_B11 = ["detected", "retained", "gross", "cost", "net", "roi"]
query("b11_scenario_grid", Q.with_(RES + """,
bs AS (SELECT count(*) AS churners, avg(residual) AS mr FROM ch),
gr AS (SELECT * FROM (VALUES (0.5), (0.7), (0.8), (0.9)) r(recall), (VALUES (0.4), (0.5)) c(conversion))""",
  Q.round_cols("""SELECT CAST(recall AS DOUBLE) AS recall, CAST(conversion AS DOUBLE) AS conversion,
  churners * recall AS detected, churners * recall * conversion AS retained,
  churners * recall * conversion * mr AS gross, churners * recall * conversion * 73.52 AS cost,
  churners * recall * conversion * mr - churners * recall * conversion * 73.52 AS net,
  (churners * recall * conversion * mr - churners * recall * conversion * 73.52) / (churners * recall * conversion * 73.52) AS roi
FROM gr, bs""", _B11)))(
    lambda spark, d: rounded(B.scenario_grid(feat(spark, d)), _B11))

_B12 = ["contacted", "retained", "value_saved", "offer_cost", "net", "value_lost"]
query("b12_strategy_compare", Q.with_(VC + """,
grid AS (SELECT (range + 1) / 100 AS threshold FROM range(0, 99)),
sw AS (SELECT model, threshold,
  count(*) FILTER (WHERE score >= threshold AND label = 1) AS tp,
  count(*) FILTER (WHERE score >= threshold AND label = 0) AS fp,
  count(*) FILTER (WHERE score < threshold AND label = 1) AS fn FROM vc, grid GROUP BY model, threshold),
pk AS (SELECT model, r, arg_max(tp, threshold) AS tp, arg_max(fp, threshold) AS fp FROM sw, (VALUES (0.7), (0.9)) t(r)
       WHERE coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) >= r GROUP BY model, r),
bs AS (SELECT model, count(*) AS n, sum(label) AS P, sum(CASE WHEN label = 1 THEN fn_cost ELSE 0.0 END) AS V FROM vc GROUP BY model),
j AS (SELECT bs.*, V / P AS mv FROM bs),
st AS (SELECT model, 'no_action' AS strategy, 0.0::DOUBLE AS alerts, 0.0::DOUBLE AS contacted, 0.0::DOUBLE AS retained, 0.0::DOUBLE AS offer_cost, mv, P, V FROM j
       UNION ALL SELECT model, 'contact_all', CAST(n AS DOUBLE), CAST(n - P AS DOUBLE), CAST(P AS DOUBLE), (n - P) * 73.52, mv, P, V FROM j
       UNION ALL SELECT model, CASE WHEN r = 0.7 THEN 'model_recall_0.7' ELSE 'model_recall_0.9' END, CAST(tp + fp AS DOUBLE), CAST(tp AS DOUBLE), tp * 0.5,
                        tp * 0.5 * 73.52, mv, P, V FROM j JOIN pk USING (model))""",
  Q.round_cols("""SELECT model, strategy, alerts, contacted, retained, retained * mv AS value_saved, offer_cost,
  CASE WHEN strategy = 'no_action' THEN -V ELSE retained * mv - offer_cost END AS net, (P - retained) * mv AS value_lost FROM st""",
               _B12)))(
    lambda spark, d: rounded(B.strategy_compare(vendor_costed(spark, d)), _B12))

query("b13_break_even", Q.with_(RES + ",\nac AS (SELECT * FROM (VALUES (30.0), (50.0), (75.0)) t(action_cost))",
  Q.round_cols("""SELECT CAST(action_cost AS DOUBLE) AS action_cost, active_ticket, active_ticket - action_cost AS margin,
  CASE WHEN active_ticket - action_cost > 0 THEN CAST(floor(500.0 / (active_ticket - action_cost)) + 1 AS BIGINT) END AS break_even,
  active_ticket - action_cost > 0 AS viable FROM ac, fc""", ["active_ticket", "margin"])))(
    lambda spark, d: rounded(B.break_even(feat(spark, d)), ["active_ticket", "margin"]))

query("b14_action_roi", Q.with_(Q.FEAT + """,
t AS (SELECT avg(monthly_charges) AS ticket FROM feat),
a AS (SELECT * FROM (VALUES ('discount_10pct_12m', 12, 0.10, 0.0), ('gift_service_3m', 3, 0.15, 0.0),
                            ('plan_upgrade_6m', 6, 0.20, 0.0), ('better_service', 0, 0.0, 15.0)) v(action, months, share, fixed))""",
  Q.round_cols("""SELECT action, ticket * months * CAST(share AS DOUBLE) + CAST(fixed AS DOUBLE) AS cost, ticket * 12 AS saved,
  (ticket * 12 - (ticket * months * CAST(share AS DOUBLE) + CAST(fixed AS DOUBLE))) / (ticket * months * CAST(share AS DOUBLE) + CAST(fixed AS DOUBLE)) AS roi
FROM a, t""", ["cost", "saved", "roi"])))(
    lambda spark, d: rounded(B.action_roi(feat(spark, d)), ["cost", "saved", "roi"]))

_B15 = ["mrr", "mrr_lost", "revenue", "future_revenue_destroyed"]
query("b15_financial_state", Q.with_(Q.FEAT, Q.round_cols("""SELECT CAST(count(*) AS BIGINT) AS clients,
  CAST(count(*) FILTER (WHERE churn_value <> 1) AS BIGINT) AS active, CAST(count(*) FILTER (WHERE churn_value = 1) AS BIGINT) AS lost,
  sum(CASE WHEN churn_value <> 1 THEN monthly_charges ELSE 0.0 END) AS mrr,
  sum(CASE WHEN churn_value = 1 THEN monthly_charges ELSE 0.0 END) AS mrr_lost, sum(total_charges) AS revenue,
  sum(CASE WHEN churn_value = 1 THEN (CASE WHEN cltv - total_charges >= 0 THEN cltv - total_charges ELSE 12 * monthly_charges END) ELSE 0.0 END) AS future_revenue_destroyed,
  CAST(sum(CASE WHEN churn_value = 1 THEN cltv ELSE 0 END) AS BIGINT) AS cltv_lost FROM feat""", _B15)))(
    lambda spark, d: rounded(B.financial_state(feat(spark, d)), _B15))

PANEL = Q.SNAPSHOT + """,
po AS (SELECT o_custkey AS customerid, date_trunc('month', min(o_orderdate)) AS m0,
              date_trunc('month', max(o_orderdate)) AS m1 FROM orders GROUP BY o_custkey),
px AS (SELECT s.customerid, s.contract, s.monthly_charges, s.churn_value, m1,
              unnest(generate_series(m0, m1, INTERVAL 1 MONTH)) AS m FROM snap s JOIN po USING (customerid)),
panel AS (SELECT CAST(m AS DATE) AS month, customerid, contract, monthly_charges,
                 CASE WHEN churn_value = 1 AND m = m1 THEN 1 ELSE 0 END AS churned FROM px),
mc AS (SELECT month, count(*) AS active, sum(churned) AS churned, sum(churned) / count(*) AS churn_rate,
              sum(CASE WHEN churned = 1 THEN monthly_charges ELSE 0.0 END) AS mrr_churned FROM panel GROUP BY month)"""

query("b16_mrr_saved", Q.with_(PANEL + """,
ms AS (SELECT contract, month, sum(CASE WHEN churned = 0 THEN monthly_charges ELSE 0.0 END) AS mrr_saved
       FROM panel GROUP BY contract, month),
lg AS (SELECT *, lag(mrr_saved, 1) OVER (PARTITION BY contract ORDER BY month) AS l1,
              lag(mrr_saved, 2) OVER (PARTITION BY contract ORDER BY month) AS l2 FROM ms)""",
  Q.round_cols("""SELECT contract, month, mrr_saved,
  coalesce(mrr_saved < l1 * (1 - 0.15), false) AND coalesce(l1 < l2 * (1 - 0.15), false) AS alert FROM lg""", ["mrr_saved"])))(
    lambda spark, d: rounded(B.mrr_saved(customer_months(spark, d)), ["mrr_saved"]))

_B17 = ["churners_per_month", "monthly_rate", "mrr_at_risk_per_month"]
query("b17_run_rate", Q.with_(PANEL + ",\nlm AS (SELECT max(month) AS last FROM mc)",
  Q.round_cols("""SELECT avg(churned) AS churners_per_month, sum(churned) / sum(active) AS monthly_rate,
  avg(mrr_churned) AS mrr_at_risk_per_month FROM mc, lm WHERE month > last - INTERVAL 12 MONTH""", _B17)))(
    lambda spark, d: rounded(B.run_rate(customer_months(spark, d)), _B17))

query("b18_policy_metrics", Q.with_(Q.SCORES + """,
pol AS (SELECT * FROM (VALUES ('aggressive', 0.30), ('balanced', 0.40), ('conservative', 0.50), ('strict', 0.60)) t(policy, threshold)),
c AS (SELECT model, policy, CAST(threshold AS DOUBLE) AS threshold,
  CAST(count(*) FILTER (WHERE score >= threshold AND label = 1) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE score >= threshold AND label = 0) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE score < threshold AND label = 0) AS BIGINT) AS tn,
  CAST(count(*) FILTER (WHERE score < threshold AND label = 1) AS BIGINT) AS fn FROM scores, pol GROUP BY model, policy, threshold)""",
  Q.round_cols("""SELECT *, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS precision,
  coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS recall, tp + fp AS contacted FROM c""", ["precision", "recall"])))(
    lambda spark, d: rounded(B.policy_metrics(scores(spark, d), POLICIES), ["precision", "recall"]))

query("b19_churn_change", Q.with_(PANEL, Q.round_cols("""SELECT rate_before, rate_after, (rate_after - rate_before) * 100 AS change_pp,
  (rate_after - rate_before) * 100 <= -5.0 AS target_met FROM (
  SELECT avg(churn_rate) FILTER (WHERE month < DATE '2000-01-01') AS rate_before,
         avg(churn_rate) FILTER (WHERE month >= DATE '2000-01-01') AS rate_after FROM mc)""",
    ["rate_before", "rate_after", "change_pp"])))(
    lambda spark, d: rounded(B.churn_change(customer_months(spark, d), "2000-01-01"),
                             ["rate_before", "rate_after", "change_pp"]))
