"""Business analytics on the customer table and on confusion counts.

Inputs: the cleaned snapshot (``cltv``, ``total_charges``, ``monthly_charges``,
``tenure_months``, ``churn_value``), a scored table ``(model, id, label,
score[, fn_cost])``, or the customer-month panel.  Small parameter tables
(scenario grids, actions, policies) are driver literals of a few rows,
broadcast; the data-sized work is always one aggregate or one sweep.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark import schemas as S
from churnspark.operators.evaluate import _div0
from churnspark.operators.prefix import Grid, cumulative, exact_quantiles, sweep


def residual(cltv: str = "cltv", total: str = "total_charges") -> Column:
    """max(CLTV - total charges, 0): the future value a churner takes away."""
    return F.greatest(F.col(cltv) - F.col(total), F.lit(0.0))


def _one(df: DataFrame) -> DataFrame:
    return df.withColumn("_j", F.lit(1))


def _join1(a: DataFrame, b: DataFrame) -> DataFrame:
    """Join with a one-row table (broadcast: size bound is one row)."""
    return _one(a).join(F.broadcast(_one(b)), "_j").drop("_j")


# ---------------------------------------------------------------- B1-B5
def residual_clv(df: DataFrame, label: str = "churn_value") -> DataFrame:
    """B1: residual value over churners: mean, median, P10/P25/P75/P90, zeros."""
    ch = df.where(F.col(label) == 1).withColumn("residual", residual())
    q = exact_quantiles(ch, None, "residual", [0.1, 0.25, 0.5, 0.75, 0.9],
                        ["p10", "p25", "median", "p75", "p90"])
    m = ch.agg(F.avg("residual").alias("mean"),
               F.count_if(F.col("residual") == 0).cast("bigint").alias("n_zero"),
               (F.count_if(F.col("residual") == 0) * 100.0 / F.count(F.lit(1))).alias("pct_zero"))
    return _join1(m, q)


def future_revenue(monthly: str = "monthly_charges") -> Column:
    """B2: CLTV - total if that gap is >= 0, else 12 x monthly charges."""
    gap = F.col("cltv") - F.col("total_charges")
    return F.when(gap >= 0, gap).otherwise(12 * F.col(monthly))


def fp_cost(df: DataFrame, discount: float = 0.10, label: str = "churn_value") -> DataFrame:
    """FP cost = mean ticket of active customers x 12 x discount."""
    t = F.avg(F.when(F.col(label) == 0, F.col("monthly_charges")))
    return df.agg(t.alias("active_ticket"), (t * 12).alias("annual_ticket"),
                  (t * 12 * discount).alias("fp_cost"))


def cost_ratio(df: DataFrame, discount: float = 0.10) -> DataFrame:
    """FN/FP cost ratio for the median, mean, P25 and P75 residual."""
    r = _join1(residual_clv(df), fp_cost(df, discount))
    return r.select(*[(F.col(c) / F.col("fp_cost")).alias(f"ratio_{c}")
                      for c in ("median", "mean", "p25", "p75")], "fp_cost")


def tenure_band(col: str = "tenure_months", bands=S.TENURE_BANDS) -> Column:
    out = None
    for lo, hi, name in bands:
        cond = (F.col(col) >= lo) & (F.col(col) <= hi)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def value_by_tenure(df: DataFrame, discount: float = 0.10, label: str = "churn_value") -> DataFrame:
    """Churners by tenure band: n, share, mean ticket, median residual,
    FN/FP ratio, % with zero residual."""
    ch = df.where(F.col(label) == 1).withColumn("band", tenure_band()).withColumn("residual", residual())
    g = ch.groupBy("band").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                               F.avg("monthly_charges").alias("mean_ticket"),
                               (F.count_if(F.col("residual") == 0) * 100.0 / F.count(F.lit(1))).alias("pct_zero"))
    med = exact_quantiles(ch, ["band"], "residual", [0.5], ["median_residual"]).drop("n")
    tot = ch.agg(F.count(F.lit(1)).alias("_tot"))
    fc = fp_cost(df, discount).select("fp_cost")
    out = _join1(_join1(g.join(med, "band"), tot), fc)
    return out.select("band", "n", (F.col("n") * 100.0 / F.col("_tot")).alias("share"), "mean_ticket",
                      "median_residual", (F.col("median_residual") / F.col("fp_cost")).alias("ratio"),
                      "pct_zero")


# ---------------------------------------------------------------- B6
def individual_cost_curve(df: DataFrame, fp_unit: float = 73.52, grid: Grid | None = None,
                          keys=("model",)) -> DataFrame:
    """Per threshold, FN cost = sum of each missed churner's own residual
    (``fn_cost`` column), FP cost = FP x unit, total; flags the optimum
    (lowest total, lowest t on ties), the default 0.50 and the max-F1 point."""
    keys = list(keys)
    grid = grid or Grid.percent(1, 99)
    s = sweep(df, grid, keys, extra={"cost": F.col("fn_cost")})
    prec = _div0(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _div0(F.col("tp"), F.col("tp") + F.col("fn"))
    s = s.select(*keys, "threshold", "tp", "fp", "fn", "tn", rec.alias("recall"), prec.alias("precision"),
                 F.col("fn_cost").alias("cost_fn"), (F.col("fp") * fp_unit).alias("cost_fp"),
                 (F.col("fn_cost") + F.col("fp") * fp_unit).alias("cost_total"),
                 _div0(2 * prec * rec, prec + rec).alias("f1"))
    best = s.groupBy(*keys).agg(
        F.min_by("threshold", F.struct(F.col("cost_total"), F.col("threshold"))).alias("_opt"),
        F.min_by("threshold", F.struct(-F.col("f1"), F.col("threshold"))).alias("_f1"))
    return (s.join(F.broadcast(best), keys)
             .withColumns({"is_optimum": F.col("threshold") == F.col("_opt"),
                           "is_default": F.col("threshold") == 0.5,
                           "is_max_f1": F.col("threshold") == F.col("_f1")})
             .drop("_opt", "_f1"))


# ---------------------------------------------------------------- B7-B10, B20
def campaign_metrics(conf: DataFrame, p: S.CampaignParams = S.CampaignParams(),
                     cac: float | None = None) -> DataFrame:
    """B7 net savings (+ vs no model), B8 avoided-churn rate, B10 campaign
    ROI and B20 retention cost vs acquisition cost, from confusion counts."""
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    net = tp * (p.clv * p.retention_rate - p.contact_cost) - fp * p.contact_cost - fn * p.clv
    no_model = -(tp + fn) * p.clv
    out = conf.withColumns({
        "net_savings": net,
        "savings_vs_no_model": net - no_model,
        "avoided_rate": _div0(tp * p.retention_rate, tp + fn),
        "campaign_roi": _div0(tp * p.clv * p.retention_rate, (tp + fp) * p.contact_cost),
        "cost_per_retained": F.try_divide((tp + fp) * p.contact_cost, tp * p.retention_rate),
    })
    if cac is not None:
        out = out.withColumns({"cac_share": F.col("cost_per_retained") / cac,
                               "cac_ok": F.col("cost_per_retained") / cac < 0.30})
    return out


def top_lift(df: DataFrame, frac: float = 0.10, keys=("model",), score: str = "score",
             label: str = "label", id_col: str = "id") -> DataFrame:
    """Precision among the top ceil(n*frac) rows by score (ties broken by
    smaller id) over the base rate.  Exact, with no global sort: distinct
    scores give prefix counts, and only the one boundary score's rows are
    ranked by id (bucketed too, so a huge tie group is still split)."""
    keys = list(keys)
    y = F.col(label).cast("bigint")
    c = cumulative(df, keys, score, {"cnt": F.lit(1).cast("bigint"), "pos": y}, descending=True)
    c = c.withColumn("k", F.ceil(F.col("all_cnt") * frac).cast("bigint"))
    at_edge = (F.col("prev_cnt") < F.col("k")) & (F.col("cum_cnt") > F.col("k"))
    top = c.groupBy(*keys).agg(
        F.first("all_cnt").alias("n"), F.first("all_pos").alias("P"), F.first("k").alias("k"),
        F.sum(F.when(F.col("cum_cnt") <= F.col("k"), F.col("pos")).otherwise(0)).alias("pos_full"),
        F.max(F.when(at_edge, F.struct(F.col(score).alias("s"), (F.col("k") - F.col("prev_cnt")).alias("r")))).alias("_edge"))
    edge = top.where("_edge is not null").select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_edge.s").alias("_s"), F.col("_edge.r").alias("_r"))
    on = F.col(score) == F.col("_s")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    rc = cumulative(df.join(edge, on).select(*keys, id_col, label, "_r"), keys, id_col,
                    {"one": F.lit(1).cast("bigint")}, distinct=False)
    part = rc.where(F.col("cum_one") <= F.col("_r")).groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.sum(F.col(label)).alias("pos_part"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    out = top.join(part, same, "left")
    top_pos = F.col("pos_full") + F.coalesce(F.col("pos_part"), F.lit(0))
    base = F.col("P") / F.col("n")
    return out.select(*keys, "n", "k", top_pos.cast("bigint").alias("top_positives"),
                      (top_pos / F.col("k")).alias("top_precision"), base.alias("base_rate"),
                      ((top_pos / F.col("k")) / base).alias("lift"))


# ---------------------------------------------------------------- B11-B14
def scenario_grid(df: DataFrame, recalls: Sequence[float] = (0.5, 0.7, 0.8, 0.9),
                  conversions: Sequence[float] = (0.4, 0.5), discount_cost: float = 73.52,
                  label: str = "churn_value") -> DataFrame:
    """Recall x conversion -> detected, retained, gross, cost, net, ROI,
    from the churner count and mean residual of the table."""
    base = df.where(F.col(label) == 1).agg(F.count(F.lit(1)).alias("churners"),
                                            F.avg(residual()).alias("mean_residual"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(float(r), float(c)) for r in recalls for c in conversions],
                                 "recall double, conversion double")
    g = _join1(grid, base)   # base is one row
    det = F.col("churners") * F.col("recall")
    ret = det * F.col("conversion")
    gross = ret * F.col("mean_residual")
    cost = ret * discount_cost
    return g.select("recall", "conversion", det.alias("detected"), ret.alias("retained"),
                    gross.alias("gross"), cost.alias("cost"), (gross - cost).alias("net"),
                    F.try_divide(gross - cost, cost).alias("roi"))


def strategy_compare(scored: DataFrame, recall_targets: Sequence[float] = (0.70, 0.90), conversion: float = 0.5,
                     offer_cost: float = 73.52, keys=("model",), grid: Grid | None = None) -> DataFrame:
    """No action, everyone contacted, and the model at each recall target.

    No action loses all that the churners are worth.  Contacting everyone keeps
    every churner and spends an offer on each customer who would have stayed.
    The model contacts the churners found at the highest grid threshold whose
    recall reaches the target; ``conversion`` of them accept and cost an offer.
    ``alerts`` counts all rows at or above the threshold.  ``value_lost`` is the
    worth of the churners not retained; a churner is worth the mean ``fn_cost``
    of the positives.  A target that no threshold reaches has null figures."""
    keys = list(keys)
    s = sweep(scored, grid or Grid.percent(1, 99), keys, extra={"v": F.col("fn_cost")})
    recall = _div0(F.col("tp"), F.col("tp") + F.col("fn"))
    pick = s.groupBy(*keys).agg(*[F.max_by(F.struct("tp", "fp"), F.when(recall >= t, F.col("threshold"))).alias(f"_m{i}")
                                  for i, t in enumerate(recall_targets)])
    base = scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("P"),
        F.sum(F.when(F.col("label") == 1, F.col("fn_cost")).otherwise(0.0)).alias("V"))
    j = base.join(pick, keys, "left")
    mean_v = F.col("V") / F.col("P")

    def row(name, alerts, contacted, retained, cost, net=None):
        saved = retained * mean_v
        return F.struct(F.lit(name).alias("strategy"), alerts.cast("double").alias("alerts"), contacted.cast("double").alias("contacted"),
                        retained.cast("double").alias("retained"), saved.alias("value_saved"), cost.cast("double").alias("offer_cost"),
                        (saved - cost if net is None else net).alias("net"), ((F.col("P") - retained) * mean_v).alias("value_lost"))

    zero, stay = F.lit(0.0), F.col("n") - F.col("P")
    rows = [row("no_action", zero, zero, zero, zero, -F.col("V")), row("contact_all", F.col("n"), stay, F.col("P"), stay * offer_cost)]
    for i, t in enumerate(recall_targets):
        tp = F.col(f"_m{i}.tp")
        rows.append(row(f"model_recall_{t:g}", tp + F.col(f"_m{i}.fp"), tp, tp * conversion, tp * conversion * offer_cost))
    return j.select(*keys, F.explode(F.array(*rows)).alias("r")).select(*keys, "r.*")


def break_even(df: DataFrame, fixed: float = 500.0, action_costs: Sequence[float] = (30.0, 50.0, 75.0),
               label: str = "churn_value") -> DataFrame:
    """Retained customers per month so that retained x (ticket - cost)
    exceeds the fixed cost: floor(fixed / margin) + 1; null when the margin is
    not positive (not viable)."""
    t = df.agg(F.avg(F.when(F.col(label) == 0, F.col("monthly_charges"))).alias("active_ticket"))
    costs = df.sparkSession.createDataFrame([(float(c),) for c in action_costs], "action_cost double")
    j = _join1(costs, t)
    margin = F.col("active_ticket") - F.col("action_cost")
    return j.select("action_cost", "active_ticket", margin.alias("margin"),
                    F.when(margin > 0, (F.floor(F.lit(fixed) / margin) + 1).cast("bigint")).alias("break_even"),
                    (margin > 0).alias("viable"))


# Retention actions (name, months, share of the monthly ticket, fixed cost)
ACTIONS = [("discount_10pct_12m", 12, 0.10, 0.0), ("gift_service_3m", 3, 0.15, 0.0),
           ("plan_upgrade_6m", 6, 0.20, 0.0), ("better_service", 0, 0.0, 15.0)]


def action_roi(df: DataFrame, actions=ACTIONS, months_saved: int = 12) -> DataFrame:
    """ROI per retention action: saved = mean ticket x 12,
    cost = ticket x months x share + fixed, ROI = (saved - cost) / cost."""
    t = df.agg(F.avg("monthly_charges").alias("ticket"))
    a = df.sparkSession.createDataFrame(actions, "action string, months int, share double, fixed double")
    j = _join1(a, t)
    cost = F.col("ticket") * F.col("months") * F.col("share") + F.col("fixed")
    saved = F.col("ticket") * months_saved
    return j.select("action", cost.alias("cost"), saved.alias("saved"), ((saved - cost) / cost).alias("roi"))


# ---------------------------------------------------------------- B15-B19
def financial_state(df: DataFrame, label: str = "churn_value") -> DataFrame:
    """Clients, active, lost, MRR (active), MRR lost, revenue to date,
    future revenue destroyed (B2 over churners), CLTV lost."""
    ch = F.col(label) == 1
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("clients"),
                  F.count_if(~ch).cast("bigint").alias("active"), F.count_if(ch).cast("bigint").alias("lost"),
                  F.sum(F.when(~ch, F.col("monthly_charges")).otherwise(0.0)).alias("mrr"),
                  F.sum(F.when(ch, F.col("monthly_charges")).otherwise(0.0)).alias("mrr_lost"),
                  F.sum("total_charges").alias("revenue"),
                  F.sum(F.when(ch, future_revenue()).otherwise(0.0)).alias("future_revenue_destroyed"),
                  F.sum(F.when(ch, F.col("cltv")).otherwise(0)).cast("bigint").alias("cltv_lost"))


def monthly_churn(panel: DataFrame) -> DataFrame:
    """Monthly active customers, churners, rate and churned MRR (panel input)."""
    return panel.groupBy("month").agg(
        F.count(F.lit(1)).cast("bigint").alias("active"), F.sum("churned").cast("bigint").alias("churned"),
        (F.sum("churned") / F.count(F.lit(1))).alias("churn_rate"),
        F.sum(F.when(F.col("churned") == 1, F.col("monthly_charges")).otherwise(0.0)).alias("mrr_churned"))


def mrr_saved(panel: DataFrame, segment: str = "contract", drop: float = 0.15) -> DataFrame:
    """Retained MRR per month and segment; alert when it fell more than
    ``drop`` in each of two consecutive months.  The window is per segment
    over its months (a few hundred rows), never over raw rows."""
    m = panel.groupBy(segment, "month").agg(
        F.sum(F.when(F.col("churned") == 0, F.col("monthly_charges")).otherwise(0.0)).alias("mrr_saved"))
    w = Window.partitionBy(segment).orderBy("month")
    l1, l2 = F.lag("mrr_saved", 1).over(w), F.lag("mrr_saved", 2).over(w)
    fell = lambda a, b: F.coalesce(a < b * (1 - drop), F.lit(False))
    return m.withColumn("alert", fell(F.col("mrr_saved"), l1) & fell(l1, l2))


def run_rate(panel: DataFrame, months: int = 12) -> DataFrame:
    """Churn run-rate over the last ``months`` months of the panel:
    churners per month, share of the active base, churned MRR per month."""
    mc = monthly_churn(panel)
    last = mc.agg(F.max("month").alias("_last"))
    r = _join1(mc, last).where(F.col("month") > F.add_months(F.col("_last"), -months))
    return r.agg(F.avg("churned").alias("churners_per_month"),
                 (F.sum("churned") / F.sum("active")).alias("monthly_rate"),
                 F.avg("mrr_churned").alias("mrr_at_risk_per_month"))


def churn_change(panel: DataFrame, cut: str, target_pp: float = -5.0) -> DataFrame:
    """Mean monthly churn rate before and after ``cut`` and the change in
    percentage points (goal: at most ``target_pp``)."""
    mc = monthly_churn(panel)
    after = F.col("month") >= F.to_date(F.lit(cut))
    r = mc.agg(F.avg(F.when(~after, F.col("churn_rate"))).alias("rate_before"),
               F.avg(F.when(after, F.col("churn_rate"))).alias("rate_after"))
    ch = (F.col("rate_after") - F.col("rate_before")) * 100
    return r.withColumns({"change_pp": ch, "target_met": ch <= target_pp})


def policy_metrics(scored: DataFrame, policies: Sequence[tuple[str, float]],
                   keys=("model",)) -> DataFrame:
    """Confusion and rates per campaign policy ``(name, threshold)``.

    All policies are counted in one aggregate (conditional counts per policy,
    then ``stack``), so the scored table is read once and never multiplied
    by the number of policies."""
    keys = list(keys)
    y = F.col("label") == 1
    aggs = []
    for i, (_, t) in enumerate(policies):
        pred = F.col("score") >= F.lit(float(t))
        aggs += [F.count_if(pred & y).cast("bigint").alias(f"tp{i}"),
                 F.count_if(pred & ~y).cast("bigint").alias(f"fp{i}"),
                 F.count_if(~pred & ~y).cast("bigint").alias(f"tn{i}"),
                 F.count_if(~pred & y).cast("bigint").alias(f"fn{i}")]
    wide = scored.groupBy(*keys).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(n).alias("policy"), F.lit(float(t)).alias("threshold"),
                              *[F.col(f"{c}{i}").alias(c) for c in ("tp", "fp", "tn", "fn")])
                     for i, (n, t) in enumerate(policies)])
    c = wide.select(*keys, F.explode(rows).alias("p")).select(*keys, "p.*")
    return c.withColumns({"precision": _div0(F.col("tp"), F.col("tp") + F.col("fp")),
                          "recall": _div0(F.col("tp"), F.col("tp") + F.col("fn")),
                          "contacted": F.col("tp") + F.col("fp")})
