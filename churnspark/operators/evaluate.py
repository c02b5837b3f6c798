"""Evaluation aggregates (A1-A28) over ``(model, id, label, score)``.

Shapes: every operator is either one ``groupBy(model)`` aggregate over the
scored table (confusion counts, log loss), or a pass through one of the
prefix patterns (``cumulative`` for curves/AUC, ``sweep`` for thresholds);
what follows is arithmetic on at most a few hundred rows per model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark import schemas as S
from churnspark.operators.prefix import Grid, cumulative, sweep

KEYS = ("model",)


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (the zero_division=0 / max(d,1) convention)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _thr(df: DataFrame, threshold, keys) -> tuple[DataFrame, Column]:
    """Attach a threshold: a float, or a small (keys..., threshold) table."""
    if isinstance(threshold, DataFrame):
        # one row per model: a size-bounded table, broadcast
        return df.join(F.broadcast(threshold), list(keys)), F.col("threshold")
    return df.withColumn("threshold", F.lit(float(threshold))), F.col("threshold")


# ---------------------------------------------------------------- A1-A3
def confusion(df: DataFrame, threshold=S.DEFAULT_THRESHOLD, keys=KEYS,
              score: str = "score", label: str = "label") -> DataFrame:
    """A1: TP/FP/TN/FN at ``score >= threshold`` in one aggregate."""
    keys = list(keys)
    d, t = _thr(df, threshold, keys)
    pred = F.col(score) >= t
    y = F.col(label) == 1
    return d.groupBy(*keys, "threshold").agg(
        F.count_if(pred & y).cast("bigint").alias("tp"),
        F.count_if(pred & ~y).cast("bigint").alias("fp"),
        F.count_if(~pred & ~y).cast("bigint").alias("tn"),
        F.count_if(~pred & y).cast("bigint").alias("fn"))


def rate_cols(tp="tp", fp="fp", tn="tn", fn="fn") -> dict[str, Column]:
    """A2 + A3 as expressions over confusion columns (zero denominators -> 0)."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in (tp, fp, tn, fn))
    prec = _div0(tp, tp + fp)
    rec = _div0(tp, tp + fn)
    den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return {
        "precision": prec,
        "recall": rec,
        "f1": _div0(2 * prec * rec, prec + rec),
        "specificity": _div0(tn, tn + fp),
        "accuracy": _div0(tp + tn, tp + tn + fp + fn),
        "npv": _div0(tn, tn + fn),
        "mcc": _div0(tp * tn - fp * fn, den),
    }


def rates(conf: DataFrame) -> DataFrame:
    """A2/A3: precision, recall, F1, specificity, accuracy, NPV, MCC."""
    return conf.withColumns(rate_cols())


# ---------------------------------------------------------------- curves, A4-A9
def score_points(df: DataFrame, keys=KEYS, score: str = "score", label: str = "label") -> DataFrame:
    """Distinct scores per key, descending, with TP/FP counts at threshold
    = that score (``tp`` = positives with score >= s) and class totals."""
    y = F.col(label).cast("bigint")
    c = cumulative(df, list(keys), score, {"pos": y, "neg": 1 - y}, descending=True)
    return c.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp", "all_pos": "P", "all_neg": "N"})


def _auc() -> Column:
    """ROC-AUC as an aggregate over score points.  The numerator
    sum(pos * (2*neg_below + neg)) is an exact integer; it reaches 2 * P * N, so
    it is summed as a 38-digit decimal."""
    below = (2 * (F.col("N") - F.col("fp")) + F.col("neg")).cast("decimal(19,0)")
    num = F.sum(F.col("pos").cast("decimal(18,0)") * below)
    return F.try_divide(num.cast("double"), 2.0 * F.first("P").cast("double") * F.first("N").cast("double"))


def _ap() -> Column:
    """Average precision as an aggregate over score points."""
    term = F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return F.try_divide(F.sum(term), F.first("P").cast("double"))


def roc_auc(df: DataFrame, keys=KEYS, **kw) -> DataFrame:
    """A4: ROC-AUC with ties (rank-sum on distinct scores; null for one class)."""
    return score_points(df, keys, **kw).groupBy(*keys).agg(_auc().alias("roc_auc"))


def average_precision(df: DataFrame, keys=KEYS, **kw) -> DataFrame:
    """A5: sum over distinct thresholds of (recall step) x precision."""
    return score_points(df, keys, **kw).groupBy(*keys).agg(_ap().alias("average_precision"))


def point_metrics(df: DataFrame, threshold=S.DEFAULT_THRESHOLD, keys=KEYS, **kw) -> DataFrame:
    """A1, A4 and A5 from one pass over the scores: confusion at the threshold,
    ``roc_auc`` and ``average_precision``.  A key whose scores are all null or NaN
    has no points and no row."""
    p, t = _thr(score_points(df, keys, **kw), threshold, list(keys))
    hit = F.col(kw.get("score", "score")) >= t
    g = p.groupBy(*keys, "threshold").agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("_tp"), F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("_fp"),
        F.first("P").alias("_P"), F.first("N").alias("_N"), _auc().alias("roc_auc"), _ap().alias("average_precision"))
    big = lambda c: c.cast("bigint")
    return g.select(*keys, "threshold", big(F.col("_tp")).alias("tp"), big(F.col("_fp")).alias("fp"),
                    big(F.col("_N") - F.col("_fp")).alias("tn"), big(F.col("_P") - F.col("_tp")).alias("fn"),
                    "roc_auc", "average_precision")


def roc_curve(df: DataFrame, keys=KEYS, **kw) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score."""
    p = score_points(df, keys, **kw)
    return p.select(*keys, F.col("score").alias("threshold"),
                    _div0(F.col("fp"), F.col("N")).alias("fpr"),
                    _div0(F.col("tp"), F.col("P")).alias("tpr"))


def pr_curve(df: DataFrame, keys=KEYS, **kw) -> DataFrame:
    """(threshold, precision, recall) at every distinct score + base rate."""
    p = score_points(df, keys, **kw)
    return p.select(*keys, F.col("score").alias("threshold"),
                    (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                    _div0(F.col("tp"), F.col("P")).alias("recall"),
                    (F.col("P") / (F.col("P") + F.col("N"))).alias("base_rate"))


def best_f1_threshold(df: DataFrame, keys=KEYS, **kw) -> DataFrame:
    """Threshold of maximum F1 over the real score points, lowest on ties."""
    c = pr_curve(df, keys, **kw).withColumn(
        "f1", _div0(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    return c.groupBy(*keys).agg(
        F.max_by(F.struct("threshold", "f1"),
                 F.struct(F.col("f1"), -F.col("threshold"))).alias("b")).select(
        *keys, F.col("b.threshold").alias("threshold"), F.col("b.f1").alias("f1"))


def f1_sweep(df: DataFrame, grid: Grid | None = None, keys=KEYS) -> DataFrame:
    """Precision / recall / F1 at each grid threshold (default 0.05..0.94)."""
    grid = grid or Grid.percent(5, 94)
    s = sweep(df, grid, keys)
    r = rate_cols()
    return s.select(*keys, "threshold", r["precision"].alias("precision"),
                    r["recall"].alias("recall"), r["f1"].alias("f1"))


def class_report(df: DataFrame, threshold=S.DEFAULT_THRESHOLD, keys=KEYS) -> DataFrame:
    """A10: per-class precision/recall/F1/support + macro and weighted rows."""
    keys = list(keys)
    conf = confusion(df, threshold, keys)
    per = conf.select(*keys, F.explode(F.array(
        F.struct(F.lit("0").alias("class"), F.col("tn").alias("tp_c"), F.col("fn").alias("fp_c"),
                 F.col("fp").alias("fn_c")),
        F.struct(F.lit("1").alias("class"), F.col("tp").alias("tp_c"), F.col("fp").alias("fp_c"),
                 F.col("fn").alias("fn_c")))).alias("c")).select(*keys, "c.*")
    per = per.select(*keys, "class",
                     _div0(F.col("tp_c"), F.col("tp_c") + F.col("fp_c")).alias("precision"),
                     _div0(F.col("tp_c"), F.col("tp_c") + F.col("fn_c")).alias("recall"),
                     (F.col("tp_c") + F.col("fn_c")).cast("bigint").alias("support"))
    per = per.withColumn("f1", _div0(2 * F.col("precision") * F.col("recall"),
                                     F.col("precision") + F.col("recall")))
    macro = per.groupBy(*keys).agg(
        F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"), F.sum("support").cast("bigint").alias("support"),
        F.avg("f1").alias("f1"))
    wsum = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    weighted = per.groupBy(*keys).agg(
        F.lit("weighted avg").alias("class"), wsum("precision").alias("precision"),
        wsum("recall").alias("recall"), F.sum("support").cast("bigint").alias("support"),
        wsum("f1").alias("f1"))
    return per.unionByName(macro).unionByName(weighted)


def confusion_grid(df: DataFrame, thresholds: DataFrame, keys=KEYS) -> DataFrame:
    """Each model at its own threshold (``thresholds``: model, threshold)."""
    return rates(confusion(df, thresholds, keys))


# ---------------------------------------------------------------- money, A12-A20
def value_expr(costs: S.CostModel = S.DEFAULT_COSTS, tp="tp", tn="tn", fn="fn", fp="fp") -> Column:
    return (F.col(tp) * costs.v_tp + F.col(tn) * costs.v_tn +
            F.col(fn) * costs.v_fn + F.col(fp) * costs.v_fp)


def business_value(df: DataFrame, threshold=S.DEFAULT_THRESHOLD,
                   costs: S.CostModel = S.DEFAULT_COSTS, keys=KEYS) -> DataFrame:
    """TP*v + TN*c - FN*v - FP*c at a threshold."""
    return confusion(df, threshold, keys).withColumn("business_value", value_expr(costs))


def threshold_table(df: DataFrame, grid: Grid | None = None,
                    costs: S.CostModel = S.DEFAULT_COSTS, keys=KEYS) -> DataFrame:
    """Business value and recall at each grid threshold (histogram sweep)."""
    grid = grid or Grid.percent(*S.THRESHOLD_GRID)
    s = sweep(df, grid, keys)
    return s.withColumns({"business_value": value_expr(costs),
                          "recall": _div0(F.col("tp"), F.col("tp") + F.col("fn"))})


def best_threshold(df: DataFrame, slo: float = S.SLO_RECALL_MIN,
                   costs: S.CostModel = S.DEFAULT_COSTS, grid: Grid | None = None,
                   keys=KEYS) -> DataFrame:
    """Max value among thresholds with recall >= slo (lowest t on ties);
    if none qualifies, max value overall (``slo_met`` = false)."""
    keys = list(keys)
    t = threshold_table(df, grid, costs, keys).withColumn("ok", F.col("recall") >= slo)
    rank = F.struct(F.col("ok"), F.col("business_value"), -F.col("threshold"))
    return t.groupBy(*keys).agg(
        F.max_by(F.struct("threshold", "business_value", "ok"), rank).alias("b")).select(
        *keys, F.col("b.threshold").alias("threshold"),
        F.col("b.business_value").alias("business_value"), F.col("b.ok").alias("slo_met"))


def full_metrics(df: DataFrame, threshold, costs: S.CostModel = S.DEFAULT_COSTS,
                 slo: float = S.SLO_RECALL_MIN, keys=KEYS) -> DataFrame:
    """roc_auc, pr_auc, recall, precision, f1, confusion, value, slo_ok."""
    r = rate_cols()
    return point_metrics(df, threshold, keys).select(
        *keys, "threshold", "tp", "tn", "fp", "fn", r["recall"].alias("recall"), r["precision"].alias("precision"),
        r["f1"].alias("f1"), value_expr(costs).alias("business_value"), (r["recall"] >= slo).alias("slo_ok"), "roc_auc",
        F.col("average_precision").alias("pr_auc"))


def holdout_metrics(df: DataFrame, threshold=S.DEFAULT_THRESHOLD, keys=KEYS) -> DataFrame:
    """Hold-out record, everything rounded to 2 decimals."""
    keys = list(keys)
    r = rate_cols()
    m = point_metrics(df, threshold, keys).select(
        *keys, "tp", "tn", "fp", "fn", r["f1"].alias("test_f1"), r["recall"].alias("test_recall"),
        r["precision"].alias("test_precision"), r["accuracy"].alias("test_accuracy"), F.col("roc_auc").alias("test_roc_auc"),
        F.col("average_precision").alias("test_average_precision"))
    out = [*keys] + [F.round(F.col(c).cast("double"), 2).alias(c) for c in
                     ("test_roc_auc", "test_average_precision", "test_f1", "test_recall",
                      "test_precision", "test_accuracy")]
    out += [F.round(F.col(c).cast("double"), 2).alias(f"test_{c}") for c in ("tp", "tn", "fp", "fn")]
    return m.select(*out)


def campaign_cols(clv: float = 2845.0, retention: float = 73.52, fn_cost: float | None = None,
                  fp_cost: float | None = None) -> dict[str, Column]:
    """A16 expressions: saved=(CLV-ret)*TP, FP/FN cost, total, net."""
    fn_cost = clv if fn_cost is None else fn_cost
    fp_cost = retention if fp_cost is None else fp_cost
    saved = (clv - retention) * F.col("tp")
    cfp = fp_cost * F.col("fp")
    cfn = fn_cost * F.col("fn")
    return {"revenue_saved": saved, "cost_fp": cfp, "cost_fn": cfn,
            "cost_total": cfp + cfn, "net_value": saved - (cfp + cfn)}


def campaign_value(conf: DataFrame, **costs) -> DataFrame:
    """Campaign money from confusion counts (rounded to cents)."""
    return conf.withColumns({k: F.round(v, 2) for k, v in campaign_cols(**costs).items()})


def net_value_curve(df: DataFrame, grid: Grid | None = None, keys=KEYS, **costs) -> DataFrame:
    """Net value at every threshold of linspace(0.01, 0.99, 200)."""
    grid = grid or Grid.linspace(0.01, 0.99, 200)
    s = sweep(df, grid, keys)
    return s.withColumn("net_value", F.round(campaign_cols(**costs)["net_value"], 2))


def best_net_threshold(df: DataFrame, grid: Grid | None = None, keys=KEYS, **costs) -> DataFrame:
    """A17 optimum: highest net value, lowest threshold on ties."""
    keys = list(keys)
    c = net_value_curve(df, grid, keys, **costs)
    return c.groupBy(*keys).agg(F.max_by(F.struct("threshold", "net_value"),
                                         F.struct(F.col("net_value"), -F.col("threshold"))).alias("b")
                                ).select(*keys, "b.threshold", "b.net_value")


def threshold_gain(df: DataFrame, base: float = 0.5, keys=KEYS, **costs) -> DataFrame:
    """Net value at the tuned threshold minus net value at ``base``."""
    keys = list(keys)
    best = best_net_threshold(df, None, keys, **costs)
    at_base = campaign_value(confusion(df, base, keys), **costs).select(
        *keys, F.col("net_value").alias("net_value_base"))
    return best.join(at_base, keys).withColumn(
        "gain", F.round(F.col("net_value") - F.col("net_value_base"), 2))


def cost_annotate(conf: DataFrame, cfg: S.CostConfig = S.CostConfig()) -> DataFrame:
    """cost_total = FP*fp_cost + FN*fn_cost; avoided = TP*(clv - retention)."""
    return conf.withColumns({
        "cost_total": F.col("fp") * cfg.fp_cost + F.col("fn") * cfg.fn_cost,
        "churn_avoided": F.col("tp") * (cfg.clv - cfg.retention)})


def tradeoff(conf: DataFrame, cfg: S.CostConfig = S.CostConfig(), keys=KEYS) -> DataFrame:
    """net = avoided - total; ROI = net / total (inf when total is 0)."""
    a = cost_annotate(conf, cfg)
    net = F.col("churn_avoided") - F.col("cost_total")
    return a.select(
        *keys, "fp", "fn",
        F.round(F.col("fp") * cfg.fp_cost, 2).alias("cost_fp"),
        F.round(F.col("fn") * cfg.fn_cost, 2).alias("cost_fn"),
        F.round("cost_total", 2).alias("cost_total"),
        F.round("churn_avoided", 2).alias("churn_avoided"),
        F.round(net, 2).alias("net_value"),
        F.when(F.col("cost_total") > 0, F.round(net / F.col("cost_total"), 2))
         .otherwise(F.lit(float("inf"))).alias("roi"))


# ---------------------------------------------------------------- choice, A21-A27
def compare(metrics: DataFrame, by: str = "roc_auc") -> DataFrame:
    """Comparison table with its rank by ``by`` (descending)."""
    # input has one row per model (a handful), so a global window is free here
    w = Window.orderBy(F.col(by).desc(), F.col("model"))
    return metrics.withColumn("rank", F.row_number().over(w))


def best_model(metrics: DataFrame, by: str = "roc_auc") -> DataFrame:
    """Name of the best model by ``by`` (honoured, unlike the original)."""
    return metrics.agg(F.min_by("model", F.struct(-F.col(by), F.col("model"))).alias("best_model"))


def pick_winner(metrics: DataFrame) -> DataFrame:
    """Highest business value among SLO-ok models, else highest value."""
    return metrics.agg(F.max_by(F.struct("model", "business_value", "slo_ok"),
                                F.struct(F.col("slo_ok"), F.col("business_value"))).alias("w")
                       ).select("w.*")


def model_delta(metrics: DataFrame, a: str, b: str, cols: Sequence[str]) -> DataFrame:
    """Metric differences a - b (long form: metric, a, b, delta)."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    lf = metrics.where(F.col("model").isin(a, b)).selectExpr(
        "model", f"stack({len(cols)}, {pairs}) AS (metric, value)")
    p = lf.groupBy("metric").agg(F.max(F.when(F.col("model") == a, F.col("value"))).alias("value_a"),
                                 F.max(F.when(F.col("model") == b, F.col("value"))).alias("value_b"))
    return p.withColumn("delta", F.col("value_a") - F.col("value_b"))


def promote(candidates: DataFrame, registry: DataFrame | None) -> DataFrame:
    """Promote iff SLO ok and value > current champion (or no champion).

    ``candidates``: (model, business_value, slo_ok); ``registry``: rows
    (model, version, business_value, stage) with stage 'champion'."""
    champ = (registry.where(F.col("stage") == "champion")
             .agg(F.max("business_value").alias("champion_value"))
             if registry is not None else
             candidates.sparkSession.range(1).select(F.lit(None).cast("double").alias("champion_value")))
    # the champion summary is one row: broadcast
    j = (candidates.withColumn("_j", F.lit(1))
         .join(F.broadcast(champ.withColumn("_j", F.lit(1))), "_j").drop("_j"))
    promote_ = F.col("slo_ok") & (F.col("champion_value").isNull() |
                                  (F.col("business_value") > F.col("champion_value")))
    reason = (F.when(~F.col("slo_ok"), F.lit("recall below SLO"))
              .when(F.col("champion_value").isNull(), F.lit("no champion"))
              .when(promote_, F.lit("beats champion"))
              .otherwise(F.lit("does not beat champion")))
    return j.withColumns({"promote": promote_, "reason": reason})


# Release gates (metric, op, bound)
RELEASE_RULES = [("recall", ">=", 0.70), ("roc_auc", ">=", 0.80),
                 ("business_value", ">=", 950000.0)]
AUTO_REJECT = [("roc_auc", "<", 0.80), ("recall", "<", 0.50)]


#: A new model must better the one before it by so much in either metric.
IMPROVEMENT = [("roc_auc", 0.005), ("f1", 0.010)]


def _rule(metric: str, op: str, bound: float) -> Column:
    c = F.col(metric)
    return {">=": c >= bound, ">": c > bound, "<=": c <= bound, "<": c < bound}[op]


def release_decision(metrics: DataFrame, previous: DataFrame | None = None, rules=RELEASE_RULES, reject=AUTO_REJECT,
                     improvement=IMPROVEMENT) -> DataFrame:
    """A25, the whole gate: ``failed_rules``, ``reject_rules`` (the automatic
    rejections that apply), ``improves`` and ``decision``.

    ``improves`` is true if a metric gains as much as ``improvement`` asks over
    ``previous`` (one row: the model in use), and null if there is none.  A model
    is rejected if an automatic rejection applies or an AUC or recall is
    missing, promoted if no rule fails and it does not fail to improve, and held
    otherwise."""
    hits = [F.when(F.coalesce(_rule(*r), F.lit(True)), F.lit("{} {} {}".format(*r))) for r in reject]
    m = release_gate(metrics, rules).withColumn("reject_rules", F.filter(F.array(*hits), lambda x: x.isNotNull()))
    if previous is None:
        better = F.lit(None).cast("boolean")
    else:
        old = previous.select(*[F.col(c).alias(f"_old_{c}") for c, _ in improvement]).limit(1)  # the one row
        m = m.join(F.broadcast(old), F.lit(True), "left")
        better = F.lit(False)
        for c, gain in improvement:  # in steps of 1e-9, so that 0.850 against 0.845 is a gain of 0.005
            better = better | F.coalesce(F.round(F.col(c) - F.col(f"_old_{c}"), 9) >= gain, F.lit(False))
        better = F.when(F.coalesce(*[F.col(f"_old_{c}") for c, _ in improvement]).isNotNull(), better)
    m = m.withColumn("improves", better)
    decision = (F.when(F.size("reject_rules") > 0, "reject").when(F.col("passed") & F.coalesce("improves", F.lit(True)), "promote")
                .otherwise("hold"))
    return m.withColumn("decision", decision).drop(*[f"_old_{c}" for c, _ in improvement])


def release_gate(metrics: DataFrame, rules=RELEASE_RULES) -> DataFrame:
    """List of failed rules per model."""
    fails = [F.when(~F.coalesce(_rule(m, op, bound), F.lit(False)), F.lit(f"{m} {op} {bound}")) for m, op, bound in rules]
    return metrics.withColumn("failed_rules", F.filter(F.array(*fails), lambda x: x.isNotNull())) \
                  .withColumn("passed", F.size("failed_rules") == 0)


def stack(*tables: DataFrame) -> DataFrame:
    """Union by name, missing columns null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def recalibrate(df: DataFrame, prior: float, slo: float = S.SLO_RECALL_MIN,
                costs: S.CostModel = S.DEFAULT_COSTS, grid: Grid | None = None,
                keys=KEYS) -> DataFrame:
    """Best threshold after reweighting the histogram to class prior
    ``prior`` (positives x w1, negatives x w0, each class keeps its size)."""
    keys = list(keys)
    t = threshold_table(df, grid, costs, keys)
    P = F.col("tp") + F.col("fn")
    N = F.col("tn") + F.col("fp")
    n = P + N
    w1 = F.lit(prior) * n / P
    w0 = F.lit(1 - prior) * n / N
    t = t.withColumns({"tp": F.col("tp") * w1, "fn": F.col("fn") * w1,
                       "fp": F.col("fp") * w0, "tn": F.col("tn") * w0})
    t = t.withColumn("business_value", value_expr(costs)).withColumn(
        "ok", _div0(F.col("tp"), F.col("tp") + F.col("fn")) >= slo)
    rank = F.struct(F.col("ok"), F.col("business_value"), -F.col("threshold"))
    return t.groupBy(*keys).agg(F.max_by(F.struct("threshold", "business_value"), rank).alias("b")
                                ).select(*keys, "b.threshold", "b.business_value")


def log_loss(df: DataFrame, pos_weight=1.0, keys=KEYS, score: str = "score",
             label: str = "label", eps: float = 1e-15) -> DataFrame:
    """Weighted log loss (positives x pos_weight), mean over rows.

    ``pos_weight`` is a float or a small (keys..., pos_weight) table."""
    keys = list(keys)
    if isinstance(pos_weight, DataFrame):
        df = df.join(F.broadcast(pos_weight), keys)   # one row per model
        pw = F.col("pos_weight")
    else:
        pw = F.lit(float(pos_weight))
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label)
    w = F.when(y == 1, pw).otherwise(F.lit(1.0))
    loss = -w * (y * F.log(p) + (1 - y) * F.log(1 - p))
    return df.groupBy(*keys).agg(F.avg(loss).alias("log_loss"))
