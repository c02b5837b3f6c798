"""Monitoring as batch Spark jobs (R1-R29): drift, outcome join, rolling
quality, service logs, fairness, campaign money and retraining triggers.

Streaming forms of the same computations live in ``churnspark.streaming``.
Design notes for scale:
* drift statistics run on the long form (one job for all columns); PSI bins
  come from exact reference quantiles; KS uses distributed prefix counts;
* the outcome join (R8) never pairs every prediction with every later
  event of the same customer: same-day matches come from a window inside
  (customer, day) and later days from one aggregated row per (customer, day);
* latency percentiles per period use the distributed exact quantile, so a
  very busy period is not gathered into one task;
* failure runs are islands over distributed prefix counts, not a window over
  a whole host.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark import schemas as S
from churnspark.functions.stats import ks_p
from churnspark.operators.evaluate import _div0
from churnspark.operators.prefix import cumulative, exact_quantiles, long_form
from churnspark.operators.profile import chi2_assoc, event_rate


# ---------------------------------------------------------------- R1, R2, R25
def reference_edges(ref: DataFrame, cols: Sequence[str], bins: int = 10,
                    version: str | None = None) -> DataFrame:
    """Versioned reference quantile edges (interior cut points) per column."""
    probs = [i / bins for i in range(1, bins)]
    names = [f"e{i}" for i in range(1, bins)]
    lf = long_form(ref, cols).where(F.col("value").isNotNull())
    q = exact_quantiles(lf, ["column"], "value", probs, names)
    out = q.select("column", F.array(*names).alias("edges"))
    return out.withColumn("version", F.lit(version)) if version is not None else out


def psi(ref: DataFrame, cur: DataFrame, cols: Sequence[str], bins: int = 10,
        eps: float = 1e-4, edges: DataFrame | dict | None = None) -> DataFrame:
    """Population stability index per column against reference deciles.

    The reference edges are a small fitted artifact (#columns x (bins-1)
    values, R25): they are computed once and enter the plan as a literal
    map, so the current data is binned in a single pass without a join.
    Bin b holds values in (e_b, e_{b+1}] (first bin open below, last open
    above); empty-bin shares are floored at ``eps``."""
    if edges is None:
        edges = reference_edges(ref, cols, bins)
    if isinstance(edges, DataFrame):
        edges = {r["column"]: [float(x) for x in r["edges"]] for r in edges.select("column", "edges").collect()}
    emap = F.create_map(*[x for c in cols for x in (F.lit(c), F.array(*[F.lit(v) for v in edges[c]]))])

    def counts(df, name):
        lf = long_form(df, cols).where(F.col("value").isNotNull())
        b = F.size(F.filter(F.element_at(emap, F.col("column")), lambda x: x < F.col("value")))
        return lf.groupBy("column", b.alias("bin")).agg(F.count(F.lit(1)).alias(name))

    spark = ref.sparkSession
    allbins = spark.createDataFrame([(c, b) for c in cols for b in range(bins)], "column string, bin int")
    j = (allbins.join(counts(ref, "n_ref"), ["column", "bin"], "left")
                .join(counts(cur, "n_cur"), ["column", "bin"], "left")
                .fillna(0, ["n_ref", "n_cur"]))
    w = Window.partitionBy("column")          # <= bins rows per column
    r = F.greatest(F.col("n_ref") / F.sum("n_ref").over(w), F.lit(eps))
    c = F.greatest(F.col("n_cur") / F.sum("n_cur").over(w), F.lit(eps))
    t = j.withColumn("term", (c - r) * F.log(c / r))
    return t.groupBy("column").agg(F.sum("term").alias("psi")).withColumn("band", psi_band(F.col("psi")))


def psi_band(c: Column) -> Column:
    """R2: < .10 none, < .20 moderate, else severe."""
    out = None
    for bound, name in S.PSI_BANDS:
        out = F.when(c < bound, F.lit(name)) if out is None else out.when(c < bound, F.lit(name))
    return out.otherwise(F.lit("severe"))


# ---------------------------------------------------------------- R3-R5, R28
def _tagged(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    return (ref.select(*cols).withColumn("_cur", F.lit(0))
            .unionByName(cur.select(*cols).withColumn("_cur", F.lit(1))))


def chi2_drift(ref: DataFrame, cur: DataFrame, cols: Sequence[str], with_p: bool = False,
               alpha: float = 0.05) -> DataFrame:
    """Chi-square of category x dataset (reference vs current)."""
    out = chi2_assoc(_tagged(ref, cur, cols), cols, label="_cur", yates=True, with_p=with_p)
    out = out.drop("effect")
    return out.withColumn("drift", F.col("p_value") < alpha) if with_p else out


def ks_drift(ref: DataFrame, cur: DataFrame, cols: Sequence[str], with_p: bool = False) -> DataFrame:
    """Two-sample KS statistic max|F_ref - F_cur| per column (prefix
    counts over the distinct values of both samples)."""
    lf = long_form(_tagged(ref, cur, cols), cols, keep=["_cur"]).where(F.col("value").isNotNull())
    c = cumulative(lf, ["column"], "value",
                   {"r": (1 - F.col("_cur")).cast("bigint"), "c": F.col("_cur").cast("bigint")})
    j = c.withColumnsRenamed({"all_r": "n_ref", "all_c": "n_cur"})
    d = F.abs(F.col("cum_r") / F.col("n_ref") - F.col("cum_c") / F.col("n_cur"))
    out = j.groupBy("column", "n_ref", "n_cur").agg(F.max(d).alias("ks"))
    if with_p:
        n_eff = F.col("n_ref") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur"))
        out = out.withColumn("p_value", ks_p(F.col("ks"), n_eff))
    return out


def missing_drift(cur: DataFrame, cols: Sequence[str], threshold: float = 0.05) -> DataFrame:
    """Missing rate per column and a flag above ``threshold``."""
    one = cur.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    lf = long_form(one, cols, keep=["_n"], value_type="bigint", value="n_missing")
    rate = F.col("n_missing") / F.col("_n")
    return lf.select("column", "n_missing", rate.alias("missing_rate"), (rate > threshold).alias("alert"))


def concept_shift(ref: DataFrame, cur: DataFrame, col: str, label: str = "churn_value") -> DataFrame:
    """Event rate per category in reference and current, and the change."""
    a = event_rate(ref, col, label).select(col, F.col("n").alias("n_ref"), F.col("event_rate").alias("rate_ref"))
    b = event_rate(cur, col, label).select(col, F.col("n").alias("n_cur"), F.col("event_rate").alias("rate_cur"))
    return a.join(b, col, "full_outer").withColumn("change", F.col("rate_cur") - F.col("rate_ref"))


# ---------------------------------------------------------------- R6, R7, R9
def positive_rate_drift(preds: DataFrame, base_rate: float, window: str = "7 days",
                        tolerance: float = 0.10, ts: str = "ts", pred: str = "prediction") -> DataFrame:
    """Positive-prediction rate per tumbling window vs a baseline rate."""
    g = preds.groupBy(F.window(ts, window).alias("w")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.avg(F.col(pred).cast("double")).alias("positive_rate"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n",
                    "positive_rate", (F.abs(F.col("positive_rate") - base_rate) > tolerance).alias("alert"))


def score_histogram(preds: DataFrame, window: str = "7 days", bins: int = 10,
                    ts: str = "ts", score: str = "score") -> DataFrame:
    """Histogram of probabilities (equal bins on [0, 1]) per window."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    g = preds.groupBy(F.window(ts, window).alias("w"), b.alias("bin")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))
    return g.select(F.col("w.start").alias("window_start"), "bin", "n")


def rolling_metrics(joined: DataFrame, length: str = "90 days", slide: str = "30 days",
                    ts: str = "ts", label: str = "outcome", pred: str = "prediction") -> DataFrame:
    """Confusion, recall, precision and positive rate per sliding window
    (each row falls in length/slide windows: a bounded expansion)."""
    y = F.col(label) == 1
    p = F.col(pred) == 1
    g = joined.groupBy(F.window(ts, length, slide).alias("w")).agg(
        F.count_if(p & y).cast("bigint").alias("tp"), F.count_if(p & ~y).cast("bigint").alias("fp"),
        F.count_if(~p & ~y).cast("bigint").alias("tn"), F.count_if(~p & y).cast("bigint").alias("fn"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "tp", "fp", "tn", "fn",
                    _div0(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                    _div0(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))


# ---------------------------------------------------------------- R8
def attach_outcome(preds: DataFrame, events: DataFrame, horizon_days: int = 30,
                   key: str = "user_id", pid: str = "pred_id", ts: str = "ts",
                   as_of: DataFrame | None = None) -> DataFrame:
    """outcome = 1 when an event of the same key happens in
    (p.ts, p.ts + horizon]; 0 otherwise.  Only predictions whose horizon has
    fully elapsed (p.ts + horizon <= max event ts) are kept.

    Exact without pairing or multiplying rows: the first event after p.ts on
    p's own day comes from a window over (key, day) of the union of both sides;
    the first one of a later day comes from a window over the key's active
    *days* (one row each, so a key has no more rows there than the calendar has
    days).  A row without a key has no events."""
    p = preds.select(pid, key, F.col(ts).alias("p_ts"))
    e = events.where(F.col(key).isNotNull()).select(key, F.col(ts).alias("e_ts"))
    day = lambda c: F.to_date(c)
    u = (p.select(pid, key, F.col("p_ts").alias("t"), F.lit(0).alias("is_e"))
          .unionByName(e.select(F.lit(None).cast(preds.schema[pid].dataType).alias(pid), key,
                                F.col("e_ts").alias("t"), F.lit(1).alias("is_e")))
          .withColumn("d", day(F.col("t"))))
    w = (Window.partitionBy(key, "d").orderBy(F.col("t"), F.col("is_e").desc())
         .rowsBetween(1, Window.unboundedFollowing))
    event = F.when(F.col("is_e") == 1, F.col("t"))
    same = (u.withColumn("_same", F.min(event).over(w)).where(F.col("is_e") == 0)
             .select(pid, key, "d", F.col("t").alias("p_ts"), "_same"))
    days = u.groupBy(key, "d").agg(F.min(event).alias("_first"))
    wd = Window.partitionBy(key).orderBy("d").rowsBetween(1, Window.unboundedFollowing)
    later = days.select(key, "d", F.min("_first").over(wd).alias("_later"))
    mx = events.agg(F.max(ts).alias("_max"))
    j = same.join(later, [key, "d"], "left").withColumn("_j", F.lit(1)).join(F.broadcast(mx.withColumn("_j", F.lit(1))), "_j")
    nxt = F.coalesce(F.col("_same"), F.col("_later"))
    limit = F.col("p_ts") + F.expr(f"INTERVAL {int(horizon_days)} DAYS")
    hit = nxt.isNotNull() & (nxt <= limit)
    return j.where(limit <= F.col("_max")).select(
        pid, key, F.col("p_ts").alias(ts), F.when(hit, 1).otherwise(0).alias("outcome"),
        F.when(hit, nxt).alias("next_event_ts"))


def latest_prediction_before(events: DataFrame, preds: DataFrame, key: str = "user_id",
                             ts: str = "ts", eid: str = "event_id", pid: str = "pred_id") -> DataFrame:
    """R8 as-of form: for each event, the latest prediction at or before it.

    Same day: a window over the union of both sides inside (key, day).
    Earlier days: the last prediction of each (key, day) is carried forward
    by a range window over *days* per key (one row per active day, not per
    event), then joined back on (key, day)."""
    p = preds.select(pid, key, F.col(ts).alias("t"))
    e = events.select(eid, key, F.col(ts).alias("t"))
    u = (p.select(pid, F.lit(None).cast(events.schema[eid].dataType).alias(eid), key, "t", F.lit(0).alias("is_e"))
          .unionByName(e.select(F.lit(None).cast(preds.schema[pid].dataType).alias(pid), eid, key, "t",
                                F.lit(1).alias("is_e"))))
    dnum = F.datediff(F.to_date(F.col("t")), F.lit("1970-01-01"))
    w = (Window.partitionBy(key, dnum).orderBy(F.col("t"), F.col("is_e"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    pstruct = F.struct(F.col("t").alias("t"), F.col(pid).alias(pid))
    same = (u.withColumn("lp", F.max_by(pstruct, F.when(F.col("is_e") == 0, F.col("t"))).over(w))
              .where(F.col("is_e") == 1).select(eid, key, F.col("t").alias(ts), "lp", dnum.alias("d")))
    daily = p.groupBy(key, dnum.alias("d")).agg(F.max_by(pstruct, F.col("t")).alias("last_p"))
    edays = same.select(key, "d").distinct().withColumn("last_p", F.lit(None).cast(daily.schema["last_p"].dataType))
    days = daily.unionByName(edays)
    wd = Window.partitionBy(key).orderBy("d").rangeBetween(Window.unboundedPreceding, -1)
    carry = (days.withColumn("prev_p", F.max_by("last_p", F.col("last_p.t")).over(wd))
                 .groupBy(key, "d").agg(F.first("prev_p", ignorenulls=True).alias("prev_p")))
    out = same.join(carry, [key, "d"], "left")
    best = F.coalesce(F.col("lp"), F.col("prev_p"))
    return out.select(eid, key, ts, best[pid].alias(pid), best["t"].alias("prediction_ts"))


# ---------------------------------------------------------------- R10-R14, R26
def request_log(events: DataFrame, error_type: str = "error", hosts: int = 4) -> DataFrame:
    """Request-log view of an event table: id, method, path, status,
    elapsed ms, host, ts (error events are failed requests, status 503)."""
    return events.select(
        F.col("event_id").cast("string").alias("request_id"), F.lit("POST").alias("method"),
        F.lit("/predict").alias("path"),
        F.when(F.col("event_type") == error_type, 503).otherwise(200).alias("status"),
        F.col("value").alias("elapsed_ms"), F.concat(F.lit("h"), (F.col("user_id") % hosts).cast("string"))
        .alias("host"), F.col("ts"))


def latency_stats(log: DataFrame, window: str = "1 day", warn_ms: float = 200.0,
                  crit_ms: float = 500.0) -> DataFrame:
    """Exact p50/p95 latency per tumbling window; critical by p95, warning by p50."""
    w = log.withColumn("window_start", F.window("ts", window).getField("start"))
    q = exact_quantiles(w, ["window_start"], "elapsed_ms", [0.5, 0.95], ["p50", "p95"])
    lvl = F.when(F.col("p95") > crit_ms, "critical").when(F.col("p50") > warn_ms, "warning").otherwise("ok")
    return q.withColumn("level", lvl)


def error_rates(log: DataFrame, window: str = "1 day", max_4xx: float = 0.05,
                max_5xx: float = 0.005) -> DataFrame:
    """4xx and 5xx shares per window with alert flags."""
    s = F.col("status")
    g = log.groupBy(F.window("ts", window).getField("start").alias("window_start")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        (F.count_if((s >= 400) & (s < 500)) / F.count(F.lit(1))).alias("rate_4xx"),
        (F.count_if(s >= 500) / F.count(F.lit(1))).alias("rate_5xx"))
    return g.withColumns({"alert_4xx": F.col("rate_4xx") > max_4xx, "alert_5xx": F.col("rate_5xx") > max_5xx})


def availability(probes: DataFrame, target: float = 0.995, period: str = "month") -> DataFrame:
    """Share of successful probes per period vs the target."""
    g = probes.groupBy(F.date_trunc(period, "ts").alias("period")).agg(
        F.avg(F.col("ok").cast("double")).alias("availability"))
    return g.withColumn("met", F.col("availability") >= target)


def failure_runs(log: DataFrame, n: int = 3, status: int = 503) -> DataFrame:
    """Runs of consecutive failed requests per host (gaps and islands).

    The island id is the number of successful requests before a row (prefix
    count per host, distributed); requests sharing a timestamp act as one
    step.  Runs of at least ``n`` failures are returned."""
    ts_type = log.schema["ts"].dataType
    x = log.select("host", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"),
                   (F.col("status") == status).cast("bigint").alias("f"))
    c = cumulative(x, ["host"], "t", {"okc": 1 - F.col("f"), "fc": F.col("f")})
    fails = c.where((F.col("okc") == 0) & (F.col("fc") > 0))
    runs = fails.groupBy("host", F.col("cum_okc").alias("island")).agg(
        F.timestamp_micros(F.min("t")).cast(ts_type).alias("run_start"),
        F.timestamp_micros(F.max("t")).cast(ts_type).alias("run_end"),
        F.sum("fc").cast("bigint").alias("n_failures"))
    return runs.where(F.col("n_failures") >= n).drop("island")


def job_slo(runs: DataFrame, deadline_hour: int = 4, max_seconds: float = 7200.0,
            success: float = 0.995) -> DataFrame:
    """Per month: share finished before the deadline hour, exact p95
    duration (< 2 h objective), success rate."""
    end = F.col("start_ts") + F.make_dt_interval(secs=F.col("duration_s"))
    r = runs.withColumns({"month": F.date_trunc("month", "start_ts"),
                          "on_time": F.hour(end) < deadline_hour})
    g = r.groupBy("month").agg(F.count(F.lit(1)).cast("bigint").alias("runs"),
                               F.avg(F.col("on_time").cast("double")).alias("on_time_rate"),
                               F.avg(F.col("ok").cast("double")).alias("success_rate"))
    q = exact_quantiles(r, ["month"], "duration_s", [0.95], ["p95_duration_s"]).drop("n")
    out = g.join(q, "month")
    return out.withColumns({"duration_ok": F.col("p95_duration_s") < max_seconds,
                            "success_ok": F.col("success_rate") >= success})


def service_slo(log: DataFrame, period: str = "month", p95_ms: float = 200.0, p99_ms: float = 500.0,
                error_rate: float = 0.001, availability: float = 0.999) -> DataFrame:
    """R26, the service's objectives: per period exact p95 and p99 latency, error
    rate (status 500 and above) and availability (share of requests not answered
    503), and whether each is met.  Rows without a time are left out."""
    x = log.where(F.col("ts").isNotNull()).withColumn("period", F.date_trunc(period, "ts"))
    q = exact_quantiles(x, ["period"], "elapsed_ms", [0.95, 0.99], ["p95_ms", "p99_ms"]).drop("n")
    g = x.groupBy("period").agg(F.count(F.lit(1)).cast("bigint").alias("requests"),
                                F.avg((F.col("status") >= 500).cast("double")).alias("error_rate"),
                                F.avg((F.col("status") != 503).cast("double")).alias("availability"))
    return g.join(q, "period", "left").withColumns({
        "p95_ok": F.col("p95_ms") < p95_ms, "p99_ok": F.col("p99_ms") < p99_ms, "error_ok": F.col("error_rate") < error_rate,
        "available_ok": F.col("availability") >= availability})


# ---------------------------------------------------------------- R15-R18, R21
# Alert rules (metric, operator, bound, values from there on are another rule's, severity, channel)
ALERT_RULES = [
    ("consecutive_503", ">=", 2.0, None, "P1", "pager+chat"),
    ("error_rate_5xx", ">", 0.005, None, "P1", "pager+chat"),
    ("recall", "<", 0.70, None, "P2", "chat+email"),
    ("roc_auc", "<", 0.80, None, "P2", "chat+email"),
    ("psi", ">", 0.20, None, "P2", "chat+email"),
    ("latency_p95_ms", ">", 500.0, None, "P2", "chat"),
    ("positive_rate_shift", ">", 0.10, None, "P3", "email"),
    ("psi", ">=", 0.10, 0.20, "P3", "weekly email"),
    ("latency_p50_ms", ">", 200.0, None, "P4", "daily log"),
]


def alerts(metrics: DataFrame, rules=ALERT_RULES) -> DataFrame:
    """Join long-form metrics (metric, value, ...) to the rule table and
    keep the ones that fire."""
    spark = metrics.sparkSession
    r = spark.createDataFrame(rules, "metric string, op string, bound double, upto double, severity string, channel string")
    j = metrics.join(F.broadcast(r), "metric")
    v, b = F.col("value"), F.col("bound")
    fire = (F.when(F.col("op") == "<", v < b).when(F.col("op") == ">", v > b)
            .when(F.col("op") == "<=", v <= b).otherwise(v >= b))
    return j.where(fire & (F.col("upto").isNull() | (v <= F.col("upto")))).drop("upto")


def streak(df: DataFrame, series: str, period: str, bad: Column, n: int = 2, unit: str = "DAY") -> DataFrame:
    """Flag periods that close a run of ``n`` bad periods in a row.

    In a row by the calendar: a missing period (``unit`` apart) ends the run."""
    w = Window.partitionBy(series).orderBy(period)
    b = F.coalesce(bad, F.lit(False)).cast("int")
    x = df.withColumn("_bad", b)
    run = x["_bad"] == 1
    for k in range(1, n):
        back = F.timestamp_add(unit, F.lit(k), F.lag(period, k).over(w))
        run = run & (F.coalesce(F.lag("_bad", k).over(w), F.lit(0)) == 1) & F.coalesce(back == F.col(period), F.lit(False))
    return x.withColumn("streak_alert", run).drop("_bad")


def retrain_decision(psi_table: DataFrame, trained_at: str, now: Column | None = None,
                     one: float = 0.20, many: float = 0.25, many_n: int = 3,
                     max_age_months: float = 6.0) -> DataFrame:
    """Retrain if any PSI > .20, or PSI > .25 on >= 3 features, or the
    model is older than 6 months."""
    now = now if now is not None else F.current_timestamp()
    g = psi_table.agg(F.max("psi").alias("max_psi"),
                      F.count_if(F.col("psi") > many).cast("bigint").alias("n_high"))
    age = F.months_between(now, F.to_timestamp(F.lit(trained_at)))
    return g.select("max_psi", "n_high", age.alias("age_months"),
                    ((F.col("max_psi") > one) | (F.col("n_high") >= many_n) | (age > max_age_months))
                    .alias("retrain"))


def enough(df: DataFrame, count_col: str = "n", minimum: int = 200) -> DataFrame:
    """Guard column: only judge metrics backed by >= minimum rows."""
    return df.withColumn("enough_sample", F.col(count_col) >= minimum)


def auc_decay(metrics: DataFrame, period: str = "period", auc: str = "roc_auc",
              max_drop: float = 0.05) -> DataFrame:
    """Relative AUC drop vs the first (baseline) period of each model."""
    w = Window.partitionBy("model").orderBy(period).rowsBetween(Window.unboundedPreceding,
                                                                Window.unboundedFollowing)
    base = F.first(F.col(auc)).over(w)
    drop = (base - F.col(auc)) / base
    return metrics.withColumns({"baseline_auc": base, "drop": drop, "alert": drop > max_drop})


# ---------------------------------------------------------------- R19, R27, R20, R29, R22
def fairness(df: DataFrame, group: str, threshold: float = 0.5, max_gap: float = 0.10) -> DataFrame:
    """Recall and FPR per group, gap (max - min) flagged above 10 pp."""
    y = F.col("label") == 1
    p = F.col("score") >= threshold
    g = df.groupBy(group).agg(
        _div0(F.count_if(p & y), F.count_if(y)).alias("recall"),
        _div0(F.count_if(p & ~y), F.count_if(~y)).alias("fpr"), F.count(F.lit(1)).cast("bigint").alias("n"))
    gaps = g.agg((F.max("recall") - F.min("recall")).alias("recall_gap"),
                 (F.max("fpr") - F.min("fpr")).alias("fpr_gap"))
    # one row of gaps, broadcast to the per-group rows
    out = g.withColumn("_j", F.lit(1)).join(F.broadcast(gaps.withColumn("_j", F.lit(1))), "_j").drop("_j")
    return out.withColumn("flag", (F.col("recall_gap") > max_gap) | (F.col("fpr_gap") > max_gap))


def amplification(df: DataFrame, group: str, threshold: float = 0.5) -> DataFrame:
    """Predicted vs actual positive rate per group, and their ratio."""
    g = df.groupBy(group).agg(
        F.avg((F.col("score") >= threshold).cast("double")).alias("predicted_rate"),
        F.avg(F.col("label").cast("double")).alias("actual_rate"))
    return g.withColumn("amplification", F.try_divide(F.col("predicted_rate"), F.col("actual_rate")))


def campaign_monitor(log: DataFrame, period: str = "week", min_conversion: float = 0.40,
                     max_cost_per_retained: float = 75.0, offer_cost: float = 50.0,
                     fp_unit: float = 73.52, fn_unit: float = 2845.0, baseline_cost: float | None = None,
                     tolerance: float = 0.15) -> DataFrame:
    """Per period: contacts, conversions, conversion rate, cost per
    retained customer, FP and FN money; rule flags.  Input: (ts, contacted,
    converted, fp, fn) flags per customer-event.  The total cost must stay
    within ``tolerance`` of ``baseline_cost`` (default: the first period's)."""
    g = log.groupBy(F.date_trunc(period, "ts").alias("period")).agg(
        F.sum("contacted").cast("bigint").alias("contacted"), F.sum("converted").cast("bigint").alias("converted"),
        (F.sum("fp") * fp_unit).alias("fp_cost"), (F.sum("fn") * fn_unit).alias("fn_cost"))
    conv = _div0(F.col("converted"), F.col("contacted"))
    cpr = F.try_divide(F.col("contacted") * offer_cost, F.col("converted"))
    total = F.col("fp_cost") + F.col("fn_cost")
    # one row a period: a small window
    base = F.lit(baseline_cost) if baseline_cost is not None else F.first(total).over(
        Window.partitionBy(F.lit(0)).orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return g.withColumns({"conversion": conv, "cost_per_retained": cpr,
                          "conversion_ok": conv >= min_conversion,
                          "cost_ok": F.coalesce(cpr <= max_cost_per_retained, F.lit(False)),
                          "cost_change": F.try_divide(total, base) - 1}).withColumn(
        "cost_within", F.coalesce(F.abs("cost_change") <= tolerance, F.lit(False)))


def conversion_by_action(df: DataFrame, action: str = "action", converted: str = "converted") -> DataFrame:
    """Conversion rate by retention action."""
    return df.groupBy(action).agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                  F.avg(F.col(converted).cast("double")).alias("conversion_rate"))


def rejection_profile(rejected: DataFrame, top: int | None = None) -> DataFrame:
    """Failed-field counts and most frequent unknown values from the
    validation errors (P17); ``top`` keeps the k most frequent per field."""
    e = rejected.select(F.explode("errors").alias("e")).select("e.field", "e.received")
    g = e.groupBy("field", "received").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    if top:
        w = Window.partitionBy("field").orderBy(F.col("n").desc(), F.col("received"))
        g = g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return g


def sessions(events: DataFrame, gap: str = "30 minutes", key: str = "user_id", ts: str = "ts") -> DataFrame:
    """Session windows of risk events per customer (batch form)."""
    g = events.groupBy(key, F.session_window(ts, gap).alias("s")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_events"))
    return g.select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n_events")
