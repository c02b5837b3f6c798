"""Registered queries: Structured Streaming jobs run over all available
input (availableNow) into the shared checkpoint folder; the written table is
returned.  All must equal the batch SQL: aggregations emit updates, of which
the last counts; sessions, joins and runs are fed in order of time."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from churnspark import schemas as S
from churnspark.plans import sql as Q
from churnspark.plans.q_monitor import ERR, EV, H, OUTCOME, outcomes, preds
from churnspark.plans.registry import query, rounded
from churnspark.sources.tables import events
from churnspark.streaming import jobs as ST


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _none_late(df):
    if df._late_rows:
        raise RuntimeError(f"the watermark dropped {df._late_rows} rows")
    return df


def load_of(ts: str, days: int = 6):
    """The number of the ``days`` that a time falls in: the loads of ``run_in_order``."""
    return F.floor(F.unix_seconds(F.col(ts)) / (days * 86400)).cast("long")


@query("stream_error_rates", Q.with_(EV, Q.round_cols(f"SELECT * FROM ({ERR})", ["rate_4xx", "rate_5xx"])))
def stream_error_rates(spark, d):
    """R12 as a watermarked streaming aggregation over the event stream."""
    s = ST.run_available(ST.error_rates_stream(ST.request_log_stream(ST.events_stream(spark, d, None))),
                         "error_rates", mode="update")
    return rounded(_ntz(ST.latest_versions(_none_late(s), ["window_start"]), "window_start"), ["rate_4xx", "rate_5xx"])


@query("stream_sessions", Q.with_(EV + """,
gp AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                                  OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS brk
       FROM events),
sn AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM gp)""",
  """SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, CAST(count(*) AS BIGINT) AS n_events
FROM sn GROUP BY user_id, sid"""))
def stream_sessions(spark, d):
    """R23 on a stream: session windows per customer, each emitted once, when the
    watermark of two hours has passed it."""
    s = ST.run_in_order(ST.with_cast_ts(events(spark, d).select("user_id", "ts")), load_of("ts"), ST.sessions_stream, "sessions", end="1 DAY")
    return _ntz(_none_late(s).where(F.col("user_id").isNotNull()), "session_start", "session_end")


@query("stream_positive_rate", Q.with_(EV, Q.round_cols("""SELECT time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS window_start,
  CAST(count(*) AS BIGINT) AS n, avg(CAST(prediction AS DOUBLE)) AS positive_rate FROM pr GROUP BY 1""", ["positive_rate"])))
def stream_positive_rate(spark, d):
    """R6 on a stream."""
    e = ST.events_stream(spark, d, None).where(F.col("event_type") == "view")
    sc = F.col("value") / (F.col("value") + 50.0)
    p = e.select("ts", (sc >= 0.5).cast("int").alias("prediction"))
    s = ST.run_available(ST.positive_rate_stream(p), "positive_rate", mode="update")
    return rounded(_ntz(ST.latest_versions(_none_late(s), ["window_start"]), "window_start"), ["positive_rate"])


@query("stream_latency")
def stream_latency(spark, d):
    """R11 on a stream (approximate percentiles from a bounded sketch)."""
    s = ST.run_available(ST.latency_stream(ST.request_log_stream(ST.events_stream(spark, d, None))), "latency", mode="update")
    return ST.latest_versions(_none_late(s), ["window_start"])


@query("stream_failure_runs", Q.with_(EV + """,
fr_st AS (SELECT host, ts, count(*) FILTER (WHERE status <> 503) AS oks, count(*) FILTER (WHERE status = 503) AS fails
          FROM lg GROUP BY host, ts),
fr_is AS (SELECT *, sum(oks) OVER (PARTITION BY host ORDER BY ts) AS island FROM fr_st)""",
  """SELECT host, min(ts) AS run_start, max(ts) AS run_end, CAST(sum(fails) AS BIGINT) AS n_failures
FROM fr_is WHERE oks = 0 GROUP BY host, island HAVING sum(fails) >= 3"""))
def stream_failure_runs(spark, d):
    """R14 on a stream: stateful per-host runs of 503s, fed in order of time."""
    rows = ST.with_cast_ts(events(spark, d))
    runs = ST.latest_runs(_none_late(ST.run_in_order(
        rows, load_of("ts"), lambda ev: ST.failure_runs_stream(ST.request_log_stream(ev), 3, watermark="0 seconds"),
        "failure_runs", "update")))
    return _ntz(runs, "run_start", "run_end")


@query("stream_outcome_join", Q.with_(OUTCOME, "SELECT pred_id, user_id, ts, outcome, next_event_ts FROM jo"))
def stream_outcome_join(spark, d):
    """R8 on streams: stream-stream interval join (7 days), closed at the
    latest outcome to one row per prediction, fed in order of time: no row comes
    late, so the watermark needs no delay and the state holds one horizon."""
    def build(ev):
        p = ev.where(F.col("event_type") == "view").select(F.col("event_id").alias("pred_id"), "user_id", "ts")
        return ST.outcome_join_stream(p, ev.where(F.col("event_type") == "purchase").select("user_id", "ts"), H, watermark="0 seconds")

    rows = ST.with_cast_ts(events(spark, d).select("event_id", "user_id", "ts", "event_type"))
    hits = _none_late(ST.run_in_order(rows, load_of("ts"), build, "outcome_join", idle=False))
    return ST.outcome_from_hits(preds(spark, d), _ntz(hits, "o_ts"), outcomes(spark, d), H)


#: Seconds by which an event comes late, by its number: most at once, some hours, days or weeks later.
LATE_SQL = "CASE WHEN event_id % 10 = 3 THEN 259200 WHEN event_id % 10 = 7 THEN 43200 WHEN event_id % 17 = 5 THEN 1296000 ELSE 0 END"
LOAD_SECONDS = 5 * 86400


@query("r24_late_rows", Q.with_(f"""ar AS (SELECT event_id, ts, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') + CAST(1000000 AS BIGINT) * ({LATE_SQL}))
           // CAST({LOAD_SECONDS * 1000000} AS BIGINT) AS load FROM events),
mx AS (SELECT load, max(ts) AS top FROM ar GROUP BY load),
wm AS (SELECT load, date_trunc('millisecond', max(top) OVER (ORDER BY load ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
              - INTERVAL 2 DAY AS wm FROM mx)""",
  """SELECT CAST(load AS BIGINT) AS load, CAST(count(*) FILTER (WHERE wm IS NULL OR ts > wm) AS BIGINT) AS kept,
  CAST(count(*) FILTER (WHERE ts <= wm) AS BIGINT) AS dropped, min(ts) FILTER (WHERE ts <= wm) AS first_dropped,
  max(ts) FILTER (WHERE ts <= wm) AS last_dropped, min(ts) FILTER (WHERE wm IS NULL OR ts > wm) AS first_kept
FROM ar JOIN wm USING (load) GROUP BY load"""))
def r24_late_rows(spark, d):
    """The events come in loads of five days by time of arrival, up to two
    weeks late.  The job starts anew for every load and goes on from its
    checkpoint; a watermark of two days decides what still counts."""
    base = ST._work_dir(spark, "late")
    feed, out = os.path.join(base, "feed"), os.path.join(base, "out")
    start = F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    micros = F.unix_micros("ts") - start + 1_000_000 * F.expr(LATE_SQL).cast("long")
    arrivals = ST.with_cast_ts(events(spark, d).select("event_id", "ts")).withColumn(
        "load", F.floor(micros / (LOAD_SECONDS * 1_000_000)).cast("long"))

    def run():
        s = spark.readStream.schema(arrivals.schema).parquet(feed)
        ST.split_late(s, out, os.path.join(base, "ck"), "event_id").trigger(availableNow=True).start().awaitTermination()

    ST.in_loads(arrivals, "load", feed, run)
    both = [spark.read.schema(arrivals.schema).parquet(os.path.join(out, n)).withColumn("late", F.lit(n == "late"))
            for n in ("kept", "late")]
    late, ts = F.col("late"), F.col("ts").cast("timestamp_ntz")
    return both[0].unionByName(both[1]).groupBy("load").agg(
        F.count_if(~late).alias("kept"), F.count_if(late).alias("dropped"), F.min(F.when(late, ts)).alias("first_dropped"),
        F.max(F.when(late, ts)).alias("last_dropped"), F.min(F.when(~late, ts)).alias("first_kept"))


@query("i9_stream_score")
def i9_stream_score(spark, d):
    """JSON records (mixed casing, Title-Case keys) arrive as a text
    stream; each micro-batch is parsed, validated and scored; valid and
    rejected rows go to two partitioned sinks keyed by batch id."""
    from churnspark.functions import encode as E
    from churnspark.operators import models as M
    from churnspark.operators import scoring as I
    from churnspark.plans.slice import cleaned_features
    from churnspark.session import cut_lineage
    from churnspark.sources.tables import snapshot
    f = cut_lineage(cleaned_features(spark, d))
    pm = E.build_preprocessor().fit(f)
    lr = M.fit_logistic(pm.transform(f), S.TARGET)
    base = ST._work_dir(spark, "records")
    raw = snapshot(spark, d, casing=True)
    title = {c: " ".join(w.capitalize() for w in c.split("_")) for c in S.INPUT_FIELDS}
    raw.select(F.to_json(F.struct(F.col("customerid").alias("customerid"),
                                  *[F.col(c).cast("string").alias(title[c]) for c in S.INPUT_FIELDS])).alias("value")
               ).write.mode("overwrite").text(os.path.join(base, "in"))
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 4).text(os.path.join(base, "in"))

    def score_fn(ok):
        x = pm.transform(_prep(ok))
        return I.decide(lr.transform(x)).select("churn_probability", "prediction", "action_cost", "model_version")

    def _prep(ok):
        from churnspark.functions.features import add_features
        from churnspark.operators import clean as C
        y = C.normalize_phone(ok)
        y, _ = C.normalize_no_service(y)
        y, _ = C.fix_inconsistent_services(y)
        return add_features(y)

    q = ST.stream_score(stream, score_fn, os.path.join(base, "out"), os.path.join(base, "ck"))
    q.trigger(availableNow=True).start().awaitTermination()
    sc = spark.read.parquet(os.path.join(base, "out", "scored")).select(F.lit("scored").alias("sink"))
    rj = spark.read.parquet(os.path.join(base, "out", "rejected")).select(F.lit("rejected").alias("sink"))
    return sc.unionByName(rj).groupBy("sink").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
