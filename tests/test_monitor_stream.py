"""Monitoring jobs (batch) and their streaming forms (batch equality)."""
import datetime as dt

from pyspark.sql import functions as F

from churnspark.operators import monitor as R
from churnspark.sources.tables import events
from churnspark.streaming import jobs as ST

from conftest import SF001, rows


def test_psi_of_identical_samples_is_zero(spark):
    df = spark.range(500).select((F.col("id") % 37).cast("double").alias("x"))
    assert abs(R.psi(df, df, ["x"]).first().psi) < 1e-12


def test_attach_outcome_brute_force(spark):
    t0 = dt.datetime(2024, 1, 1)
    preds = spark.createDataFrame([(1, 7, t0), (2, 7, t0 + dt.timedelta(days=1, hours=23)),
                                   (3, 8, t0 + dt.timedelta(hours=5))], "pred_id long, user_id long, ts timestamp")
    ev = spark.createDataFrame([(7, t0 + dt.timedelta(hours=1)), (7, t0 + dt.timedelta(days=4)),
                                (8, t0 + dt.timedelta(days=3, hours=6)), (9, t0 + dt.timedelta(days=30))],
                               "user_id long, ts timestamp")
    got = {r.pred_id: (r.outcome, r.next_event_ts) for r in R.attach_outcome(preds, ev, horizon_days=3).collect()}
    assert got[1] == (1, t0 + dt.timedelta(hours=1))
    assert got[2] == (1, t0 + dt.timedelta(days=4))
    assert got[3] == (0, None)


def test_latest_prediction_before(spark):
    t0 = dt.datetime(2024, 1, 1)
    preds = spark.createDataFrame([(1, 7, t0), (2, 7, t0 + dt.timedelta(days=2))], "pred_id long, user_id long, ts timestamp")
    ev = spark.createDataFrame([(10, 7, t0 + dt.timedelta(days=1)), (11, 7, t0 + dt.timedelta(days=2, hours=1)),
                                (12, 8, t0)], "event_id long, user_id long, ts timestamp")
    got = {r.event_id: r.pred_id for r in R.latest_prediction_before(ev, preds).collect()}
    assert got == {10: 1, 11: 2, 12: None}


def test_failure_runs(spark):
    t0 = dt.datetime(2024, 1, 1)
    st = [200, 503, 503, 503, 200, 503, 503, 200, 503, 503, 503, 503]
    log = spark.createDataFrame([("h0", t0 + dt.timedelta(minutes=i), s) for i, s in enumerate(st)],
                                "host string, ts timestamp, status int")
    got = sorted(r.n_failures for r in R.failure_runs(log, 3).collect())
    assert got == [3, 4]


def _log(spark):
    return R.request_log(events(spark, SF001))


def test_stream_error_rates_equal_batch(spark):
    s = ST.run_available(ST.error_rates_stream(ST.request_log_stream(ST.events_stream(spark, SF001))),
                         "err", mode="complete")
    b = R.error_rates(_log(spark)).select("window_start", "n", "rate_4xx", "rate_5xx")
    assert rows(s.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n",
                         "rate_4xx", "rate_5xx")) == rows(b)


def test_stream_sessions_equal_batch(spark):
    s = ST.run_available(ST.sessions_stream(ST.events_stream(spark, SF001), watermark="365 days"), "ses",
                         mode="complete")
    b = R.sessions(events(spark, SF001))
    assert s.count() == b.count()
