"""Streaming joins, runs and late rows; the search rule; plans of single-pass queries."""
import datetime as dt
import os
import re

from pyspark.sql import functions as F

from churnspark.operators import models as M
from churnspark.operators import monitor as R
from churnspark.plans import registry
from churnspark.sources.tables import events
from churnspark.streaming import jobs as ST

from conftest import SF001, rows

T0 = dt.datetime(2024, 1, 1)


def _files(spark, tmp_path, parts, schema):
    """One file per part, read one after the other (file times follow the parts)."""
    for i, p in enumerate(parts):
        spark.createDataFrame(p, schema).coalesce(1).write.parquet(str(tmp_path / f"p{i}"))
        for f in (tmp_path / f"p{i}").glob("*.parquet"):
            os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "p*")))


def test_outcome_join_equals_batch(spark):
    registry.load_all()
    got = registry.QUERIES["stream_outcome_join"](spark, SF001)
    want = registry.QUERIES["r8_attach_outcome"](spark, SF001)
    assert rows(got.select(*want.columns)) == rows(want)


def test_failure_runs_equal_batch(spark):
    registry.load_all()
    want = R.failure_runs(R.request_log(events(spark, SF001)), 3)
    got = registry.QUERIES["stream_failure_runs"](spark, SF001)
    assert rows(got.select(*want.columns)) == rows(want)


def test_failure_runs_out_of_order_ties_and_open_run(spark, tmp_path):
    m = lambda i: T0 + dt.timedelta(minutes=i)
    parts = [[("a", m(2), 503), ("a", m(0), 503), ("a", m(4), 200)],      # 1 and 3 come later
             [("a", m(1), 503), ("a", m(3), 503), ("b", m(5), 503), ("b", m(5), 200)],
             [("b", m(6), 503), ("b", m(7), 503), ("b", m(8), 503), ("c", m(60), 200)]]
    log = _files(spark, tmp_path, parts, "host string, ts timestamp, status int")
    got = ST.latest_runs(ST.run_available(ST.failure_runs_stream(log, 3, watermark="10 minutes"), "runs", mode="update"))
    assert sorted((r.host, r.run_start, r.run_end, r.n_failures) for r in got.collect()) == [
        ("a", m(0), m(3), 4), ("b", m(6), m(8), 3)]


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    day = lambda d, h=0: T0 + dt.timedelta(days=d, hours=h)
    # a batch is held against the watermark of the batch before it, so the late rows come two files later
    parts = [[(1, day(0))], [(1, day(10))], [(1, day(10, 1))], [(1, day(0, 1)), (2, day(0, 2)), (3, day(11))]]
    ev = _files(spark, tmp_path, parts, "user_id long, ts timestamp")
    s = ST.run_available(ST.sessions_stream(ev, watermark="1 day"), "late")
    assert s._late_rows == 2
    assert [(r.user_id, r.session_start) for r in s.collect()] == [(1, day(0))]


def test_trial_value_uses_mean_recall():
    assert M.trial_value([10.0, 20.0, 30.0], [0.9, 0.9, 0.1], slo=0.6) == 20.0
    assert M.trial_value([10.0, 20.0], [0.5, 0.6], slo=0.6) == -1e8


def test_random_grid_trials_differ():
    got = M.random_grid({"a": [1, 2], "b": [1, 2, 3]}, 5)
    assert len({tuple(sorted(t.items())) for t in got}) == 5
    assert len(M.random_grid({"a": [1, 2]}, 9)) == 2
    assert all(1e-4 <= t["c"] <= 1e-1 for t in M.random_grid({"c": M.LogRange(1e-4, 1e-1)}, 20))


def test_single_pass_query_scans_only_its_columns(spark):
    registry.load_all()
    plan = registry.QUERIES["d17_event_rate"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and len(re.findall("Relation ", plan)) == 2     # customer and orders, once each


def test_streams_read_files_out_of_time_order(spark, tmp_path):
    registry.load_all()
    ev = spark.read.parquet(os.path.join(SF001, "events.parquet"))
    a, b = dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 25)
    # three files: the filter of late rows lags the watermark by a trigger
    for i, part in enumerate((ev.where(F.col("ts") >= F.lit(b)), ev.where((F.col("ts") >= F.lit(a)) & (F.col("ts") < F.lit(b))),
                              ev.where(F.col("ts") < F.lit(a)))):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
        for f in (tmp_path / "events.parquet").glob("*.parquet"):  # the later events are in the older files
            t = f.stat().st_mtime - 1000
            os.utime(f, (t, t))
    for name in ("stream_outcome_join", "stream_failure_runs"):
        q = registry.QUERIES[name]
        key = lambda df: sorted(map(str, df.collect()))
        assert key(q(spark, str(tmp_path))) == key(q(spark, SF001)), name


def test_ordered_loads_keep_little_state_and_no_idle_batch(spark, monkeypatch, tmp_path):
    """One batch a load, state on a few partitions for each core, the session's settings as before."""
    monkeypatch.setattr(ST, "_work_dir", lambda s, name: str(tmp_path / name))
    day = lambda d: T0 + dt.timedelta(days=d)
    ev = spark.createDataFrame([(1, 7, day(0), "view"), (2, 7, day(3), "purchase"), (3, 7, day(8), "purchase"),
                                (4, 8, day(8), "view"), (5, 8, day(15), "purchase"), (6, 8, day(40), "view")],
                               "event_id long, user_id long, ts timestamp, event_type string")

    def build(x):
        p = x.where("event_type = 'view'").select(F.col("event_id").alias("pred_id"), "user_id", "ts")
        return ST.outcome_join_stream(p, x.where("event_type = 'purchase'").select("user_id", "ts"), 7, watermark="0 seconds")

    monkeypatch.setattr(ST, "STATE_PARTS", 1)
    names = ("spark.sql.shuffle.partitions", "spark.sql.streaming.noDataMicroBatches.enabled")
    before = [spark.conf.get(n) for n in names]
    load = F.floor(F.unix_seconds("ts") / (6 * 86400)).cast("long")
    hits = ST.run_in_order(ev, load, build, "join", idle=False)
    assert sorted((r.pred_id, r.o_ts) for r in hits.collect()) == [(1, day(3)), (4, day(15))] and hits._late_rows == 0
    assert [spark.conf.get(n) for n in names] == before
    batches = [f for f in os.listdir(tmp_path / "join/checkpoint/commits") if f.isdigit()]
    assert len(batches) == ev.select(load).distinct().count()
    parts = [f for f in os.listdir(tmp_path / "join/checkpoint/state/0") if f.isdigit()]
    assert len(parts) == spark.sparkContext.defaultParallelism < int(before[0])
