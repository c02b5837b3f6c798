"""Structured Streaming forms of scoring and monitoring (I9, R6, R8, R11,
R12, R14, R23, R24).

Every job reads a stream (file source here; any streaming source works),
declares a watermark so state stays bounded, and writes with a checkpoint in
the shared checkpoint folder, so a restarted or retried query resumes
exactly where it stopped.  ``run_available`` drives a query over everything
currently available (``availableNow``) and returns the written table, which
is how the batch-equality tests and the registered queries use them.
"""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from churnspark.operators import clean as C
from churnspark.operators import monitor as R
from churnspark.session import checkpoint_dir


def events_stream(spark: SparkSession, sf_dir: str, max_files: int | None = 1) -> DataFrame:
    """The ``events`` table as a file stream; the schema is the batch table's.
    ``max_files`` None: all files in one trigger, however many."""
    path = os.path.join(sf_dir, "events.parquet")
    schema = spark.read.parquet(path).schema
    # a file source wants a folder or a pattern; this pattern fits the one name only
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    s = reader.parquet(path[:-1] + "[t]")
    # watermarks need TIMESTAMP (with time zone semantics); the file stores NTZ
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def _work_dir(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


#: State partitions for each core, at most: every one is loaded, committed and written in every batch, however few its rows.
STATE_PARTS = 3


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """``values`` in the session's settings, and afterwards what was there before."""
    old = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


class LateRows(StreamingQueryListener):
    """Rows that the watermark dropped, summed over every batch and every
    stateful operator of the query named ``query`` (``recentProgress`` keeps
    the last batches only)."""

    def __init__(self, query: str):
        self.query, self.rows, self._ids, self._done = query, 0, set(), threading.Event()

    def onQueryStarted(self, event):
        if event.name == self.query:
            self._ids.add(event.runId)

    def onQueryProgress(self, event):
        if event.progress.name == self.query:
            self.rows += sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.runId in self._ids:
            self._done.set()

    def total(self, seconds: float = 60.0) -> int:
        """The sum once the query's last event has arrived."""
        if not self._done.wait(seconds):
            raise TimeoutError(f"no end event of {self.query}")
        return self.rows


def run_available(df: DataFrame, name: str, mode: str = "append",
                  sink: Callable | None = None, base: str | None = None) -> DataFrame:
    """Run a streaming frame over all available input (availableNow) into a
    parquet table in the shared checkpoint folder; return that table.

    ``sink`` (a foreachBatch function taking (batch_df, batch_id, out_dir))
    replaces the default parquet sink.  Update mode writes each batch's rows
    to its own folder, so a replayed batch is harmless.  ``base``: the folder of
    an earlier run of the same query, which this one goes on with."""
    spark = df.sparkSession
    base = base or _work_dir(spark, name)
    out, ck = os.path.join(base, "out"), os.path.join(base, "checkpoint")
    run_name = f"{os.path.basename(base)}-{uuid.uuid4().hex[:6]}"
    w = df.writeStream.queryName(run_name).option("checkpointLocation", ck).trigger(availableNow=True)
    late = LateRows(run_name)
    spark.streams.addListener(late)
    try:
        if mode == "complete" or sink is not None:
            fn = sink or (lambda b, i, o=out: b.write.mode("overwrite").parquet(o))
            q = w.outputMode(mode).foreachBatch(lambda b, i: fn(b, i, out) if sink else fn(b, i)).start()
        elif mode == "update":
            q = w.outputMode(mode).foreachBatch(
                lambda b, i: b.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={i}"))).start()
        else:
            q = w.outputMode(mode).format("parquet").option("path", out).start()
        q.awaitTermination()
        dropped = late.total()
    finally:
        spark.streams.removeListener(late)
    try:       # the output folder may be on any Hadoop filesystem (shared folder)
        res = spark.read.parquet(out)
    except AnalysisException:           # nothing was written (no input rows)
        res = spark.createDataFrame([], df.schema)
    res._late_rows = dropped      # R24
    return res


# ---------------------------------------------------------------- I9
def stream_score(records: DataFrame, score_fn: Callable[[DataFrame], DataFrame], out_dir: str,
                 checkpoint: str, json_col: str | None = "value"):
    """Continuous scoring.  Each micro-batch is parsed (S11), validated
    (P17); valid rows are scored by ``score_fn`` and written to
    ``out_dir/scored/batch_id=N``, rejected rows with their errors to
    ``out_dir/rejected/batch_id=N``.  Overwriting the batch's own partition
    makes a replayed batch harmless (exactly-once output)."""
    from churnspark.sources.io import parse_records

    def per_batch(batch: DataFrame, batch_id: int):
        x = parse_records(batch, json_col) if json_col else batch
        x = C.canonicalize(x)
        x = x.withColumns({"tenure_months": F.col("tenure_months").try_cast("int"),
                           "monthly_charges": F.col("monthly_charges").try_cast("double"),
                           "total_charges": F.col("total_charges").try_cast("double")})
        x = x.persist()
        ok, rejected = C.validate(x)
        score_fn(ok).write.mode("overwrite").parquet(os.path.join(out_dir, "scored", f"batch_id={batch_id}"))
        rejected.write.mode("overwrite").parquet(os.path.join(out_dir, "rejected", f"batch_id={batch_id}"))
        x.unpersist()

    return (records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(per_batch))


# ---------------------------------------------------------------- R24
def arrived_and_kept(feed: DataFrame, key: str, ts: str = "ts", watermark: str = "2 days") -> DataFrame:
    """Every row of the stream once as it arrived (``_kept`` false) and, if the
    watermark let it pass, once more (``_kept`` true).

    The watermark is Spark's own: a stateful operator (``dropDuplicates`` on
    the key and time, so a row that is delivered twice counts once) drops what
    is older than the latest time of the batches before, less the delay; its
    state holds the keys of one delay."""
    kept = feed.withWatermark(ts, watermark).dropDuplicates([key, ts])
    return kept.withColumn("_kept", F.lit(True)).unionByName(feed.withColumn("_kept", F.lit(False)))


def split_late(feed: DataFrame, out_dir: str, checkpoint: str, key: str, ts: str = "ts", watermark: str = "2 days"):
    """A stream writer (start it with any trigger) that keeps two tables:
    ``out_dir/kept``, what the watermark let pass, and ``out_dir/late``, the rows
    that it dropped.

    Spark itself only counts dropped rows.  Here each batch's arrivals are
    compared with what came through of the same batch (a null-safe anti join
    that never looks beyond the batch).  Both tables are written by
    ``batch_id``, overwriting the batch's own folder, so a batch that is run
    again after a failure leaves no row twice.  A row that repeats the key and
    time of one kept in an earlier batch is no news and is in ``late`` too."""
    def per_batch(batch: DataFrame, batch_id: int):
        b = batch.persist()
        kept = b.where("_kept").drop("_kept")
        seen = kept.select(F.col(key).alias("_k"), F.col(ts).alias("_t"))
        late = (b.where("not _kept").drop("_kept")
                 .join(seen, F.col(key).eqNullSafe(F.col("_k")) & F.col(ts).eqNullSafe(F.col("_t")), "left_anti"))
        for name, rows in (("kept", kept), ("late", late)):
            rows.write.mode("overwrite").parquet(os.path.join(out_dir, name, f"batch_id={batch_id}"))
        b.unpersist()

    return (arrived_and_kept(feed, key, ts, watermark).writeStream
            .option("checkpointLocation", checkpoint).foreachBatch(per_batch))


def run_in_order(rows: DataFrame, load, build: Callable[[DataFrame], DataFrame], name: str, mode: str = "append",
                 ts: str = "ts", end: str | None = None, idle: bool = True) -> DataFrame:
    """Run the stream ``build`` makes of a table that is not in time order: the
    table is dealt into loads by ``load`` (a column that rises with ``ts``, say its
    day), and the query is started once for each, in order, going on from its
    checkpoint.  So the watermark follows the data and the state holds one
    load and one delay, not the whole table.  ``end``: an interval after which a
    last row, null but for its time, comes by itself: it moves the watermark
    past all that is still open.  ``idle`` False: no batch without rows follows a
    load, for queries (inner joins) that emit nothing in it; the next load drops
    the state that has passed.  The state is dealt to no more partitions than
    ``STATE_PARTS`` a core, since a start loads and a batch commits them all.
    The result is as of ``run_available``."""
    spark = rows.sparkSession
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), STATE_PARTS * spark.sparkContext.defaultParallelism)
    with _settings(spark, {"spark.sql.shuffle.partitions": str(parts),
                           "spark.sql.streaming.noDataMicroBatches.enabled": str(idle).lower()}):
        return _run_loads(rows, load, build, name, mode, ts, end)


def _run_loads(rows: DataFrame, load, build: Callable[[DataFrame], DataFrame], name: str, mode: str, ts: str, end: str | None) -> DataFrame:
    spark = rows.sparkSession
    base = _work_dir(spark, name)
    feed, late, out = os.path.join(base, "feed"), 0, None

    def each():
        nonlocal late, out
        out = run_available(build(spark.readStream.schema(rows.schema).parquet(feed)), name, mode, base=base)
        late += out._late_rows

    in_loads(rows, load, feed, each)
    if end is not None and out is not None:
        beat = rows.agg((F.max(ts) + F.expr(f"INTERVAL {end}")).alias(ts))  # one row
        beat.select(*[F.col(ts) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
                    ).write.mode("append").parquet(feed)
        each()
    if out is None:
        out = run_available(build(spark.readStream.schema(rows.schema).parquet(_empty(rows, feed))), name, mode, base=base)
    out._late_rows = late
    return out


def _empty(rows: DataFrame, path: str) -> str:
    rows.limit(0).write.mode("append").parquet(path)
    return path


def latest_versions(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last version of each row that an update-mode run wrote (by ``batch_id``)."""
    rest = [c for c in versions.columns if c not in (*keys, "batch_id")]
    return versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("v")).select(*keys, "v.*")


def in_loads(arrivals: DataFrame, load, path: str, after_each: Callable[[], None]) -> None:
    """Deliver a table as a file feed: the rows of each value of ``load`` (a
    column or its name), in its order, are added to ``path``, and ``after_each``
    runs what reads them, as a job does that starts anew for every delivery.
    Rows without a load come first.  The loads are few (one a night, say); the
    table is dealt to them in one pass."""
    stage = f"{path}-stage-{uuid.uuid4().hex[:8]}"
    arrivals.withColumn("_load", F.col(load) if isinstance(load, str) else load).write.partitionBy("_load").parquet(stage)
    rows = arrivals.sparkSession.read.parquet(stage)
    for r in rows.select("_load").distinct().orderBy("_load").collect():
        rows.where(F.col("_load").eqNullSafe(F.lit(r[0]))).drop("_load").write.mode("append").parquet(path)
        after_each()


# ---------------------------------------------------------------- R6, R11, R12, R23
def error_rates_stream(log: DataFrame, window: str = "1 day", watermark: str = "2 days") -> DataFrame:
    """R12 on a stream: 4xx / 5xx share per tumbling window (watermarked)."""
    s = F.col("status")
    g = (log.withWatermark("ts", watermark)
            .groupBy(F.window("ts", window).alias("w"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                 (F.count_if((s >= 400) & (s < 500)) / F.count(F.lit(1))).alias("rate_4xx"),
                 (F.count_if(s >= 500) / F.count(F.lit(1))).alias("rate_5xx")))
    return g.select(F.col("w.start").alias("window_start"), "n", "rate_4xx", "rate_5xx")


def latency_stream(log: DataFrame, window: str = "1 day", watermark: str = "2 days",
                   accuracy: int = 10000) -> DataFrame:
    """R11 on a stream: p50/p95 latency per window with ``percentile_approx``
    (a bounded sketch per window; the batch form is exact)."""
    g = (log.withWatermark("ts", watermark).groupBy(F.window("ts", window).alias("w"))
            .agg(F.percentile_approx("elapsed_ms", [0.5, 0.95], accuracy).alias("q"),
                 F.count(F.lit(1)).cast("bigint").alias("n")))
    return g.select(F.col("w.start").alias("window_start"), "n", F.col("q")[0].alias("p50"),
                    F.col("q")[1].alias("p95"))


def positive_rate_stream(preds: DataFrame, window: str = "7 days", watermark: str = "2 days") -> DataFrame:
    """R6 on a stream: positive-prediction rate per window."""
    g = (preds.withWatermark("ts", watermark).groupBy(F.window("ts", window).alias("w"))
              .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                   F.avg(F.col("prediction").cast("double")).alias("positive_rate")))
    return g.select(F.col("w.start").alias("window_start"), "n", "positive_rate")


def sessions_stream(events: DataFrame, gap: str = "30 minutes", watermark: str = "2 hours",
                    key: str = "user_id") -> DataFrame:
    """Session windows per customer on a stream; rows later than the
    watermark are dropped (and counted in the progress events)."""
    g = (events.withWatermark("ts", watermark)
               .groupBy(key, F.session_window("ts", gap).alias("s"))
               .agg(F.count(F.lit(1)).cast("bigint").alias("n_events")))
    return g.select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n_events")


# ---------------------------------------------------------------- R8
def outcome_join_stream(preds: DataFrame, outcomes: DataFrame, horizon_days: int = 7,
                        watermark: str = "8 days", key: str = "user_id") -> DataFrame:
    """R8 on streams: inner stream-stream join within (p.ts, p.ts + horizon];
    watermarks on both sides bound the state.  A hit is emitted as soon as
    both rows are there; ``outcome_from_hits`` closes the horizon."""
    p = preds.select(F.col("pred_id"), F.col(key).alias("p_key"), F.col("ts").alias("p_ts")) \
             .withWatermark("p_ts", watermark)
    o = outcomes.select(F.col(key).alias("o_key"), F.col("ts").alias("o_ts")) \
                .withWatermark("o_ts", watermark)
    cond = ((F.col("p_key") == F.col("o_key")) & (F.col("o_ts") > F.col("p_ts")) &
            (F.col("o_ts") <= F.col("p_ts") + F.expr(f"INTERVAL {int(horizon_days)} DAYS")))
    return p.join(o, cond).select("pred_id", "o_ts")


def outcome_from_hits(preds: DataFrame, hits: DataFrame, outcomes: DataFrame, horizon_days: int = 7,
                      key: str = "user_id") -> DataFrame:
    """One row per prediction whose horizon has elapsed by the latest outcome
    read so far.  A prediction still open is left out, hit or not, so that hits
    (known early) do not bias the outcome rate; one without a hit is a miss."""
    first = hits.groupBy("pred_id").agg(F.min("o_ts").alias("next_event_ts"))
    end = F.col("ts") + F.expr(f"INTERVAL {int(horizon_days)} DAYS")
    as_of = outcomes.agg(F.max("ts").alias("as_of"))             # one row
    return (preds.select("pred_id", key, "ts").crossJoin(F.broadcast(as_of)).where(end <= F.col("as_of"))
                 .join(first, "pred_id", "left")
                 .select("pred_id", key, "ts", F.when(F.col("next_event_ts").isNotNull(), 1).otherwise(0).alias("outcome"),
                         "next_event_ts"))


# ---------------------------------------------------------------- R14
RUN_SCHEMA = "host string, run_start timestamp, run_end timestamp, n_failures long"
#: The run in progress, and the steps (ts, failures, successes) that the watermark has not passed.
RUN_STATE = ("current_len long, run_start timestamp, run_end timestamp, "
             "step_ts array<timestamp>, step_fail array<long>, step_ok array<long>")


def failure_runs_stream(log: DataFrame, n: int = 3, status: int = 503, watermark: str = "1 hour") -> DataFrame:
    """R14 on a stream (``applyInPandasWithState``, update mode): requests of a
    host that share a timestamp are one step, and a step with a success ends
    the run, as in the batch form.

    Steps wait in the state until the watermark has passed them, so neither
    Arrow batches nor triggers need to be in order; a timeout takes them up when
    no further row of the host comes.  A run is emitted once it has ``n``
    failures and again as it grows; ``latest_runs`` keeps the last version, so
    a run that is still open is reported too.  The state is one run and the
    steps of one watermark delay."""
    def fn(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        cur, start, end, *old = state.get if state.exists else (0, None, None, [], [], [])
        parts = [pd.DataFrame({"ts": pd.to_datetime(pd.Series(list(old[0]), dtype="datetime64[ns]")),
                               "fail": list(old[1]), "ok": list(old[2])})]
        if not state.hasTimedOut:
            for pdf in batches:
                bad = pdf["status"] == status
                parts.append(pd.DataFrame({"ts": pdf["ts"], "fail": bad.astype("int64"), "ok": (~bad).astype("int64")}))
        steps = pd.concat([x for x in parts if len(x)] or parts).groupby("ts", sort=True)[["fail", "ok"]].sum()
        steps = steps.astype("int64").reset_index()
        passed = state.getCurrentWatermarkMs()
        ms = steps["ts"].astype("datetime64[ns]").astype("int64") // 1_000_000
        final, wait = steps[ms <= passed], steps[ms > passed]
        out: dict = {}
        for ts, fail, ok in final.itertuples(index=False):
            if ok:
                cur, start, end = 0, None, None
            else:
                start, end, cur = (ts if cur == 0 else start), ts, cur + fail
                if cur >= n:
                    out[start] = (key[0], start, end, cur)
        state.update((cur, start, end, [t.to_pydatetime() for t in wait["ts"]],
                      wait["fail"].tolist(), wait["ok"].tolist()))
        if len(wait):
            # fires once the watermark is beyond this time
            state.setTimeoutTimestamp(int(max(ms[wait.index].min() - 1, passed + 1)))
        yield pd.DataFrame(list(out.values()), columns=["host", "run_start", "run_end", "n_failures"])

    x = log.select("host", F.col("ts").cast("timestamp").alias("ts"), "status").withWatermark("ts", watermark)
    return x.groupBy("host").applyInPandasWithState(fn, RUN_SCHEMA, RUN_STATE, "update",
                                                    GroupStateTimeout.EventTimeTimeout)


def latest_runs(versions: DataFrame) -> DataFrame:
    """The longest version of each run that ``failure_runs_stream`` emitted."""
    return versions.groupBy("host", "run_start").agg(F.max("run_end").alias("run_end"),
                                                     F.max("n_failures").alias("n_failures"))


def request_log_stream(events: DataFrame) -> DataFrame:
    """R10 on a stream: the request-log projection (stateless)."""
    return R.request_log(events)


def with_cast_ts(df: DataFrame, cols: Sequence[str] = ("ts",)) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp") for c in cols})
