"""Jobs that write and read back: late rows, out-of-fold scores, nightly scores, reloads, the network, studies."""
import datetime as dt
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.operators import models as M
from churnspark.operators import network as N
from churnspark.operators import scoring as I
from churnspark.operators import search as H
from churnspark.operators import split as V
from churnspark.sources import io
from churnspark.streaming import jobs as ST


def day(n, hour=0):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=n, hours=hour)


@pytest.fixture(scope="module")
def tmp(tmp_path_factory):
    return str(tmp_path_factory.mktemp("jobs"))


# ---------------------------------------------------------------- R24
def test_late_rows_go_to_the_side_table(spark, tmp):
    rows = [(10, day(1), None), (1, day(0), 0), (2, day(5), 0), (None, day(4), 0),
            (3, day(4), 1), (4, day(3), 1), (5, day(2, 23), 1), (6, day(10), 1), (2, day(5), 1), (None, day(4), 1),
            (7, day(8, 1), 2), (8, day(7), 2), (6, day(10), 2), (9, day(11), 2), (9, day(11), 2)]
    arrivals = spark.createDataFrame(rows, "id long, ts timestamp, load int")
    feed, out, seen = f"{tmp}/late-feed", f"{tmp}/late-out", []

    def run():
        s = spark.readStream.schema(arrivals.schema).parquet(feed)
        ST.split_late(s, out, f"{tmp}/late-ck", "id").trigger(availableNow=True).start().awaitTermination()
        seen.append(1)

    ST.in_loads(arrivals, "load", feed, run)
    kept = Counter((r.id, r.load) for r in spark.read.parquet(f"{out}/kept").collect())
    late = Counter((r.id, r.load) for r in spark.read.parquet(f"{out}/late").collect())
    assert len(seen) == 4
    # watermarks: none, day 3 (5 less 2), day 8 (10 less 2); a time equal to the watermark is late
    assert kept == Counter({(10, None): 1, (1, 0): 1, (2, 0): 1, (None, 0): 1, (3, 1): 1, (6, 1): 1, (7, 2): 1, (9, 2): 1})
    # day 3 and before, then what repeats a row kept before, then day 8 and before
    assert late == Counter({(4, 1): 1, (5, 1): 1, (2, 1): 1, (None, 1): 1, (8, 2): 1, (6, 2): 1})


# ---------------------------------------------------------------- V4, V5
def folds(spark, n=40):
    return spark.createDataFrame([(i, ["a", "b", None][i % 3], int(i % 4 == 0), i % 5) for i in range(n)],
                                 "id long, g string, y int, fold int")


def test_oof_refits_only_the_lost_fold(spark, tmp):
    df, path, fitted, broken = folds(spark), f"{tmp}/oof", [], [2]

    def fit(train):
        missing = ({0, 1, 2, 3, 4} - {r[0] for r in train.select("fold").distinct().collect()}).pop()
        fitted.append(missing)
        if missing in broken:
            raise ValueError("lost")
        return M.fit_group_rate(train, ["g"], "y")

    with pytest.raises(RuntimeError, match=r"folds \[2\] of 5"):
        V.oof_table(df, fit, path, ["id", "y"])
    assert sorted(fitted) == [0, 1, 2, 3, 4]
    broken.clear()
    oof = V.oof_table(df, fit, path, ["id", "y"])
    assert sorted(fitted) == [0, 1, 2, 2, 3, 4]
    rows = df.collect()
    for r in oof.collect():
        own = next(x for x in rows if x.id == r.id)
        rest = [x for x in rows if x.fold != own.fold]
        same = [x.y for x in rest if x.g == own.g] or [x.y for x in rest]
        assert r.fold == own.fold and abs(r.score - sum(same) / len(same)) < 1e-12
    assert tuple(V.check_oof(df, oof, "id").first()) == (40, 40, 40, 0)
    assert tuple(V.check_oof(df, oof.where("id <> 7"), "id").first()) == (40, 39, 39, 0)


def test_oof_of_no_rows_and_of_rows_without_a_fold(spark, tmp):
    df = folds(spark)
    assert V.oof_table(df.where("1 = 0"), None, f"{tmp}/oof-none", ["id"]).collect() == []
    some = df.withColumn("fold", F.when(F.col("id") < 30, F.col("fold")))
    oof = V.oof_table(some, lambda t: M.fit_group_rate(t, ["g"], "y"), f"{tmp}/oof-null", ["id"])
    assert {r.id for r in oof.collect()} == set(range(30))


def test_fold_metrics_and_their_summary(spark):
    rows = [("m", 0, 1, 0.9), ("m", 0, 0, 0.1), ("m", 1, 1, 0.2), ("m", 1, 0, 0.8)]
    m = V.fold_metrics(spark.createDataFrame(rows, "model string, fold int, label int, score double"))
    got = {r.metric: (r.mean, r.std, r.folds) for r in V.cv_summary(m).collect()}
    assert got["roc_auc"] == (0.5, 0.5, 2) and got["recall"] == (0.5, 0.5, 2) and got["mcc"] == (0.0, 1.0, 2)


# ---------------------------------------------------------------- I7, S12, S13
def test_a_night_that_is_run_again_is_replaced(spark, tmp):
    out, log = f"{tmp}/nights", f"{tmp}/nights-log"
    rows = spark.createDataFrame([(i,) for i in range(10)], "customerid long")
    scorer = lambda df: df.withColumn("score", F.lit(0.5))
    assert I.nightly_scores(rows.where("customerid < 4"), scorer, out, "2024-01-01", log, "a") == 4
    assert I.nightly_scores(rows, scorer, out, "2024-01-02", log, "b") == 10
    assert I.nightly_scores(rows, scorer, out, "2024-01-01", log, "c") == 10
    assert I.nightly_scores(rows.where("1 = 0"), scorer, out, "2024-01-03", log, "d") == 0
    assert Counter(str(r.score_date) for r in spark.read.parquet(out).collect()) == {"2024-01-01": 10, "2024-01-02": 10}
    runs = {r.run_id: r.rows for r in io.search_runs(spark, log, ["rows"], F.col("tags")["job"] == "nightly").collect()}
    assert runs == {"a": 4, "b": 10, "c": 10, "d": 0}


# ---------------------------------------------------------------- S8, S9
def test_reload_check_sees_a_difference(spark, tmp):
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(1, 2.0), (2, float("nan")), (3, -1.0)], "k long, x double")
    va = VectorAssembler(inputCols=["x"], outputCol="features", handleInvalid="keep")
    assert tuple(io.reload_check(va, f"{tmp}/va", df, "k", "features").first()) == (3, 0.0, True)

    class Drifting:
        def __getattr__(self, name):
            return getattr(va, name)

        def transform(self, d):
            return va.transform(d.withColumn("x", F.col("x") + 1e-6))
    import churnspark.sources.io as module
    old, module.save_pipeline = module.save_pipeline, lambda m, p: None
    try:
        r = io.reload_check(Drifting(), f"{tmp}/va", df, "k", "features").first()
    finally:
        module.save_pipeline = old
    assert r.rows == 3 and not r.same and 9e-7 < r.max_diff < 2e-6


# ---------------------------------------------------------------- M6
def test_gradient_against_finite_differences():
    rng = np.random.default_rng(0)
    shape = N.Shape((4, 5, 3, 1))
    flat, x, y = shape.start(1), rng.normal(size=(7, 4)), np.array([0, 1, 0, 1, 1, 0, 0.0])
    flat += rng.normal(0, 0.1, len(flat))
    _, grad = N.gradient(shape, flat, x, y, 3.0)
    for i in range(len(flat)):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        up, down = (N.loss_sum(N.logits(shape, flat + s, x), y, 3.0) / len(y) for s in (step, -step))
        assert abs((up - down) / 2e-6 - grad[i]) < 1e-6


def test_a_weight_equals_copies_of_the_row():
    rng = np.random.default_rng(2)
    shape, x, y = N.Shape((3, 4, 1)), rng.normal(size=(6, 3)), np.array([1, 0, 1, 0, 0, 0.0])
    flat = shape.start(3)
    copies = np.repeat(np.arange(6), np.where(y == 1, 4, 1))
    loss, grad = N.gradient(shape, flat, x, y, 4.0)
    loss2, grad2 = N.gradient(shape, flat, x[copies], y[copies], 1.0)
    assert abs(loss - loss2) < 1e-9 and np.allclose(grad * 6, grad2 * len(copies))


@pytest.fixture(scope="module")
def moons(spark):
    """Two classes that no line parts, one of them rare, in three partitions."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 2))
    y = ((x ** 2).sum(1) > 3.2).astype(int)
    rows = [(i, [float(v) for v in x[i]], int(y[i]), i % 5) for i in range(len(x))]
    return spark.createDataFrame(rows, "id long, features array<double>, churn_value int, fold int").repartition(3, "id").cache()


def test_network_learns_stops_and_goes_on_after_a_loss(spark, moons, tmp):
    from churnspark.operators.evaluate import roc_auc
    train, valid = moons.where("fold < 4"), moons.where("fold = 4")
    kw = dict(hidden=(16,), epochs=25, batch=16, lr=0.02, patience=4, min_delta=1e-3)
    net = N.fit_network(train, valid, path=f"{tmp}/net", **kw)
    h = net.rows
    best, wait, stop = float("inf"), 0, None
    for e, _, val, _ in h:  # the rule, plainly
        best, wait, at = (val, 0, e) if val < best - 1e-3 else (best, wait + 1, at)
        if wait == 4:
            stop = e
            break
    assert net.best_epoch == at and h[-1][0] == (stop or 25) and net.stopped == (stop is not None)
    scored = net.transform(valid).select(F.lit("m").alias("model"), "score", F.col("churn_value").alias("label"))
    assert roc_auc(scored).first().roc_auc > 0.9
    # the weights returned are those of the best epoch
    z = [(np.array(r.features), r.churn_value) for r in valid.collect()]
    pw = train.where("churn_value = 0").count() / train.where("churn_value = 1").count()
    val = N.loss_sum(N.logits(net.shape, net.flat, np.stack([a for a, _ in z])), np.array([b for _, b in z], float), pw) / len(z)
    assert abs(val - best) < 1e-9
    again = N.fit_network(train, valid, path=f"{tmp}/net", **kw)  # every epoch is there already
    assert (again.flat == net.flat).all() and again.rows == h
    short = N.fit_network(train, valid, path=f"{tmp}/net-cut", **{**kw, "epochs": 3})
    assert len(short.rows) == 3 and short.rows == h[:3]
    net.save(spark, f"{tmp}/net-saved")
    assert (N.Network.load(spark, f"{tmp}/net-saved").flat == net.flat).all()
    with pytest.raises(ValueError, match="both needed"):
        N.fit_network(train, valid.where("1 = 0"))


def test_early_stop_agrees_with_the_training(spark, moons):
    net = N.fit_network(moons.where("fold < 4"), moons.where("fold = 4"), hidden=(8,), epochs=12, batch=32, lr=0.05, patience=3)
    r = M.early_stop(net.history(spark), patience=3, value="val_loss").first()
    assert (r.stop_epoch, r.best_epoch_patience) == (net.rows[-1][0], net.best_epoch)


# ---------------------------------------------------------------- M8, M9
def test_spaces_are_drawn_within_their_bounds():
    for family, space in H.SPACES.items():
        trials = H.draw(space, 200, 1)
        assert trials == H.draw(space, 200, 1) and trials[:5] == H.draw(space, 5, 1) != H.draw(space, 5, 2)
        for t in trials:
            for k, how in space.items():
                if isinstance(how, (H.Steps, M.LogRange)):
                    assert how.low <= t[k] <= how.high
                elif isinstance(how, tuple) and not isinstance(how, H.PerLayer):
                    assert t[k] in how
            if family == "network":
                assert {k for k in t if k.startswith("dim_")} == {f"dim_{i}" for i in range(t["n_layers"])}
    low = sum(t["C"] < 0.316 for t in H.draw(H.SPACES["logistic"], 400, 3))
    assert 150 < low < 250  # even on the log scale: half below the geometric middle


def test_study_goes_on_where_it_stopped(spark, moons, tmp, monkeypatch):
    from pyspark.ml.functions import array_to_vector
    data = moons.withColumn("features", array_to_vector("features")).withColumn("fold", F.col("fold") % 2).cache()
    calls, real, broken = [], H.fit_family, [1]

    def fit(family, train, held, p, label, seed=42):
        i = H.draw(H.SPACES[family], 3).index(p) if family == "logistic" else None
        calls.append(i)
        if i in broken:
            raise ValueError("lost")
        return real(family, train, held, p, label, seed)
    monkeypatch.setattr(H, "fit_family", fit)
    with pytest.raises(RuntimeError, match=r"\('logistic', 1, 0\), \('logistic', 1, 1\)"):
        H.run_studies(data, {"logistic": 2}, f"{tmp}/study")
    broken.clear()
    small = {**H.SPACES, "forest": {**H.SPACES["forest"], "n_estimators": (3,), "max_depth": (2,)}}
    t = H.run_studies(data, {"logistic": 3, "forest": 1}, f"{tmp}/study", spaces=small)
    assert Counter(calls) == {0: 2, 1: 2 + 2, 2: 2, None: 2}
    rows = sorted(t.collect(), key=lambda r: (r.study, r.trial))
    assert [(r.study, r.trial, r.folds) for r in rows] == [("forest", 0, 2), ("logistic", 0, 2), ("logistic", 1, 2), ("logistic", 2, 2)]
    fits = H.read_fits(spark, f"{tmp}/study").collect()
    for r in rows:
        own = [f for f in fits if (f.study, f.trial) == (r.study, r.trial)]
        assert abs(r.value - M.trial_value([f.value for f in own], [f.recall for f in own])) < 1e-6
    best = {b.study: b for b in H.best_trials(t).collect()}["logistic"]
    own = [r.value for r in rows if r.study == "logistic"]
    assert best.value == max(own) and best.trials == 3
    assert [c.best_so_far for c in H.convergence(t.where("study = 'logistic'")).orderBy("trial").collect()] == [
        max(own[:i + 1]) for i, v in enumerate(own) if v > -1e7]
    assert H.read_trials(spark, f"{tmp}/study-none").count() == 0


def test_the_registered_search_is_the_whole_study(spark, monkeypatch):
    from churnspark.plans import q_ml
    asked = []
    monkeypatch.setattr(q_ml, "study_data", lambda spark, d: None)
    monkeypatch.setattr(H, "run_studies", lambda data, trials, path, **kw: asked.append(dict(trials)))
    q_ml.m8_search(spark, "nowhere")
    assert asked == [{f: 50 for f in ("network", "forest", "gbt", "logistic")}] and set(asked[0]) == set(H.SPACES)
