"""Encoders, splits, folds, models and scoring."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from churnspark import schemas as S
from churnspark.functions import encode as E
from churnspark.operators import models as M
from churnspark.operators import scoring as I
from churnspark.operators import split as V
from churnspark.plans.slice import cleaned_features
from churnspark.session import cut_lineage

from conftest import SF01


@pytest.fixture(scope="module")
def feat(spark):
    return cut_lineage(cleaned_features(spark, SF01))


def test_pop_scaler_and_median_imputer(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,), (9.0,)], "x double")
    m = E.ExactMedianImputer(inputCols=["x"]).fit(df)
    assert m.getOrDefault(m.medians) == [3.0]
    s = E.PopStandardScaler(inputCols=["x"]).fit(m.transform(df))
    import numpy as np
    v = np.array([1, 2, 4, 3, 9.0])
    assert abs(s.getOrDefault(s.stds)[0] - v.std()) < 1e-12


def test_onehot_drop_first_and_unknown(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    m = E.OneHotDropFirst(inputCols=["k"]).fit(df)
    assert m.outputCols() == ["k_b", "k_c"]
    r = m.transform(spark.createDataFrame([("a",), ("c",), ("zz",)], "k string")).collect()
    assert [(x.k_b, x.k_c) for x in r] == [(0.0, 0.0), (0.0, 1.0), (0.0, 0.0)]


def test_preprocessor_width_save_load(spark, feat):
    pm = E.build_preprocessor().fit(feat)
    assert len(E.feature_names(pm)) == S.N_FEATURES
    chk = E.check_vectors(pm.transform(feat)).first()
    assert chk.bad_values == 0 and chk.bad_width == 0
    d = tempfile.mkdtemp(prefix="pm-")
    from churnspark.sources.io import load_pipeline, save_pipeline, verify_reload
    save_pipeline(pm, os.path.join(d, "p"))
    assert verify_reload(pm, load_pipeline(os.path.join(d, "p")), feat, "customerid") <= 1e-10


def test_split_exact_and_repeatable(spark, feat):
    s = V.stratified_split(feat, "churn_value", "customerid", 0.2, 42)
    c = {(r.churn_value, r.split): r["count"] for r in s.groupBy("churn_value", "split").count().collect()}
    n = {r.churn_value: r["count"] for r in feat.groupBy("churn_value").count().collect()}
    for y in n:
        assert c[(y, "test")] == round(n[y] * 0.2 + 1e-9) or abs(c[(y, "test")] - n[y] * 0.2) <= 0.5
        assert c[(y, "test")] + c[(y, "train")] == n[y]
    a = sorted(r.customerid for r in s.where("split = 'test'").collect())
    b = sorted(r.customerid for r in V.stratified_split(feat, "churn_value", "customerid", 0.2, 42)
               .where("split = 'test'").collect())
    assert a == b


def test_folds_cover_everything(spark, feat):
    f = V.stratified_folds(feat, "churn_value", "customerid", 5, 42)
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert sum(sizes) == feat.count() and max(sizes) - min(sizes) <= 2


def test_logistic_beats_auc_floor(spark, feat):
    s = V.stratified_split(feat, "churn_value", "customerid", 0.2, 42)
    pm = E.build_preprocessor().fit(s.where("split = 'train'"))
    x = cut_lineage(pm.transform(s))
    m = M.fit_logistic(x.where("split = 'train'"))
    from churnspark.operators.evaluate import roc_auc
    p = m.transform(x.where("split = 'test'")).select(F.lit("lr").alias("model"), F.col("churn_value").alias("label"),
                                                     M.prob1().alias("score"))
    assert roc_auc(p).first().roc_auc > 0.7


def test_early_stop(spark):
    h = [("r", i, v) for i, v in enumerate([1.0, 0.8, 0.7, 0.71, 0.72, 0.73, 0.69, 0.9])]
    r = M.early_stop(spark.createDataFrame(h, "run string, epoch int, value double"), patience=3,
                     min_delta=0.0).first()
    assert (r.stop_epoch, r.best_epoch_patience, r.best_epoch) == (5, 2, 6)


def test_decide_and_tiers(spark):
    df = spark.createDataFrame([(0.75,), (0.5,), (0.49,), (0.1,)], "p double")
    r = I.decide(df, 0.5, prob="p").collect()
    assert [x.prediction for x in r] == ["churn", "churn", "no_churn", "no_churn"]
    assert [x.action_cost for x in r] == [73.52, 73.52, 0.0, 0.0]
    t = [x.t for x in df.select(I.priority_tier(F.col("p")).alias("t")).collect()]
    assert t == ["high", "medium", "low", "none"]


def test_contact_list_salted_equals_window(spark):
    import random
    rnd = random.Random(1)
    data = [(rnd.choice("ab"), i, rnd.choice([0.1, 0.2, 0.3])) for i in range(400)]
    df = spark.createDataFrame(data, "seg string, id long, score double")
    got = sorted((r.seg, r.id) for r in I.contact_list(df, 7, by="seg", salts=5).collect())
    exp = sorted((s, i) for seg in "ab" for s, i, _ in
                 sorted([(s, i, -sc) for s, i, sc in data if s == seg], key=lambda r: (r[2], r[1]))[:7])
    assert got == exp


def test_resolve_threshold_falls_through(spark):
    d = tempfile.mkdtemp(prefix="thr-")
    bad = os.path.join(d, "bad.json")
    open(bad, "w").write("{not json")
    good = os.path.join(d, "good.json")
    open(good, "w").write('{"test_metrics": {"threshold": 0.16}}')
    assert I.resolve_threshold(spark, [os.path.join(d, "missing.json"), bad, good]) == (0.16, good)
    assert I.resolve_threshold(spark, [bad]) == (0.5, "default")


def test_numpy_forward_matches_spark_network(spark):
    """The NumPy forward pass over Arrow batches reproduces Spark's own
    network probabilities from the fitted weights."""
    import __spark_entry__ as EN
    from conftest import SF001
    r = EN.queries()["i3_mlp_forward"](spark, SF001).agg(F.max("abs_diff").alias("m"), F.count("*").alias("n")).first()
    assert r.n > 0 and r.m < 1e-6


def test_readiness_flags(spark):
    d = tempfile.mkdtemp(prefix="ready-")
    r = I.readiness(spark, d, os.path.join(d, "missing"), "v1", 0.16).first()
    assert (r.model_loaded, r.preprocessor_loaded, r.version, r.threshold) == (True, False, "v1", 0.16)


def test_queries_do_the_whole_fit(spark, monkeypatch):
    from conftest import SF001

    from churnspark.plans import q_ml
    trees, inputs, hidden = [], [], []
    forest, net = M.fit_forest, M.fit_mlp
    monkeypatch.setattr(q_ml.M, "fit_forest", lambda t, label, **k: trees.append(k.get("trees", 200)) or forest(t, label, trees=5))
    monkeypatch.setattr(q_ml.M, "fit_mlp", lambda t, label, **k: hidden.append(k.get("hidden", (128, 64))) or net(t, label, max_iter=5, **k))
    monkeypatch.setattr(q_ml.M, "permutation_importance", lambda f, df, cols, *a: inputs.extend(cols) or f(df).select(*cols).limit(1).collect())
    q_ml.m12_permutation_importance(spark, SF001)
    assert inputs == S.INPUT_FIELDS
    q_ml.m11_importances(spark, SF001)
    assert trees == [200]
    assert q_ml.i3_mlp_forward(spark, SF001).count() == q_ml.feat(spark, SF001).count() and hidden == [(128, 64)]


def test_tables_that_fits_read_use_all_cores(spark, monkeypatch):
    """A table of many rows lies in a part for each core, with all its rows; the split is not computed in a later pass."""
    from conftest import SF001

    from churnspark import session
    from churnspark.plans import q_ml
    cores, n = spark.sparkContext.defaultParallelism, cleaned_features(spark, SF001).count()
    monkeypatch.setattr(session, "DEALT_ROWS", n - 1)
    for part in (lambda f: V.stratified_split(f, q_ml.LABEL, "customerid", 0.2, 42),
                 lambda f: V.stratified_folds(f, q_ml.LABEL, "customerid", 5, 42)):
        x = q_ml.parted(spark, SF001, part)
        sizes = [r["count"] for r in x.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == cores and sum(sizes) == n and max(sizes) < 2 * n / cores
        assert sorted(map(str, x.collect())) == sorted(map(str, part(q_ml.feat(spark, SF001)).collect()))
    for x in (q_ml.study_data(spark, SF001), *q_ml._train_test(spark, SF001)[1:]):
        assert len(x.groupBy(F.spark_partition_id()).count().collect()) == cores
    monkeypatch.setattr(session, "DEALT_ROWS", n)
    assert session.dealt(x, n) is x
