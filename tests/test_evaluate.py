"""Metric and money rules on the small label/score fixtures."""
from pyspark.sql import functions as F

from churnspark import schemas as S
from churnspark.operators import business as B
from churnspark.operators import evaluate as A


def _scores(spark, labels, scores, model="m"):
    return spark.createDataFrame([(model, i, y, float(s)) for i, (y, s) in enumerate(zip(labels, scores))],
                                 "model string, id long, label int, score double")


def test_separable(spark):
    df = _scores(spark, [0, 0, 1, 1, 0, 1, 0, 1], [.1, .2, .8, .9, .3, .7, .4, .6])
    r = A.rates(A.confusion(df, 0.5)).first()
    assert (r.tp, r.fp, r.tn, r.fn) == (4, 0, 4, 0)
    assert r.precision == r.recall == r.f1 == r.specificity == r.accuracy == 1.0
    assert A.roc_auc(df).first().roc_auc == 1.0
    assert A.average_precision(df).first().average_precision == 1.0


def test_all_false_positive_specificity(spark):
    r = A.rates(A.confusion(_scores(spark, [0, 0, 0, 1], [.9, .9, .9, .95]), 0.5)).first()
    assert r.specificity == 0.0 and r.recall == 1.0


def test_ties_auc_and_average_precision(spark):
    df = _scores(spark, [0, 1, 1, 0, 0, 1, 0, 1], [.1, .4, .35, .8, .4, .4, .2, .9])
    assert abs(A.roc_auc(df).first().roc_auc - 0.6875) < 1e-12
    assert abs(A.average_precision(df).first().average_precision - 0.716667) < 1e-6


def test_auc_symmetry(spark):
    df = _scores(spark, [0, 1, 1, 0, 0, 1, 0, 1, 1], [.1, .4, .35, .8, .4, .4, .2, .9, .35])
    a = A.roc_auc(df).first().roc_auc
    b = A.roc_auc(df.withColumn("score", -F.col("score"))).first().roc_auc
    assert abs(a + b - 1.0) < 1e-12


def test_one_class_auc_is_null(spark):
    assert A.roc_auc(_scores(spark, [1, 1], [.2, .3])).first().roc_auc is None


def test_published_business_value(spark):
    conf = spark.createDataFrame([(368, 393, 640, 4)], "tp long, tn long, fp long, fn long")
    v = conf.select(A.value_expr(S.DEFAULT_COSTS).alias("v")).first().v
    assert round(v, 2) == 1017420.56


def test_cost_annotate_and_infinite_roi(spark):
    conf = spark.createDataFrame([("a", 10, 0, 5, 2), ("b", 0, 0, 0, 0)], "model string, tp long, tn long, fp long, fn long")
    cfg = S.CostConfig(clv=1000.0, retention=50.0, fp_cost=10.0, fn_cost=100.0)
    r = {x.model: x for x in A.tradeoff(conf, cfg).collect()}
    assert r["a"].cost_total == 250.0 and r["a"].churn_avoided == 9500.0
    assert r["b"].roi == float("inf")


def test_best_threshold_slo_and_ties(spark):
    # recall >= 0.7 forces a low threshold even though a higher one earns more per row
    df = _scores(spark, [1, 1, 1, 0, 0, 0], [.9, .8, .2, .1, .1, .1])
    r = A.best_threshold(df, slo=0.7).first()
    assert r.slo_met and r.threshold == 0.11
    assert 0.11 == min(t.threshold for t in A.threshold_table(df).where(
        (F.col("business_value") == r.business_value)).collect())


def test_top_lift_brute_force(spark):
    import random
    rnd = random.Random(2)
    data = [(i, rnd.randint(0, 1), rnd.choice([0.1, 0.5, 0.5, 0.5, 0.9])) for i in range(300)]
    df = spark.createDataFrame([("m", i, y, s) for i, y, s in data], "model string, id long, label int, score double")
    got = B.top_lift(df, 0.1).first()
    k = 30
    top = sorted(data, key=lambda r: (-r[2], r[0]))[:k]
    assert got.k == k and got.top_positives == sum(y for _, y, _ in top)


def test_point_metrics_equal_the_separate_ones(spark):
    import random
    r = random.Random(2)
    rows = [(m, r.choice([0.1, 0.3, 0.5, 0.5, 0.9, None]), r.randint(0, 1)) for m in "ab" for _ in range(300)] + [("one", 0.4, 1)]
    df = spark.createDataFrame(rows, "model string, score double, label int")
    got = {x.model: x for x in A.point_metrics(df, 0.5).collect()}
    conf = {x.model: x for x in A.confusion(df.where("score is not null"), 0.5).collect()}
    auc = {x.model: x.roc_auc for x in A.roc_auc(df).collect()}
    ap = {x.model: x.average_precision for x in A.average_precision(df).collect()}
    assert set(got) == set(conf) == {"a", "b", "one"}
    for m, x in got.items():
        assert [x[c] for c in ("tp", "fp", "tn", "fn")] == [conf[m][c] for c in ("tp", "fp", "tn", "fn")]
        assert x.roc_auc == auc[m] and x.average_precision == ap[m]
    assert got["one"].roc_auc is None


def test_release_decision(spark):
    rows = [("good", 0.70, 0.85, 0.6, 1e6), ("same", 0.70, 0.849, 0.595, 1e6), ("weak", 0.60, 0.90, 0.7, 1e6), ("bad", 0.90, 0.79, 0.9, 1e6),
            ("none", None, 0.9, 0.9, 1e6)]
    df = spark.createDataFrame(rows, "model string, recall double, roc_auc double, f1 double, business_value double")
    old = spark.createDataFrame([(0.845, 0.595)], "roc_auc double, f1 double")
    got = {r.model: (r.decision, r.improves) for r in A.release_decision(df, old).collect()}
    assert got == {"good": ("promote", True), "same": ("hold", False), "weak": ("hold", True), "bad": ("reject", True), "none": ("reject", True)}
    first = {r.model: (r.decision, r.improves) for r in A.release_decision(df).collect()}
    assert first["same"] == ("promote", None) and first["weak"] == ("hold", None)
