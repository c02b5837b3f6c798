"""Limits named by the last review: tails, null keys, outliers, large counts, registration."""
import re

import __spark_entry__ as E
from pyspark.sql import functions as F

from churnspark.functions.stats import ks_sf
from churnspark.operators import clean as C
from churnspark.operators import evaluate, monitor, prefix


def test_ks_tail_is_monotone_and_one_at_zero():
    p = [ks_sf(d / 2000, 1e4) for d in range(1, 200)]
    assert ks_sf(1e-5, 1e4) == ks_sf(1e-4, 1e4) == 1.0
    assert all(a >= b - 1e-12 for a, b in zip(p, p[1:])) and p[0] > 0.999 and p[-1] < 1e-6


def test_an_outlier_does_not_fill_one_bucket(spark, monkeypatch):
    df = spark.range(20_000).select(F.when(F.col("id") == 0, 1e9).otherwise(F.col("id")).cast("double").alias("v"))
    cuts = df.agg(F.percentile_approx("v", [i / 64 for i in range(1, 64)], 1280).alias("c"))
    sizes = [r["count"] for r in df.crossJoin(F.broadcast(cuts)).groupBy(F.size(F.filter("c", lambda c: c < F.col("v")))).count().collect()]
    assert len(sizes) == 64 and max(sizes) <= 2 * 20_000 / 64
    last = prefix.cumulative(df, None, "v", {"n": F.lit(1)}).orderBy(F.col("v").desc()).first()
    assert last.v == 1e9 and last.cum_n == 20_000


def test_null_keys_and_null_order_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 5.0), (None, 7.0), (None, None), ("a", float("nan"))], "g string, v double")
    got = {r.g: (r.n, r.q50) for r in prefix.exact_quantiles(df, "g", "v", [0.5]).collect()}
    assert got == {"a": (2, 1.5), None: (2, 6.0)}


def test_auc_of_very_large_counts(spark):
    rows = [("m", 0.9, 3_000_000_000, 1_000_000_000), ("m", 0.1, 2_000_000_000, 4_000_000_000)]
    pts = spark.createDataFrame(rows, "model string, score double, pos long, neg long")
    real = evaluate.score_points
    try:
        evaluate.score_points = lambda df, keys, **kw: df.selectExpr(
            "model", "score", "pos", "neg", "sum(pos) over (order by score desc) tp", "sum(neg) over (order by score desc) fp",
            "sum(pos) over () P", "sum(neg) over () N")
        auc = evaluate.roc_auc(pts, ["model"]).first().roc_auc
    finally:
        evaluate.score_points = real
    assert abs(auc - (3 * 4 + 0.5 * (3 * 1 + 2 * 4)) / 25) < 1e-12


def test_raw_headers_lose_the_customer_id(spark):
    raw = spark.createDataFrame([(1, "x", 2)], "`CustomerID` int, `Lat Long` string, `Tenure Months` int")
    assert C.drop_leakage(C.snake_columns(raw)).columns == ["tenure_months"]
    assert [C.to_snake(x) for x in (" CLTV ", "Zip-Code", "monthlyCharges2Pay", "__a  b_")] == [
        "cltv", "zip_code", "monthly_charges2_pay", "a_b"]


def test_a_gap_in_the_calendar_ends_a_streak(spark):
    df = spark.sql("SELECT * FROM VALUES (1, timestamp'2024-01-01', true), (1, timestamp'2024-01-02', true), "
                   "(1, timestamp'2024-01-04', true), (1, timestamp'2024-01-05', true) t(s, day, bad)")
    out = monitor.streak(df, "s", "day", F.col("bad")).orderBy("day").collect()
    assert [r.streak_alert for r in out] == [False, True, False, True]


def test_every_decorated_query_is_registered():
    names = set(E.queries())
    assert {"r16_streak", "r17_retrain_decision", "r20_campaign_monitor", "r21_auc_decay"} <= names
    with open(monitor.__file__.replace("operators/monitor.py", "plans/q_monitor.py")) as f:
        assert set(re.findall(r'query\("(\w+)"', f.read())) <= names
