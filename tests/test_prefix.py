"""The physical patterns: bucketed prefix sums, exact quantiles, grid sweep."""
import random

import numpy as np
from pyspark.sql import functions as F

from churnspark.operators import prefix
from churnspark.operators.prefix import Grid, cumulative, exact_quantiles, long_form, sweep


def test_cumulative_matches_brute_force(spark):
    rnd = random.Random(3)
    data = [(rnd.choice("ab"), rnd.randint(0, 50) / 7.0, rnd.randint(0, 3)) for _ in range(600)]
    df = spark.createDataFrame(data, "k string, v double, w int")
    got = {(r["k"], r["v"]): (r["w"], r["cum_w"]) for r in
           cumulative(df, ["k"], "v", {"w": F.col("w").cast("bigint")}, buckets=7).collect()}
    for k in "ab":
        vals = sorted({v for kk, v, _ in data if kk == k})
        run = 0
        for v in vals:
            s = sum(w for kk, vv, w in data if kk == k and vv == v)
            run += s
            assert got[(k, v)] == (s, run)


def test_cumulative_descending_and_no_keys(spark):
    df = spark.createDataFrame([(float(x),) for x in [5, 1, 3, 3, 9]], "v double")
    got = {r["v"]: r["cum_n"] for r in cumulative(df, None, "v", {"n": F.lit(1).cast("bigint")},
                                                    descending=True, buckets=2).collect()}
    assert got == {9.0: 1, 5.0: 2, 3.0: 4, 1.0: 5}


def test_exact_quantiles_equal_numpy(spark):
    rnd = random.Random(5)
    vals = [rnd.gauss(0, 3) for _ in range(501)] + [2.0] * 40
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    r = exact_quantiles(df, None, "x", [0.1, 0.25, 0.5, 0.75, 0.9], buckets=16).first()
    for p, name in [(0.1, "q10"), (0.25, "q25"), (0.5, "q50"), (0.75, "q75"), (0.9, "q90")]:
        assert abs(r[name] - np.percentile(vals, p * 100)) < 1e-9
    assert r["n"] == len(vals)


def test_median_of_1_2_4_9_is_3(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,)], "x double")
    assert exact_quantiles(df, None, "x", [0.5], ["m"]).first()["m"] == 3.0


def test_grid_points_are_exact_on_boundaries(spark):
    g = Grid.percent(5, 93)
    pts = g.points()
    assert len(pts) == 89 and pts[11] == 0.16
    scores = [0.29, 0.16, 0.05, 0.049999, 0.93, 0.95, 0.57, 0.0, 1.0]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    got = [r["k"] for r in df.select(g.count_le(F.col("s")).alias("k")).collect()]
    assert got == [sum(1 for p in pts if p <= s) for s in scores]
    lg = Grid.linspace(0.01, 0.99, 200)
    lp = list(np.linspace(0.01, 0.99, 200))
    assert lg.points() == lp
    got = [r["k"] for r in spark.createDataFrame([(float(p),) for p in lp[::7]], "s double")
           .select(lg.count_le(F.col("s")).alias("k")).collect()]
    assert got == [sum(1 for q in lp if q <= p) for p in lp[::7]]


def test_sweep_equals_direct_filters(spark):
    rnd = random.Random(11)
    data = [("m", i, rnd.randint(0, 1), round(rnd.random(), 2)) for i in range(400)]
    df = spark.createDataFrame(data, "model string, id long, label int, score double")
    s = {round(r["threshold"], 2): r for r in sweep(df, Grid.percent(5, 93)).collect()}
    for t in (0.05, 0.16, 0.5, 0.93):
        tp = sum(1 for *_, y, sc in data if sc >= t and y == 1)
        fp = sum(1 for *_, y, sc in data if sc >= t and y == 0)
        assert (s[t]["tp"], s[t]["fp"]) == (tp, fp)
        assert s[t]["tp"] + s[t]["fp"] + s[t]["tn"] + s[t]["fn"] == len(data)


def test_long_form(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert sorted(tuple(r) for r in long_form(df, ["a", "b"]).collect()) == [("a", 1.0), ("b", 2.0)]


def test_no_single_partition_exchange_in_auc_plan(spark):
    """The large side is never moved to one partition: rows are windowed
    inside (model, bucket), and with a real model column no exchange is
    SinglePartition at all."""
    from churnspark.operators.evaluate import roc_auc
    df = spark.range(1000).select(F.concat(F.lit("m"), (F.col("id") % 2).cast("string")).alias("model"),
                                  (F.col("id") % 3 == 0).cast("int").alias("label"),
                                  (F.col("id") / 1000.0).alias("score"))
    plan = roc_auc(df)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "hashpartitioning(model" in plan and "_b" in plan


def test_flagship_scans_are_pruned(spark):
    """Projection pruning reaches the parquet scans: orders and customer are
    read with only the columns the snapshot uses."""
    import re
    import __spark_entry__ as E
    plan = E.entry(spark)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas, plan[:500]
    for s in schemas:
        cols = {c.split(":")[0] for c in s.split(",")}
        assert cols <= {"o_custkey", "o_totalprice", "o_orderdate", "c_custkey", "c_acctbal", "c_nationkey"}, cols


def test_buckets_follow_the_rows(spark):
    """Ten times the rows: ten times the buckets, not larger ones; outliers, nulls and short keys included."""
    rnd = random.Random(9)
    for n in (500, 5000):
        rows = [("a", rnd.gauss(0, 1)) for _ in range(n)] + [("a", 1e300), ("a", -1e300), ("b", 1.0), (None, 2.0)]
        df = spark.createDataFrame(rows, "k string, v double")
        sizes = {(r.k, r._b): r["count"] for r in prefix.bucketed(df, ["k"], F.col("v"), rows=100).groupBy("k", "_b").count().collect()}
        assert max(sizes.values()) <= 130
        assert (n + 2 + 99) // 100 - 1 <= len([1 for k, _ in sizes if k == "a"]) <= 2 * (n + 2 + 99) // 100
        assert sizes["b", 0] == sizes[None, 0] == 1


def test_buckets_have_a_limit_and_keep_the_order(spark, monkeypatch):
    monkeypatch.setattr(prefix, "BUCKET_ROWS", 3)
    monkeypatch.setattr(prefix, "MAX_BUCKETS", 50)
    vals = [float(i * i) for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    b = [r._b for r in prefix.bucketed(df.withColumn("k", F.lit(1)), ["k"], F.col("v")).orderBy("v").collect()]
    assert b == sorted(b) and set(b) == set(range(50)) and max(b.count(x) for x in set(b)) <= 25
    for desc in (False, True):
        c = cumulative(df, None, "v", {"n": F.lit(1), "s": F.col("v").cast("bigint")}, descending=desc).orderBy("v", ascending=not desc).collect()
        assert [r.cum_n for r in c] == list(range(1, 1001)) and {r.all_n for r in c} == {1000}
        assert c[-1].cum_s == c[0].all_s == sum(map(int, vals))


def test_one_hot_takes_its_own_columns_only(spark):
    import pytest
    from churnspark.functions import encode as E
    df = spark.createDataFrame([("a", 7.0), ("b", 8.0), (None, 9.0)], "c string, c_other double")
    model = E.build_preprocessor(num=[], binary=[], onehot=["c"], passthrough=["c_other"])
    stages = model.getStages()[4:]
    from pyspark.ml import Pipeline
    fitted = Pipeline(stages=stages).fit(df)
    assert E.feature_names(fitted) == ["c_b", "c_other"]
    with pytest.raises(ValueError, match="more than 1 categories"):
        E.OneHotDropFirst(inputCols=["c"], maxCategories=1).fit(df)
