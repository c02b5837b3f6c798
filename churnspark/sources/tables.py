"""Input tables: the driver's parquet files, the customer snapshot built from
them, and the derived label/score and event tables the operators consume.

The snapshot is one row per customer: an aggregate of ``orders`` per customer
(one shuffle on the customer key, map-side partial aggregation) joined to
``customer`` on the same key, so the join reuses the aggregate's partitioning
and only ``customer`` is shuffled.  All derived columns are integer
arithmetic so any SQL engine returns the same rows.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = ["region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table (filters/projections are pushed down)."""
    return spark.read.parquet(table_path(sf_dir, name))


def _ym(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c)


def _case(k: Column, pairs, default) -> Column:
    out = None
    for cond, val in pairs:
        out = F.when(cond, F.lit(val)) if out is None else out.when(cond, F.lit(val))
    return out.otherwise(F.lit(default))


def snapshot(spark: SparkSession, sf_dir: str, casing: bool = False) -> DataFrame:
    """Raw customer snapshot (19 inputs + target + CLTV + reason + tied score).

    ``total_charges`` arrives as text (blank when tenure is 0), as in the raw
    customer file.  ``casing=True`` lower-cases the text of every fifth
    customer, for the canonical-spelling operator.
    """
    o = (read_table(spark, sf_dir, "orders")
         .groupBy(F.col("o_custkey").alias("k"))
         .agg(F.count(F.lit(1)).alias("n_orders"),
              F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("rev_cents"),
              F.min("o_orderdate").alias("d0"),
              F.max("o_orderdate").alias("d1")))
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), "c_acctbal", "c_nationkey")
    # a customer without orders is new: tenure 0, no charges yet
    b = (c.join(o, "k", "left")
         .withColumn("tenure_months", F.when(F.col("d1").isNull(), 0).otherwise(
             F.least(_ym(F.col("d1")) - _ym(F.col("d0")), F.lit(72))))
         .withColumn("churn_value", F.when(_ym(F.col("d1")) < 2000 * 12 + 9, 1).otherwise(0)))
    k = F.col("k")
    cv = F.col("churn_value")
    no_net = (k % 9) >= 7
    addon = lambda m, lim: _case(k, [(no_net, "No internet service"), ((k % m) < lim, "Yes")], "No")
    df = b.select(
        k.alias("customerid"),
        F.col("c_nationkey").alias("state"),
        _case(k, [(k % 2 == 0, "Male")], "Female").alias("gender"),
        _case(k, [(k % 6 == 0, "Yes")], "No").alias("senior_citizen"),
        _case(k, [(k % 7 < 3, "Yes")], "No").alias("partner"),
        _case(k, [(k % 13 < 3, "Yes")], "No").alias("dependents"),
        F.col("tenure_months"),
        _case(k, [((k % 10) < 3 + 5 * cv, "Month-to-month"), (k % 3 == 0, "One year")],
              "Two year").alias("contract"),
        _case(k, [(k % 5 < 3, "Yes")], "No").alias("paperless_billing"),
        _case(k, [(k % 4 == 0, "Electronic check"), (k % 4 == 1, "Mailed check"),
                  (k % 4 == 2, "Bank transfer (automatic)")],
              "Credit card (automatic)").alias("payment_method"),
        # decimal arithmetic, as written in SQL, then double
        F.coalesce(F.expr("round(rev_cents / 250000.0 / n_orders, 2)").cast("double"), F.lit(0.0)).alias("monthly_charges"),
        F.when(F.col("tenure_months") == 0, F.lit(" "))
         .otherwise(F.expr("rev_cents div 100000").cast("bigint").cast("string"))
         .alias("total_charges"),
        _case(k, [(k % 10 == 9, "No")], "Yes").alias("phone_service"),
        _case(k, [(k % 10 == 9, "No phone service"), (k % 3 == 1, "Yes")], "No").alias("multiple_lines"),
        _case(k, [(k % 9 < 4, "Fiber optic"), (k % 9 < 7, "DSL")], "No").alias("internet_service"),
        _case(k, [(no_net & (k % 4 != 0), "No internet service"), (k % 11 < 4, "Yes")],
              "No").alias("online_security"),
        addon(17, 7).alias("online_backup"),
        addon(19, 8).alias("device_protection"),
        addon(23, 8).alias("tech_support"),
        addon(29, 14).alias("streaming_tv"),
        addon(31, 15).alias("streaming_movies"),
        cv.alias("churn_value"),
        F.when(cv == 1, "Yes").otherwise("No").alias("churn_label"),
        (F.floor(F.col("c_acctbal") / 2).cast("bigint") + 2000).alias("cltv"),
        F.when(cv == 1, F.lit("Competitor")).alias("churn_reason"),
        F.expr("((k * 7919) % 60 + 30 * churn_value + 5) / 100.0").cast("double").alias("y_score"),
    )
    if casing:
        from churnspark.schemas import CATEGORICAL_INPUTS
        lower = F.col("customerid") % 5 == 0
        df = df.withColumns({c: F.when(lower, F.lower(c)).otherwise(F.col(c))
                             for c in CATEGORICAL_INPUTS})
    return df


def snapshot_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, id, label, score) from the snapshot: the tied vendor-like score."""
    s = snapshot(spark, sf_dir)
    return s.select(F.lit("vendor").alias("model"),
                    F.col("customerid").cast("bigint").alias("id"),
                    F.col("churn_value").cast("int").alias("label"),
                    F.col("y_score").alias("score"))


def lineitem_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, id, label, score) with heavy ties: returned flag vs discount."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.lit("lineitem").alias("model"),
                     (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("id"),
                     F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
                     (F.col("l_discount") * 10).alias("score"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluation input everywhere: (model, id, label, score)."""
    return snapshot_scores(spark, sf_dir).unionByName(lineitem_scores(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def customer_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer-month panel from ``orders``: one row per customer and month
    between its first and last order (at most 73 per customer, a bounded
    expansion), with ``churned`` = 1 in the last month of a churner.

    Columns: month (date, first day), customerid, contract, monthly_charges,
    churned.  Feeds the monthly run-rate, churn-change and MRR monitors."""
    o = (read_table(spark, sf_dir, "orders")
         .groupBy(F.col("o_custkey").alias("customerid"))
         .agg(F.min("o_orderdate").alias("d0"), F.max("o_orderdate").alias("d1")))
    s = snapshot(spark, sf_dir).select("customerid", "contract", "monthly_charges", "churn_value")
    j = s.join(o, "customerid")
    m0 = F.trunc(F.col("d0"), "month")
    m1 = F.trunc(F.col("d1"), "month")
    p = j.withColumn("month", F.explode(F.sequence(m0, m1, F.expr("interval 1 month"))))
    return p.select("month", "customerid", "contract", "monthly_charges",
                    F.when((F.col("churn_value") == 1) & (F.col("month") == m1), 1).otherwise(0)
                    .alias("churned"))
