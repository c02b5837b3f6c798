"""The minimum slice: churn rate, size and money at stake per contract and
tenure group, after cleaning (snapshot -> P13/P8/P9/P14/P11/P12 -> F7 ->
event rate + residual value, grouped).  One lazy plan: the orders aggregate
and the customer join are the only shuffles before the final small group-by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.functions.features import add_features
from churnspark.operators.clean import clean_snapshot
from churnspark.sources.tables import snapshot


def cleaned_features(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return add_features(clean_snapshot(snapshot(spark, sf_dir, **kw)))


def churn_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cleaned_features(spark, sf_dir)
    churned = F.col("churn_value") == 1
    return (df.groupBy("contract", "tenure_group")
              .agg(F.count(F.lit(1)).cast("bigint").alias("n_customers"),
                   F.count_if(churned).cast("bigint").alias("n_churned"),
                   F.round(F.avg("churn_value"), 6).alias("churn_rate"),
                   F.round(F.sum(F.when(churned, F.col("monthly_charges")).otherwise(0.0)), 2)
                    .alias("mrr_at_risk"),
                   F.round(F.sum(F.when(churned, F.greatest(F.col("cltv") - F.col("total_charges"),
                                                            F.lit(0.0))).otherwise(0.0)), 2)
                    .alias("residual_clv_at_risk")))
