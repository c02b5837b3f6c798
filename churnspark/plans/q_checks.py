"""Registered queries: results that no SQL can state as numbers, held as
statements that SQL can: p-values against tabled bounds, hashes and seeded draws
by what must hold of them on the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnspark import schemas as S
from churnspark.operators import models as M
from churnspark.operators import monitor as R
from churnspark.operators import profile as D
from churnspark.operators import split as V
from churnspark.plans import sql as Q
from churnspark.plans.q_ml import LABEL, feat
from churnspark.plans.q_monitor import CATS, TAG, ref_cur
from churnspark.plans.q_profile import CAT, CHI_SQL, MW_SQL, NUM
from churnspark.plans.registry import query
from churnspark.sources import io

CRITICAL = "CASE dof " + " ".join(f"WHEN {k} THEN {v!r}" for k, v in enumerate(S.CHI2_05, 1)) + " END"


def _at_5_percent(df):
    return df.select("column", (F.col("p_value") < 0.05).alias("significant"))


query("d15_significant", Q.with_(MW_SQL, """SELECT column, abs((greatest(u0, n_0 * n_1 - u0) - n_0 * n_1 / 2.0 - 0.5)
  / sqrt(n_0 * n_1 / 12.0 * ((n + 1) - ties / (n * (n - 1))))) > 1.959963984540054 AS significant FROM u"""))(
    lambda spark, d: _at_5_percent(D.mann_whitney(feat(spark, d), NUM, with_p=True)))

query("d16_significant", Q.with_(CHI_SQL, f"SELECT column, chi2 > {CRITICAL} AS significant FROM cv"))(
    lambda spark, d: _at_5_percent(D.chi2_assoc(feat(spark, d), CAT, with_p=True)))

query("r3_significant", Q.with_(TAG, f"SELECT column, chi2 > {CRITICAL} AS significant FROM ch"))(
    lambda spark, d: _at_5_percent(R.chi2_drift(*ref_cur(spark, d), CATS, with_p=True)))


@query("s10_same_content", Q.with_(Q.FEAT, """SELECT CAST(count(*) AS BIGINT) AS rows, true AS same_shuffled, false AS same_changed,
  round(avg(CAST(churn_value AS DOUBLE)), 6) AS positive_rate FROM feat"""))
def s10_same_content(spark, d):
    """The fingerprint of the table equals that of its rows in another order,
    and not that of the table with one value changed."""
    f = feat(spark, d).select("customerid", "contract", "tenure_months", "monthly_charges", LABEL)
    least = f.agg(F.min("customerid").alias("least"))  # one row
    changed = f.join(F.broadcast(least)).withColumn("tenure_months", F.when(
        F.col("customerid") == F.col("least"), F.col("tenure_months") + 1).otherwise(F.col("tenure_months"))).drop("least")
    one, two, three = (io.fingerprint(x, LABEL).withColumnsRenamed({c: f"{c}_{i}" for c in ("rows", "cols", "content_hash", "positive_rate")})
                       for i, x in enumerate((f, f.repartition("contract", "customerid"), changed)))
    return one.join(F.broadcast(two)).join(F.broadcast(three)).select(  # one row each
        F.col("rows_0").alias("rows"), (F.col("content_hash_0") == F.col("content_hash_1")).alias("same_shuffled"),
        (F.col("content_hash_0") == F.col("content_hash_2")).alias("same_changed"), F.round("positive_rate_0", 6).alias("positive_rate"))


@query("v9_sample_holds", Q.with_(Q.FEAT, """SELECT CAST(least(count(*), 100) AS BIGINT) AS rows, CAST(least(count(*), 100) AS BIGINT) AS ids,
  CAST(0 AS BIGINT) AS strangers, CAST(0 AS BIGINT) AS changed FROM feat"""))
def v9_sample_holds(spark, d):
    """V9: a sample of 100 has so many different customers, all of the table, and a repeated draw from other partitions is the same."""
    f = feat(spark, d)
    one = V.sample_n(f, 100, "customerid", 42).select("customerid")
    again = V.sample_n(f.repartition(7, "contract"), 100, "customerid", 42).select(F.col("customerid").alias("again"))
    j = one.join(again, F.col("customerid") == F.col("again"), "full").join(
        f.select(F.col("customerid").alias("known")), F.coalesce("customerid", "again") == F.col("known"), "left")
    return j.agg(F.count("customerid").cast("bigint").alias("rows"), F.countDistinct("customerid").cast("bigint").alias("ids"),
                 F.count_if(F.col("known").isNull()).cast("bigint").alias("strangers"),
                 F.count_if(F.col("customerid").isNull() | F.col("again").isNull()).cast("bigint").alias("changed"))


@query("m2_dummy_holds", Q.with_(Q.FEAT, """SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS other_scores,
  true AS near_the_rate, CAST(0 AS BIGINT) AS changed FROM feat"""))
def m2_dummy_holds(spark, d):
    """M2: the stratified draws are 0 or 1, 1 as often as the label is (to four standard errors), and the same when drawn again."""
    f = feat(spark, d)
    dummy = M.fit_dummy(f, LABEL, "stratified")
    again = dummy(f.repartition(5, "contract")).select("customerid", F.col("score").alias("again"))
    j = dummy(f).join(again, "customerid", "full")
    rate = F.avg(F.col(LABEL).cast("double"))
    return j.agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.count_if(~F.col("score").isin(0.0, 1.0)).cast("bigint").alias("other_scores"),
                 (F.abs(F.avg("score") - rate) < 4 * F.sqrt(rate * (1 - rate) / F.count(F.lit(1)))).alias("near_the_rate"),
                 F.count_if(~F.col("score").eqNullSafe(F.col("again"))).cast("bigint").alias("changed"))
