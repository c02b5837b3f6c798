"""Profiling and statistics.

Every profile runs on the long form ``(keys..., column, value)`` built once by
``stack``, so one aggregate covers all columns.  Medians and quartiles use the
distributed exact quantile (no group gathered into one task); rank tests use
distributed prefix counts; only k x k matrices (k = number of columns) and
per-column statistics ever reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.functions.features import numpy_round
from churnspark.functions.stats import chi2_p, two_sided_normal_p
from churnspark.operators.prefix import cumulative, exact_quantiles, long_form


def _keys(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def numeric_long(df: DataFrame, cols: Sequence[str], by=None) -> DataFrame:
    return long_form(df, cols, keep=_keys(by)).where(F.col("value").isNotNull())


# ---------------------------------------------------------------- D1, D2
def missing_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and % per column, only columns with nulls."""
    cols = list(cols or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])
    lf = long_form(one, cols, keep=["_n"], value_type="bigint", value="n_missing")
    return lf.where(F.col("n_missing") > 0).select(
        "column", "n_missing", (F.col("n_missing") * 100.0 / F.col("_n")).alias("pct_missing"))


def target_balance(df: DataFrame, label: str = "churn_value", threshold: float = 0.5) -> DataFrame:
    """Class counts, %, minority/majority ratio, imbalance flag (< threshold)."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    tot = g.agg(F.sum("n").alias("_tot"), F.min("n").alias("_mn"), F.max("n").alias("_mx"))
    # tot is one row: broadcast
    j = g.withColumn("_j", F.lit(1)).join(F.broadcast(tot.withColumn("_j", F.lit(1))), "_j")
    ratio = F.col("_mn") / F.col("_mx")
    return j.select(F.col(label).alias("label"), "n", (F.col("n") * 100.0 / F.col("_tot")).alias("pct"),
                    ratio.alias("minority_ratio"), (ratio < threshold).alias("imbalanced"))


# ---------------------------------------------------------------- D3-D7, D12
def numeric_profile(df: DataFrame, cols: Sequence[str], by=None) -> DataFrame:
    """N, mean, median, sample std, min, max, Q1, Q3, IQR, fences."""
    keys = [*_keys(by), "column"]
    lf = numeric_long(df, cols, by)
    basic = lf.groupBy(*keys).agg(
        F.count("value").cast("bigint").alias("n"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    q = exact_quantiles(lf, keys, "value", [0.25, 0.5, 0.75], ["q1", "median", "q3"]).drop("n")
    iqr = F.col("q3") - F.col("q1")
    return basic.join(q, keys).select(
        *keys, "n", "mean", "median", "std", "min", "max", "q1", "q3", iqr.alias("iqr"),
        (F.col("q1") - 1.5 * iqr).alias("lower_fence"), (F.col("q3") + 1.5 * iqr).alias("upper_fence"))


def iqr_outliers(df: DataFrame, cols: Sequence[str], by=None) -> DataFrame:
    """Values outside the IQR fences, count and %."""
    keys = [*_keys(by), "column"]
    fences = numeric_profile(df, cols, by).select(*keys, "lower_fence", "upper_fence")
    lf = numeric_long(df, cols, by).join(fences, keys)   # one row per column and group: the planner measures it
    out = (F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence"))
    return lf.groupBy(*keys).agg(F.count_if(out).cast("bigint").alias("n_outliers"),
                                 (F.count_if(out) * 100.0 / F.count(F.lit(1))).alias("pct_outliers"))


def z_outliers(df: DataFrame, cols: Sequence[str], by=None, z: float = 3.0) -> DataFrame:
    """|z| > 3 with the population standard deviation."""
    keys = [*_keys(by), "column"]
    lf = numeric_long(df, cols, by)
    st = lf.groupBy(*keys).agg(F.avg("value").alias("_mu"), F.stddev_pop("value").alias("_sd"))
    j = lf.join(st, keys)
    out = F.coalesce(F.abs(F.try_divide(F.col("value") - F.col("_mu"), F.col("_sd"))) > z, F.lit(False))
    return j.groupBy(*keys).agg(F.count_if(out).cast("bigint").alias("n_outliers"),
                                (F.count_if(out) * 100.0 / F.count(F.lit(1))).alias("pct_outliers"))


def edge_bin(v: Column, lo: Column, hi: Column, n: int, right_closed: bool = False) -> Column:
    """Bin index in 0..n-1 for equal-width edges e_i = i*(hi-lo)/n + lo.

    Left-closed bins (NumPy histogram: last bin also closed) when
    ``right_closed`` is false; right-closed bins (pandas ``cut``) otherwise.
    A first guess from the width is corrected against the exact edges."""
    step = (hi - lo) / F.lit(float(n))
    e = lambda i: i.cast("double") * step + lo
    g = F.least(F.greatest(F.floor((v - lo) / step), F.lit(0)), F.lit(n - 1)).cast("bigint")
    if right_closed:
        g = (F.when((g >= 1) & (e(g) >= v), g - 1)
             .when((g <= n - 2) & (e(g + 1) < v), g + 1).otherwise(g))
    else:
        g = (F.when((g >= 1) & (e(g) > v), g - 1)
             .when((g <= n - 2) & (e(g + 1) <= v), g + 1).otherwise(g))
    return F.when(hi > lo, g).otherwise(F.lit(0)).cast("int")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30, by=None,
              density: bool = False) -> DataFrame:
    """Equal-width histogram per column (and group), NumPy bin rule."""
    keys = [*_keys(by), "column"]
    lf = numeric_long(df, cols, by)
    rng = lf.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"),
                                F.count(F.lit(1)).alias("_n"))
    j = lf.join(rng, keys)
    b = edge_bin(F.col("value"), F.col("lo"), F.col("hi"), bins)
    h = j.groupBy(*keys, b.alias("bin"), "lo", "hi", "_n").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    left = F.col("bin").cast("double") * step + F.col("lo")
    right = F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(
        (F.col("bin") + 1).cast("double") * step + F.col("lo"))
    out = h.select(*keys, "bin", left.alias("bin_left"), right.alias("bin_right"), "count",
                   (F.col("count") / (F.col("_n") * step)).alias("density") if density else F.lit(None)
                   .cast("double").alias("density"))
    return out if density else out.drop("density")


def box_stats(df: DataFrame, cols: Sequence[str], by=None) -> DataFrame:
    """Box-plot numbers: quartiles and whiskers (extreme points within fences)."""
    keys = [*_keys(by), "column"]
    p = numeric_profile(df, cols, by)
    lf = numeric_long(df, cols, by).join(
        p.select(*keys, "lower_fence", "upper_fence"), keys)
    wh = lf.groupBy(*keys).agg(
        F.min(F.when(F.col("value") >= F.col("lower_fence"), F.col("value"))).alias("whisker_low"),
        F.max(F.when(F.col("value") <= F.col("upper_fence"), F.col("value"))).alias("whisker_high"))
    return p.select(*keys, "q1", "median", "q3").join(wh, keys)


# ---------------------------------------------------------------- D8-D10
def _label(c: Column, neg: str, mid: str, pos: str, t: float = 0.5) -> Column:
    return F.when(F.abs(c) < t, F.lit(mid)).when(c > 0, F.lit(pos)).otherwise(F.lit(neg))


def shape_stats(df: DataFrame, cols: Sequence[str], by=None) -> DataFrame:
    """Unbiased skewness G1 and excess kurtosis G2 (pandas rule) + labels.

    Spark's ``skewness``/``kurtosis`` are the population g1/g2; corrected by
    G1 = g1*sqrt(n(n-1))/(n-2), G2 = (n-1)/((n-2)(n-3))*((n+1)*g2 + 6)."""
    keys = [*_keys(by), "column"]
    lf = numeric_long(df, cols, by)
    g = lf.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("n"),
                              F.skewness("value").alias("g1"), F.kurtosis("value").alias("g2"))
    n = F.col("n")
    G1 = F.try_divide(F.col("g1") * F.sqrt(n * (n - 1)), n - 2)
    G2 = F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)
    return g.select(*keys, n.cast("bigint").alias("n"), G1.alias("skewness"), G2.alias("kurtosis"),
                    _label(G1, "left-skewed", "symmetric", "right-skewed").alias("skew_label"),
                    _label(G2, "platykurtic", "mesokurtic", "leptokurtic").alias("kurtosis_label"))


def normality(df: DataFrame, cols: Sequence[str], alpha: float = 0.05, by=None) -> DataFrame:
    """D9 (re-aimed): Jarque-Bera on all rows from population moments;
    p = exp(-JB/2) (chi-square, 2 dof), normal iff p > alpha."""
    keys = [*_keys(by), "column"]
    lf = numeric_long(df, cols, by)
    g = lf.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("n"),
                              F.skewness("value").alias("g1"), F.kurtosis("value").alias("g2"))
    jb = F.col("n") / 6.0 * (F.col("g1") * F.col("g1") + F.col("g2") * F.col("g2") / 4.0)
    return g.select(*keys, jb.alias("jarque_bera"), F.exp(-jb / 2.0).alias("p_value"),
                    (F.exp(-jb / 2.0) > alpha).alias("normal"))


def normal_curve(df: DataFrame, cols: Sequence[str], points: int = 100, by=None) -> DataFrame:
    """Fitted normal density at ``points`` equally spaced x in [min, max]
    (mean and sample std of the data)."""
    keys = [*_keys(by), "column"]
    st = numeric_long(df, cols, by).groupBy(*keys).agg(
        F.avg("value").alias("mu"), F.stddev_samp("value").alias("sd"),
        F.min("value").alias("lo"), F.max("value").alias("hi"))
    x = st.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    step = (F.col("hi") - F.col("lo")) / F.lit(float(points - 1))
    xv = F.when(F.col("i") == points - 1, F.col("hi")).otherwise(F.col("i").cast("double") * step + F.col("lo"))
    x = x.withColumn("x", xv)
    pdf = F.exp(-F.pow(F.col("x") - F.col("mu"), 2) / (2 * F.col("sd") * F.col("sd"))) / (
        F.col("sd") * F.lit(float(np.sqrt(2 * np.pi))))
    return x.select(*keys, "i", "x", pdf.alias("density"))


# ---------------------------------------------------------------- D11
def category_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per (column, value): count, % (1 decimal, NumPy rounding), and per
    column: #categories, dominant, minority, rare (< 1%), concentration > 80%,
    uniform share.  Ties for dominant/minority go to the smaller value."""
    lf = long_form(df, cols, value_type="string").where(F.col("value").isNotNull())
    g = lf.groupBy("column", "value").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    per = g.groupBy("column").agg(
        F.sum("count").alias("_tot"), F.count(F.lit(1)).cast("bigint").alias("n_categories"),
        F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("dominant"),
        F.min_by("value", F.struct(F.col("count"), F.col("value"))).alias("minority"),
        F.max("count").alias("_mx"))
    j = g.join(F.broadcast(per), "column")    # one row per profiled column
    pct = numpy_round(F.col("count") * 100.0 / F.col("_tot"), 1)
    return j.select(
        "column", "value", "count", pct.alias("pct"), "n_categories",
        (F.col("value") == F.col("dominant")).alias("is_dominant"),
        (F.col("value") == F.col("minority")).alias("is_minority"),
        (pct < 1.0).alias("is_rare"),
        (numpy_round(F.col("_mx") * 100.0 / F.col("_tot"), 1) > 80.0).alias("high_concentration"),
        numpy_round(100.0 / F.col("n_categories"), 1).alias("uniform_pct"))


# ---------------------------------------------------------------- D13-D16
def effect_label_d(d: Column) -> Column:
    a = F.abs(d)
    return (F.when(a < 0.2, "negligible").when(a < 0.5, "small").when(a < 0.8, "medium")
            .otherwise("large"))


def cohens_d(df: DataFrame, cols: Sequence[str], label: str = "churn_value") -> DataFrame:
    """(mean1 - mean0) / sqrt((s0^2 + s1^2)/2) with sample std; 0 if pooled is 0."""
    lf = numeric_long(df, cols, label)
    y = F.col(label) == 1
    g = lf.groupBy("column").agg(
        F.avg(F.when(y, F.col("value"))).alias("mean_1"), F.avg(F.when(~y, F.col("value"))).alias("mean_0"),
        F.stddev_samp(F.when(y, F.col("value"))).alias("std_1"),
        F.stddev_samp(F.when(~y, F.col("value"))).alias("std_0"))
    pooled = F.sqrt((F.col("std_0") * F.col("std_0") + F.col("std_1") * F.col("std_1")) / 2)
    d = F.when(pooled > 0, (F.col("mean_1") - F.col("mean_0")) / pooled).otherwise(F.lit(0.0))
    return g.select("column", "mean_0", "mean_1", "std_0", "std_1", d.alias("cohens_d"),
                    effect_label_d(d).alias("effect"))


def target_corr(df: DataFrame, cols: Sequence[str], label: str = "churn_value") -> DataFrame:
    """Pearson (point-biserial) correlation with the target, one aggregate."""
    lf = numeric_long(df, cols, label)
    return lf.groupBy("column").agg(F.corr("value", F.col(label).cast("double")).alias("r")) \
             .withColumn("abs_r", F.abs("r"))


def mann_whitney(df: DataFrame, cols: Sequence[str], label: str = "churn_value",
                 with_p: bool = False) -> DataFrame:
    """Mann-Whitney U of group 0 vs group 1 (U of the first sample),
    tie-corrected normal z with continuity 0.5, two-sided.

    Average ranks come from distributed prefix counts over distinct values,
    so a column with one huge tie group costs one row."""
    lf = numeric_long(df, cols, label)
    y = F.col(label).cast("bigint")
    c = cumulative(lf, ["column"], "value", {"t": F.lit(1).cast("bigint"), "n1": y})
    avg_rank = F.col("prev_t") + (F.col("t") + 1) / 2.0
    g = c.groupBy("column").agg(
        F.sum("t").cast("double").alias("n"), F.sum("n1").cast("double").alias("n_1"),
        F.sum(avg_rank * (F.col("t") - F.col("n1"))).alias("r0"),
        F.sum(F.pow(F.col("t").cast("double"), 3) - F.col("t")).alias("ties"))
    n, n1 = F.col("n"), F.col("n_1")
    n0 = n - n1
    u0 = F.col("r0") - n0 * (n0 + 1) / 2
    u = F.greatest(u0, n0 * n1 - u0)
    sd = F.sqrt(n0 * n1 / 12.0 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    z = (u - n0 * n1 / 2.0 - 0.5) / sd
    out = g.select("column", n0.cast("bigint").alias("n_0"), n1.cast("bigint").alias("n_1"),
                   u0.alias("u_statistic"), z.alias("z"))
    return out.withColumn("p_value", two_sided_normal_p(F.col("z"))) if with_p else out


def effect_label_v(v: Column) -> Column:
    return (F.when(v < 0.1, "negligible").when(v < 0.3, "weak").when(v < 0.5, "moderate")
            .otherwise("strong"))


def chi2_assoc(df: DataFrame, cols: Sequence[str], label: str = "churn_value",
               yates: bool = True, with_p: bool = False) -> DataFrame:
    """Chi-square of independence (category x label 0/1), dof, Yates
    correction when dof = 1, Cramer's V from the same statistic."""
    lf = long_form(df, cols, keep=[label], value_type="string").where(F.col("value").isNotNull())
    y = F.col(label) == 1
    obs = lf.groupBy("column", "value").agg(F.count_if(~y).cast("double").alias("o0"),
                                            F.count_if(y).cast("double").alias("o1"))
    tot = obs.groupBy("column").agg(F.sum("o0").alias("c0"), F.sum("o1").alias("c1"),
                                    F.count(F.lit(1)).alias("r"))
    j = obs.join(F.broadcast(tot), "column")     # one row per column
    n = F.col("c0") + F.col("c1")
    row = F.col("o0") + F.col("o1")
    dof = F.col("r") - 1

    def term(o, cl):
        e = row * F.col(cl) / n
        dev = F.abs(F.col(o) - e)
        if yates:   # Yates continuity correction only for one degree of freedom
            dev = F.when(dof == 1, F.abs(dev - 0.5)).otherwise(dev)
        return F.when(e > 0, dev * dev / e).otherwise(F.lit(0.0))

    g = j.groupBy("column").agg(F.sum(term("o0", "c0") + term("o1", "c1")).alias("chi2"),
                                F.first(dof).cast("bigint").alias("dof"), F.first(n).alias("n"))
    v = F.when(F.col("dof") > 0, F.sqrt(F.col("chi2") / F.col("n") / F.least(F.col("dof"), F.lit(1))))\
         .otherwise(F.lit(0.0))
    out = g.select("column", "chi2", "dof", v.alias("cramers_v"), effect_label_v(v).alias("effect"))
    return out.withColumn("p_value", chi2_p(F.col("chi2"), F.col("dof"))) if with_p else out


# ---------------------------------------------------------------- D17, D18
def event_rate(df: DataFrame, cols: Sequence[str] | str, label: str = "churn_value",
               mode: str = "group") -> DataFrame:
    """Crosstab and event rate per category; ``mode`` = group / rollup / cube
    for multi-key segments."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    gb = {"group": df.groupBy, "rollup": df.rollup, "cube": df.cube}[mode](*cols)
    y = F.col(label) == 1
    return gb.agg(F.count_if(~y).cast("bigint").alias("n_0"), F.count_if(y).cast("bigint").alias("n_1"),
                  F.count(F.lit(1)).cast("bigint").alias("n"),
                  (F.count_if(y) / F.count(F.lit(1))).alias("event_rate"))


def binned_rate(df: DataFrame, cols: Sequence[str], label: str = "churn_value",
                bins: int = 10) -> DataFrame:
    """Event rate by equal-width right-closed bins (pandas ``cut``: the
    low edge is stretched by 0.1% of the range) with bin centres."""
    lf = numeric_long(df, cols, label)
    rng = lf.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    j = lf.join(F.broadcast(rng), "column")
    b = edge_bin(F.col("value"), F.col("lo"), F.col("hi"), bins, right_closed=True)
    g = j.groupBy("column", b.alias("bin"), "lo", "hi").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.avg(F.col(label).cast("double")).alias("event_rate"))
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    left = F.when(F.col("bin") == 0, F.col("lo") - (F.col("hi") - F.col("lo")) * 0.001).otherwise(
        F.col("bin").cast("double") * step + F.col("lo"))
    right = F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(
        (F.col("bin") + 1).cast("double") * step + F.col("lo"))
    return g.select("column", "bin", left.alias("bin_left"), right.alias("bin_right"),
                    ((left + right) / 2).alias("center"), "n", "event_rate")


# ---------------------------------------------------------------- D19-D22, D25
def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation for all pairs, one aggregate."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[(F.lit(1.0) if a == b else F.corr(F.col(a).cast("double"), F.col(b).cast("double")))
                   .alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    rows = []
    for i, (a, b) in enumerate(pairs):
        rows.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{i}").alias("r")))
        if a != b:
            rows.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"{i}").alias("r")))
    return one.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def high_corr_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.7,
                    exclude: Sequence[str] = ("churn_value",)) -> DataFrame:
    """Pairs with |r| >= threshold (a < b), target excluded."""
    m = corr_matrix(df, [c for c in cols if c not in exclude])
    return m.where((F.col("a") < F.col("b")) & (F.abs("r") >= threshold)).withColumn("abs_r", F.abs("r"))


def gram(df: DataFrame, cols: Sequence[str], intercept: bool = False) -> tuple[list[str], np.ndarray]:
    """X'X over complete rows: one aggregate of k(k+1)/2 sums; k x k on the driver."""
    cols = list(cols)
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    if intercept:
        x = x.withColumn("const", F.lit(1.0))
        cols = cols + ["const"]
    idx = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    r = x.agg(*[F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"g{i}_{j}") for i, j in idx]).first()
    g = np.zeros((len(cols), len(cols)))
    for i, j in idx:
        g[i, j] = g[j, i] = r[f"g{i}_{j}"]
    return cols, g


def vif(df: DataFrame, cols: Sequence[str], intercept: bool = False,
        drop: Sequence[str] = ()) -> DataFrame:
    """Variance inflation factors (uncentred by default, as the
    original: VIF_i = G_ii * inv(G)_ii); ``drop`` removes columns from the
    same Gram matrix (D25)."""
    names, g = gram(df, [c for c in cols if c not in drop], intercept)
    inv = np.linalg.inv(g)
    rows = [(n, float(g[i, i] * inv[i, i])) for i, n in enumerate(names) if n != "const"]
    return df.sparkSession.createDataFrame(rows, "column string, vif double")


def feature_summary(df: DataFrame, cols: Sequence[str] | None = None,
                    scope: dict | None = None, exact: bool = True) -> DataFrame:
    """Dtype, distinct values, nulls and % per column, model scope."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    lf = long_form(df, cols, value_type="string")
    cd = F.count_distinct("value") if exact else F.approx_count_distinct("value")
    g = lf.groupBy("column").agg(cd.cast("bigint").alias("n_distinct"),
                                 F.count_if(F.col("value").isNull()).cast("bigint").alias("n_null"),
                                 F.count(F.lit(1)).alias("_n"))
    tmap = F.create_map(*[F.lit(x) for c in cols for x in (c, types[c])])
    smap = F.create_map(*[F.lit(x) for c in cols for x in (c, (scope or {}).get(c, "all"))])
    return g.select("column", F.element_at(tmap, F.col("column")).alias("dtype"), "n_distinct", "n_null",
                    (F.col("n_null") * 100.0 / F.col("_n")).alias("pct_null"),
                    F.element_at(smap, F.col("column")).alias("scope"))


# ---------------------------------------------------------------- D23, D24
def rank_features(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str],
                  label: str = "churn_value") -> DataFrame:
    """Numeric |d| and categorical Cramer's V in one ranked table."""
    d = cohens_d(df, num_cols, label).select("column", F.lit("cohens_d").alias("measure"),
                                             F.abs("cohens_d").alias("strength"), "effect")
    v = chi2_assoc(df, cat_cols, label).select("column", F.lit("cramers_v").alias("measure"),
                                               F.col("cramers_v").alias("strength"), "effect")
    return d.unionByName(v)


def segment_rate(df: DataFrame, predicate: Column, label: str = "churn_value") -> DataFrame:
    """Size, share and event rate of a conjunction of conditions."""
    p = F.coalesce(predicate, F.lit(False))
    return df.agg(F.count_if(p).cast("bigint").alias("n_segment"),
                  (F.count_if(p) / F.count(F.lit(1))).alias("share"),
                  (F.count_if(p & (F.col(label) == 1)) / F.count_if(p)).alias("event_rate"),
                  F.avg(F.col(label).cast("double")).alias("base_rate"))
