"""Registered queries: profiling and statistics (D1-D25) on the cleaned
customer snapshot with its derived features."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnspark.operators import clean as C
from churnspark.operators import profile as D
from churnspark.plans import sql as Q
from churnspark.plans.registry import query, rounded
from churnspark.plans.slice import cleaned_features
from churnspark.schemas import CATEGORICAL_INPUTS
from churnspark.session import cut_lineage
from churnspark.sources.tables import snapshot

NUM = ["tenure_months", "monthly_charges", "total_charges"]
CAT = [*CATEGORICAL_INPUTS, "tenure_group"]
LABEL = "churn_value"

LF = Q.FEAT + ",\nlf AS (" + Q.long_sql("feat", NUM, keep=[LABEL]) + ")"
LFC = Q.FEAT + ",\nlc AS (" + Q.long_sql("feat", CAT, keep=[LABEL], cast="VARCHAR") + ")"


def feat(spark, d):
    # for profiles that read the cleaned table many times: written once to the
    # shared checkpoint folder; single-pass queries take cleaned_features itself
    return cut_lineage(cleaned_features(spark, d))


def edge_bin_sql(v: str, lo: str, hi: str, n: int, right_closed: bool = False) -> str:
    step = f"((({hi}) - ({lo})) / CAST({n} AS DOUBLE))"
    e = lambda i: f"(CAST({i} AS DOUBLE) * {step} + ({lo}))"
    g = f"least(greatest(floor((({v}) - ({lo})) / {step}), 0), {n - 1})"
    if right_closed:
        body = (f"CASE WHEN {g} >= 1 AND {e(g)} >= {v} THEN {g} - 1 "
                f"WHEN {g} <= {n - 2} AND {e(f'{g} + 1')} < {v} THEN {g} + 1 ELSE {g} END")
    else:
        body = (f"CASE WHEN {g} >= 1 AND {e(g)} > {v} THEN {g} - 1 "
                f"WHEN {g} <= {n - 2} AND {e(f'{g} + 1')} <= {v} THEN {g} + 1 ELSE {g} END")
    return f"CAST(CASE WHEN {hi} > {lo} THEN {body} ELSE 0 END AS INTEGER)"


# ------------------------------------------------------------------ D1, D2
_SNAP_COLS = ["customerid", "state", "gender", "senior_citizen", "partner", "dependents",
              "tenure_months", "contract", "paperless_billing", "payment_method", "monthly_charges",
              "total_charges", "phone_service", "multiple_lines", "internet_service", "online_security",
              "online_backup", "device_protection", "tech_support", "streaming_tv", "streaming_movies",
              "churn_value", "churn_label", "cltv", "churn_reason", "y_score"]


@query("d1_missing_profile", Q.with_(Q.CLEAN.split(",\nmed AS")[0], "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_missing, "
    f"count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) AS pct_missing FROM c1" for c in _SNAP_COLS)
    + ") WHERE n_missing > 0"))
def d1_missing_profile(spark, d):
    """Nulls after text-to-number coercion of the raw snapshot."""
    raw = C.coerce_numeric(snapshot(spark, d), ["total_charges"])
    return D.missing_profile(raw)


@query("d2_target_balance", Q.with_(Q.FEAT + """,
g AS (SELECT churn_value AS label, CAST(count(*) AS BIGINT) AS n FROM feat GROUP BY churn_value),
t AS (SELECT sum(n) AS tot, min(n) AS mn, max(n) AS mx FROM g)""",
  "SELECT label, n, n * 100.0 / tot AS pct, CAST(mn AS DOUBLE) / mx AS minority_ratio, "
  "CAST(mn AS DOUBLE) / mx < 0.5 AS imbalanced FROM g, t"))
def d2_target_balance(spark, d):
    return D.target_balance(cleaned_features(spark, d))


# ------------------------------------------------------------------ D3-D7, D12
_PROF = ["mean", "median", "std", "min", "max", "q1", "q3", "iqr", "lower_fence", "upper_fence"]


def _profile_sql(by: str | None) -> str:
    k = f"{by}, " if by else ""
    inner = f"""SELECT {k}column, CAST(count(value) AS BIGINT) AS n, avg(value) AS mean,
  quantile_cont(value, 0.5) AS median, stddev_samp(value) AS std, min(value) AS min, max(value) AS max,
  quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM lf GROUP BY {k}column"""
    body = f"""SELECT {k}column, n, mean, median, std, min, max, q1, q3, q3 - q1 AS iqr,
  q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM ({inner})"""
    return Q.with_(LF, Q.round_cols(body, _PROF))


query("d3_numeric_profile", _profile_sql(None))(
    lambda spark, d: rounded(D.numeric_profile(feat(spark, d), NUM), _PROF))
query("d12_numeric_by_target", _profile_sql(LABEL))(
    lambda spark, d: rounded(D.numeric_profile(feat(spark, d), NUM, by=LABEL), _PROF))


def _fences(by):
    k = f"{by}, " if by else ""
    return LF + f""",
fq AS (SELECT {k}column, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
       FROM lf GROUP BY {k}column),
fe AS (SELECT {k}column, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM fq)"""


def _iqr_sql(by):
    k = f"{by}, " if by else ""
    using = f"{by}, column" if by else "column"
    return Q.with_(_fences(by), Q.round_cols(f"""SELECT {k}column,
  CAST(count(*) FILTER (WHERE value < lower_fence OR value > upper_fence) AS BIGINT) AS n_outliers,
  count(*) FILTER (WHERE value < lower_fence OR value > upper_fence) * 100.0 / count(*) AS pct_outliers
FROM lf JOIN fe USING ({using}) GROUP BY {k}column""", ["pct_outliers"]))


query("d4_iqr_outliers", _iqr_sql(None))(
    lambda spark, d: rounded(D.iqr_outliers(feat(spark, d), NUM), ["pct_outliers"]))
query("d4_iqr_outliers_by_target", _iqr_sql(LABEL))(
    lambda spark, d: rounded(D.iqr_outliers(feat(spark, d), NUM, by=LABEL), ["pct_outliers"]))


def _z_sql(by):
    k = f"{by}, " if by else ""
    using = f"{by}, column" if by else "column"
    return Q.with_(LF + f""",
st AS (SELECT {k}column, avg(value) AS mu, stddev_pop(value) AS sd FROM lf GROUP BY {k}column)""",
                   Q.round_cols(f"""SELECT {k}column,
  CAST(count(*) FILTER (WHERE coalesce(abs((value - mu) / sd) > 3.0, false)) AS BIGINT) AS n_outliers,
  count(*) FILTER (WHERE coalesce(abs((value - mu) / sd) > 3.0, false)) * 100.0 / count(*) AS pct_outliers
FROM lf JOIN st USING ({using}) GROUP BY {k}column""", ["pct_outliers"]))


query("d5_z_outliers", _z_sql(None))(
    lambda spark, d: rounded(D.z_outliers(feat(spark, d), NUM), ["pct_outliers"]))
query("d5_z_outliers_by_target", _z_sql(LABEL))(
    lambda spark, d: rounded(D.z_outliers(feat(spark, d), NUM, by=LABEL), ["pct_outliers"]))

_HB = 30
query("d6_histogram", Q.with_(LF + f""",
rg AS (SELECT column, min(value) AS lo, max(value) AS hi FROM lf GROUP BY column),
hb AS (SELECT column, lo, hi, {edge_bin_sql('value', 'lo', 'hi', _HB)} AS bin FROM lf JOIN rg USING (column))""",
  Q.round_cols(f"""SELECT column, bin, CAST(bin AS DOUBLE) * ((hi - lo) / CAST({_HB} AS DOUBLE)) + lo AS bin_left,
  CASE WHEN bin = {_HB - 1} THEN hi ELSE CAST(bin + 1 AS DOUBLE) * ((hi - lo) / CAST({_HB} AS DOUBLE)) + lo END AS bin_right,
  CAST(count(*) AS BIGINT) AS count FROM hb GROUP BY column, bin, lo, hi""", ["bin_left", "bin_right"])))(
    lambda spark, d: rounded(D.histogram(feat(spark, d), NUM, _HB), ["bin_left", "bin_right"]))

query("d7_box_stats", Q.with_(_fences(None) + ",\nmd AS (SELECT column, quantile_cont(value, 0.5) AS median FROM lf GROUP BY column)",
  Q.round_cols("""SELECT column, q1, median, q3,
  min(value) FILTER (WHERE value >= lower_fence) AS whisker_low,
  max(value) FILTER (WHERE value <= upper_fence) AS whisker_high
FROM lf JOIN fe USING (column) JOIN fq USING (column) JOIN md USING (column)
GROUP BY column, q1, median, q3""", ["q1", "median", "q3", "whisker_low", "whisker_high"])))(
    lambda spark, d: rounded(D.box_stats(feat(spark, d), NUM), ["q1", "median", "q3", "whisker_low", "whisker_high"]))

MOMENTS = LF + """,
mu AS (SELECT column, count(*) AS n, avg(value) AS mu FROM lf GROUP BY column),
cm AS (SELECT column, CAST(any_value(n) AS DOUBLE) AS n, avg(power(value - mu, 2)) AS m2,
              avg(power(value - mu, 3)) AS m3, avg(power(value - mu, 4)) AS m4
       FROM lf JOIN mu USING (column) GROUP BY column),
g AS (SELECT column, n, m3 / power(m2, 1.5) AS g1, m4 / (m2 * m2) - 3 AS g2 FROM cm)"""

query("d8_shape_stats", Q.with_(MOMENTS + """,
s AS (SELECT column, n, g1 * sqrt(n * (n - 1)) / (n - 2) AS skewness,
             (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6) AS kurtosis FROM g)""",
  Q.round_cols("""SELECT column, CAST(n AS BIGINT) AS n, skewness, kurtosis,
  CASE WHEN abs(skewness) < 0.5 THEN 'symmetric' WHEN skewness > 0 THEN 'right-skewed' ELSE 'left-skewed' END AS skew_label,
  CASE WHEN abs(kurtosis) < 0.5 THEN 'mesokurtic' WHEN kurtosis > 0 THEN 'leptokurtic' ELSE 'platykurtic' END AS kurtosis_label
FROM s""", ["skewness", "kurtosis"])))(
    lambda spark, d: rounded(D.shape_stats(feat(spark, d), NUM), ["skewness", "kurtosis"]))

query("d9_normality", Q.with_(MOMENTS + ",\njb AS (SELECT column, n / 6.0 * (g1 * g1 + g2 * g2 / 4.0) AS jarque_bera FROM g)",
  Q.round_cols("SELECT column, jarque_bera, exp(-jarque_bera / 2.0) AS p_value, "
               "exp(-jarque_bera / 2.0) > 0.05 AS normal FROM jb", ["jarque_bera", "p_value"])))(
    lambda spark, d: rounded(D.normality(feat(spark, d), NUM), ["jarque_bera", "p_value"]))

_NP = 100
query("d10_normal_curve", Q.with_(LF + f""",
st AS (SELECT column, avg(value) AS mu, stddev_samp(value) AS sd, min(value) AS lo, max(value) AS hi
       FROM lf GROUP BY column),
xs AS (SELECT column, mu, sd, CAST(range AS INTEGER) AS i,
   CASE WHEN range = {_NP - 1} THEN hi ELSE CAST(range AS DOUBLE) * ((hi - lo) / CAST({_NP - 1} AS DOUBLE)) + lo END AS x
   FROM st, range(0, {_NP}))""",
  Q.round_cols(f"""SELECT column, i, x, exp(-power(x - mu, 2) / (2 * sd * sd)) / (sd * CAST('{(2 * 3.141592653589793) ** 0.5!r}' AS DOUBLE)) AS density FROM xs""",
               ["x", "density"])))(
    lambda spark, d: rounded(D.normal_curve(feat(spark, d), NUM, _NP), ["x", "density"]))


# ------------------------------------------------------------------ D11
@query("d11_category_profile", Q.with_(Q.FEAT + ",\nlc AS (" + Q.long_sql("feat", CAT, cast="VARCHAR") + """),
g AS (SELECT column, value, CAST(count(*) AS BIGINT) AS count FROM lc WHERE value IS NOT NULL GROUP BY column, value),
pc AS (SELECT column, sum(count) AS tot, CAST(count(*) AS BIGINT) AS n_categories,
              arg_min(value, (-count, value)) AS dominant, arg_min(value, (count, value)) AS minority,
              max(count) AS mx FROM g GROUP BY column)""",
  """SELECT column, value, count, round_even(count * 100.0 / tot, 1) AS pct, n_categories,
  value = dominant AS is_dominant, value = minority AS is_minority,
  round_even(count * 100.0 / tot, 1) < 1.0 AS is_rare, round_even(mx * 100.0 / tot, 1) > 80.0 AS high_concentration,
  round_even(100.0 / n_categories, 1) AS uniform_pct FROM g JOIN pc USING (column)"""))
def d11_category_profile(spark, d):
    return D.category_profile(feat(spark, d), CAT)


# ------------------------------------------------------------------ D13-D16
_D13 = ["mean_0", "mean_1", "std_0", "std_1", "cohens_d"]
COHEN_SQL = LF + """,
cd0 AS (SELECT column, avg(value) FILTER (WHERE churn_value = 0) AS mean_0, avg(value) FILTER (WHERE churn_value = 1) AS mean_1,
        stddev_samp(value) FILTER (WHERE churn_value = 0) AS std_0, stddev_samp(value) FILTER (WHERE churn_value = 1) AS std_1
        FROM lf GROUP BY column),
cd AS (SELECT *, CASE WHEN sqrt((std_0 * std_0 + std_1 * std_1) / 2) > 0
        THEN (mean_1 - mean_0) / sqrt((std_0 * std_0 + std_1 * std_1) / 2) ELSE 0.0 END AS cohens_d FROM cd0)"""
D_LABEL = ("CASE WHEN abs(cohens_d) < 0.2 THEN 'negligible' WHEN abs(cohens_d) < 0.5 THEN 'small' "
           "WHEN abs(cohens_d) < 0.8 THEN 'medium' ELSE 'large' END")

query("d13_cohens_d", Q.with_(COHEN_SQL, Q.round_cols(
    f"SELECT column, mean_0, mean_1, std_0, std_1, cohens_d, {D_LABEL} AS effect FROM cd", _D13)))(
    lambda spark, d: rounded(D.cohens_d(feat(spark, d), NUM), _D13))

query("d14_target_corr", Q.with_(LF, Q.round_cols(
    "SELECT column, corr(value, CAST(churn_value AS DOUBLE)) AS r, abs(corr(value, CAST(churn_value AS DOUBLE))) AS abs_r "
    "FROM lf GROUP BY column", ["r", "abs_r"])))(
    lambda spark, d: rounded(D.target_corr(feat(spark, d), NUM), ["r", "abs_r"]))

MW_SQL = LF + """,
dv AS (SELECT column, value, CAST(count(*) AS BIGINT) AS t, CAST(sum(churn_value) AS BIGINT) AS n1
       FROM lf GROUP BY column, value),
rk AS (SELECT *, sum(t) OVER (PARTITION BY column ORDER BY value) - t AS prev_t FROM dv),
mw AS (SELECT column, CAST(sum(t) AS DOUBLE) AS n, CAST(sum(n1) AS DOUBLE) AS n_1,
              sum((prev_t + (t + 1) / 2.0) * (t - n1)) AS r0, sum(power(CAST(t AS DOUBLE), 3) - t) AS ties
       FROM rk GROUP BY column),
u AS (SELECT column, n, n_1, n - n_1 AS n_0, r0 - (n - n_1) * (n - n_1 + 1) / 2 AS u0, ties FROM mw)"""

query("d15_mann_whitney", Q.with_(MW_SQL, Q.round_cols(
    """SELECT column, CAST(n_0 AS BIGINT) AS n_0, CAST(n_1 AS BIGINT) AS n_1, u0 AS u_statistic,
  (greatest(u0, n_0 * n_1 - u0) - n_0 * n_1 / 2.0 - 0.5)
    / sqrt(n_0 * n_1 / 12.0 * ((n + 1) - ties / (n * (n - 1)))) AS z FROM u""", ["u_statistic", "z"])))(
    lambda spark, d: rounded(D.mann_whitney(feat(spark, d), NUM), ["u_statistic", "z"]))


@query("d15_mann_whitney_p")
def d15_mann_whitney_p(spark, d):
    """Same statistic with its two-sided p (erfc on the per-column result rows)."""
    return D.mann_whitney(feat(spark, d), NUM, with_p=True)


V_LABEL = ("CASE WHEN cramers_v < 0.1 THEN 'negligible' WHEN cramers_v < 0.3 THEN 'weak' "
           "WHEN cramers_v < 0.5 THEN 'moderate' ELSE 'strong' END")
CHI_SQL = LFC + """,
ob AS (SELECT column, value, CAST(count(*) FILTER (WHERE churn_value <> 1) AS DOUBLE) AS o0,
              CAST(count(*) FILTER (WHERE churn_value = 1) AS DOUBLE) AS o1 FROM lc WHERE value IS NOT NULL
       GROUP BY column, value),
tt AS (SELECT column, sum(o0) AS c0, sum(o1) AS c1, count(*) AS r FROM ob GROUP BY column),
ex AS (SELECT ob.*, c0, c1, r - 1 AS dof, c0 + c1 AS n, (o0 + o1) * c0 / (c0 + c1) AS e0,
              (o0 + o1) * c1 / (c0 + c1) AS e1 FROM ob JOIN tt USING (column)),
dv AS (SELECT *, CASE WHEN dof = 1 THEN abs(abs(o0 - e0) - 0.5) ELSE abs(o0 - e0) END AS d0,
              CASE WHEN dof = 1 THEN abs(abs(o1 - e1) - 0.5) ELSE abs(o1 - e1) END AS d1 FROM ex),
ch AS (SELECT column, sum(CASE WHEN e0 > 0 THEN d0 * d0 / e0 ELSE 0 END + CASE WHEN e1 > 0 THEN d1 * d1 / e1 ELSE 0 END) AS chi2,
              CAST(any_value(dof) AS BIGINT) AS dof, any_value(n) AS n FROM dv GROUP BY column),
cv AS (SELECT column, chi2, dof, CASE WHEN dof > 0 THEN sqrt(chi2 / n / least(dof, 1)) ELSE 0.0 END AS cramers_v FROM ch)"""

query("d16_chi2_assoc", Q.with_(CHI_SQL, Q.round_cols(
    f"SELECT column, chi2, dof, cramers_v, {V_LABEL} AS effect FROM cv", ["chi2", "cramers_v"])))(
    lambda spark, d: rounded(D.chi2_assoc(feat(spark, d), CAT), ["chi2", "cramers_v"]))


@query("d16_chi2_assoc_p")
def d16_chi2_assoc_p(spark, d):
    """Same statistic with its p value (regularized incomplete gamma on result rows)."""
    return D.chi2_assoc(feat(spark, d), CAT, with_p=True)


# ------------------------------------------------------------------ D17, D18
ER = """CAST(count(*) FILTER (WHERE churn_value <> 1) AS BIGINT) AS n_0,
  CAST(count(*) FILTER (WHERE churn_value = 1) AS BIGINT) AS n_1, CAST(count(*) AS BIGINT) AS n,
  count(*) FILTER (WHERE churn_value = 1) / count(*) AS event_rate"""

query("d17_event_rate", Q.with_(Q.FEAT, Q.round_cols(
    f"SELECT contract, {ER} FROM feat GROUP BY contract", ["event_rate"])))(
    lambda spark, d: rounded(D.event_rate(cleaned_features(spark, d), "contract"), ["event_rate"]))

query("d17_event_rate_rollup", Q.with_(Q.FEAT, Q.round_cols(
    f"SELECT contract, internet_service, {ER} FROM feat GROUP BY ROLLUP (contract, internet_service)",
    ["event_rate"])))(
    lambda spark, d: rounded(D.event_rate(cleaned_features(spark, d), ["contract", "internet_service"], mode="rollup"),
                             ["event_rate"]))

query("d17_event_rate_cube", Q.with_(Q.FEAT, Q.round_cols(
    f"SELECT contract, gender, {ER} FROM feat GROUP BY CUBE (contract, gender)", ["event_rate"])))(
    lambda spark, d: rounded(D.event_rate(cleaned_features(spark, d), ["contract", "gender"], mode="cube"), ["event_rate"]))

_BR = ["bin_left", "bin_right", "center", "event_rate"]
query("d18_binned_rate", Q.with_(LF + f""",
rg AS (SELECT column, min(value) AS lo, max(value) AS hi FROM lf GROUP BY column),
bb AS (SELECT column, lo, hi, churn_value, {edge_bin_sql('value', 'lo', 'hi', 10, True)} AS bin
       FROM lf JOIN rg USING (column)),
bg AS (SELECT column, bin, lo, hi, CAST(count(*) AS BIGINT) AS n, avg(CAST(churn_value AS DOUBLE)) AS event_rate
       FROM bb GROUP BY column, bin, lo, hi),
be AS (SELECT *, CASE WHEN bin = 0 THEN lo - (hi - lo) * 0.001
                      ELSE CAST(bin AS DOUBLE) * ((hi - lo) / CAST(10 AS DOUBLE)) + lo END AS bin_left,
                 CASE WHEN bin = 9 THEN hi ELSE CAST(bin + 1 AS DOUBLE) * ((hi - lo) / CAST(10 AS DOUBLE)) + lo END AS bin_right
       FROM bg)""",
  Q.round_cols("SELECT column, bin, bin_left, bin_right, (bin_left + bin_right) / 2 AS center, n, event_rate FROM be", _BR)))(
    lambda spark, d: rounded(D.binned_rate(feat(spark, d), NUM), _BR))

# ------------------------------------------------------------------ D19-D25
CORR_COLS = NUM + ["num_services", "charges_per_month", LABEL]
_pairs = [(a, b) for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i:]]
CORR_SQL = Q.FEAT + ",\ncm AS (" + "\n  UNION ALL ".join(
    (f"SELECT '{a}' AS a, '{b}' AS b, 1.0::DOUBLE AS r FROM (SELECT 1)" if a == b else
     f"SELECT '{a}' AS a, '{b}' AS b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM feat UNION ALL "
     f"SELECT '{b}', '{a}', corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) FROM feat") for a, b in _pairs) + ")"

query("d19_corr_matrix", Q.with_(CORR_SQL, Q.round_cols("SELECT a, b, r FROM cm", ["r"])))(
    lambda spark, d: rounded(D.corr_matrix(feat(spark, d), CORR_COLS), ["r"]))

query("d20_high_corr_pairs", Q.with_(CORR_SQL, Q.round_cols(
    "SELECT a, b, r, abs(r) AS abs_r FROM cm WHERE a < b AND abs(r) >= 0.7 AND a <> 'churn_value' "
    "AND b <> 'churn_value'", ["r", "abs_r"])))(
    lambda spark, d: rounded(D.high_corr_pairs(feat(spark, d), CORR_COLS), ["r", "abs_r"]))

GRAM = Q.FEAT + """,
gm AS (SELECT sum(CAST(tenure_months AS DOUBLE) * tenure_months) AS a, sum(CAST(tenure_months AS DOUBLE) * monthly_charges) AS b,
              sum(CAST(tenure_months AS DOUBLE) * total_charges) AS c, sum(monthly_charges * monthly_charges) AS d,
              sum(monthly_charges * total_charges) AS e, sum(total_charges * total_charges) AS f
       FROM feat WHERE tenure_months IS NOT NULL AND monthly_charges IS NOT NULL AND total_charges IS NOT NULL),
dt AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM gm)"""

query("d21_vif", Q.with_(GRAM, Q.round_cols("""SELECT 'tenure_months' AS column, a * (d * f - e * e) / det AS vif FROM dt
UNION ALL SELECT 'monthly_charges', d * (a * f - c * c) / det FROM dt
UNION ALL SELECT 'total_charges', f * (a * d - b * b) / det FROM dt""", ["vif"])))(
    lambda spark, d: rounded(D.vif(feat(spark, d), NUM), ["vif"]))

query("d25_vif_without", Q.with_(GRAM, Q.round_cols("""SELECT 'tenure_months' AS column, a * d / (a * d - b * b) AS vif FROM dt
UNION ALL SELECT 'monthly_charges', d * a / (a * d - b * b) FROM dt""", ["vif"])))(
    lambda spark, d: rounded(D.vif(feat(spark, d), NUM, drop=["total_charges"]), ["vif"]))

_FS = NUM + CATEGORICAL_INPUTS + ["num_services", "tenure_group"]
_TYPES = {c: "string" for c in _FS} | {"tenure_months": "int", "monthly_charges": "double", "total_charges": "double",
                                      "num_services": "int"}
_SCOPE = {"total_charges": "tree models only"}


@query("d22_feature_summary", Q.with_(Q.FEAT + ",\nlv AS (" + Q.long_sql("feat", _FS, cast="VARCHAR") + ")",
  Q.round_cols("SELECT column, CASE column " + " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in _TYPES.items()) +
               """ END AS dtype, CAST(count(DISTINCT value) AS BIGINT) AS n_distinct,
  CAST(count(*) FILTER (WHERE value IS NULL) AS BIGINT) AS n_null, count(*) FILTER (WHERE value IS NULL) * 100.0 / count(*) AS pct_null,
  CASE WHEN column = 'total_charges' THEN 'tree models only' ELSE 'all' END AS scope FROM lv GROUP BY column""",
               ["pct_null"])))
def d22_feature_summary(spark, d):
    return rounded(D.feature_summary(feat(spark, d), _FS, scope=_SCOPE), ["pct_null"])


query("d23_rank_features", Q.with_(COHEN_SQL + ",\n" + CHI_SQL[len(Q.FEAT):].lstrip(",\n"), Q.round_cols(
    f"""SELECT column, 'cohens_d' AS measure, abs(cohens_d) AS strength, {D_LABEL} AS effect FROM cd
UNION ALL SELECT column, 'cramers_v', cramers_v, {V_LABEL} FROM cv""", ["strength"])))(
    lambda spark, d: rounded(D.rank_features(feat(spark, d), NUM, CAT), ["strength"]))

query("d24_segment_rate", Q.with_(Q.FEAT, Q.round_cols("""SELECT
  CAST(count(*) FILTER (WHERE seg) AS BIGINT) AS n_segment, count(*) FILTER (WHERE seg) / count(*) AS share,
  count(*) FILTER (WHERE seg AND churn_value = 1) / count(*) FILTER (WHERE seg) AS event_rate,
  avg(CAST(churn_value AS DOUBLE)) AS base_rate
FROM (SELECT *, coalesce(contract = 'Month-to-month' AND internet_service = 'Fiber optic' AND tenure_months <= 12, false) AS seg FROM feat)""",
    ["share", "event_rate", "base_rate"])))(
    lambda spark, d: rounded(D.segment_rate(
        cleaned_features(spark, d), (F.col("contract") == "Month-to-month") & (F.col("internet_service") == "Fiber optic")
        & (F.col("tenure_months") <= 12)), ["share", "event_rate", "base_rate"]))
