"""Registered queries: sources, cleaning, features (S, P, F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnspark import schemas as S
from churnspark.functions import features as FT
from churnspark.operators import clean as C
from churnspark.plans import sql as Q
from churnspark.plans.registry import query, rounded
from churnspark.plans.slice import churn_by_segment, cleaned_features
from churnspark.sources import tables as T

SNAP_COLS = ["customerid", "state", "gender", "senior_citizen", "partner", "dependents",
             "tenure_months", "contract", "paperless_billing", "payment_method",
             "monthly_charges", "total_charges", "phone_service", "multiple_lines",
             "internet_service", "online_security", "online_backup", "device_protection",
             "tech_support", "streaming_tv", "streaming_movies", "churn_value", "churn_label",
             "cltv", "churn_reason", "y_score"]

query("slice_churn_by_segment", Q.with_(Q.FEAT, """
SELECT contract, tenure_group,
  CAST(count(*) AS BIGINT) AS n_customers,
  CAST(count(*) FILTER (WHERE churn_value = 1) AS BIGINT) AS n_churned,
  round(avg(churn_value), 6) AS churn_rate,
  round(sum(CASE WHEN churn_value = 1 THEN monthly_charges ELSE 0.0 END), 2) AS mrr_at_risk,
  round(sum(CASE WHEN churn_value = 1 THEN greatest(cltv - total_charges, 0.0) ELSE 0.0 END), 2)
    AS residual_clv_at_risk
FROM feat GROUP BY contract, tenure_group"""))(churn_by_segment)


@query("s1_snapshot", Q.with_(Q.SNAPSHOT, "SELECT * FROM snap"))
def s1_snapshot(spark, sf_dir):
    """The raw snapshot, read with explicit types (never inferred)."""
    return T.snapshot(spark, sf_dir)


@query("p_clean_snapshot", Q.with_(Q.CLEAN, "SELECT * FROM clean"))
def p_clean_snapshot(spark, sf_dir):
    """P8, P9, P11, P12, P13, P14 chained."""
    df = C.clean_snapshot(T.snapshot(spark, sf_dir))
    return df.select(*[c for c in SNAP_COLS])


@query("f7_features", Q.with_(Q.FEAT, """
SELECT customerid, num_services, charges_per_month, is_month_to_month, tenure_group,
       has_security_support, is_fiber_optic FROM feat"""))
def f7_features(spark, sf_dir):
    """F1-F7 on the cleaned snapshot."""
    return cleaned_features(spark, sf_dir).select("customerid", *S.NEW_FEATURES)


# ------------------------------------------------------------------ P (cleaning, validation)
def raw_coerced(spark, d, casing=False):
    return C.coerce_numeric(T.snapshot(spark, d, casing=casing), ["total_charges"])


LOWER = Q.SNAPSHOT + """,
lw AS (SELECT * REPLACE (""" + ", ".join(
    f"CASE WHEN customerid % 5 = 0 THEN lower({c}) ELSE {c} END AS {c}" for c in S.CATEGORICAL_INPUTS) + """,
    TRY_CAST(total_charges AS DOUBLE) AS total_charges) FROM snap)"""


@query("p13_canonicalize", Q.with_(LOWER, "SELECT customerid, " + ", ".join(
    f"{Q.canon(c)} AS {c}" for c in S.CATEGORICAL_INPUTS) + " FROM lw"))
def p13_canonicalize(spark, d):
    """Mixed-case records back to canonical spelling."""
    return C.canonicalize(raw_coerced(spark, d, True)).select("customerid", *S.CATEGORICAL_INPUTS)


@query("p9_impute_audit", Q.with_(Q.SNAPSHOT + """,
c1 AS (SELECT * REPLACE (TRY_CAST(total_charges AS DOUBLE) AS total_charges) FROM snap)""",
  Q.round_cols("""SELECT CAST(count(*) FILTER (WHERE total_charges IS NULL) AS BIGINT) AS n_null,
  coalesce(bool_and(tenure_months = 0) FILTER (WHERE total_charges IS NULL), true) AS nulls_have_zero_tenure,
  quantile_cont(total_charges, 0.5) AS median FROM c1""", ["median"])))
def p9_impute_audit(spark, d):
    _, audit = C.impute_median(raw_coerced(spark, d))
    return rounded(audit, ["median"])


@query("p11_p12_replacement_counts", Q.with_(Q.SNAPSHOT, "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE {c} = 'No internet service') AS BIGINT) AS n_no_service, "
    f"CAST(count(*) FILTER (WHERE internet_service = 'No' AND {c} IS DISTINCT FROM 'No') AS BIGINT) AS n_inconsistent "
    f"FROM snap" for c in S.INTERNET_ADDONS)))
def p11_p12_replacement_counts(spark, d):
    """P11 replacements and P12 corrections counted on the raw snapshot (one
    aggregate each, stacked)."""
    from churnspark.operators.prefix import long_form
    raw = T.snapshot(spark, d)
    _, c11 = C.normalize_no_service(raw)
    _, c12 = C.fix_inconsistent_services(raw)
    a = long_form(c11, S.INTERNET_ADDONS, value_type="bigint", value="n_no_service")
    b = long_form(c12, S.INTERNET_ADDONS, value_type="bigint", value="n_inconsistent")
    return a.join(b, "column")


@query("p15_check_ranges", Q.with_(LOWER, "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS BIGINT) AS n_violations FROM lw"
    for c, (lo, hi) in S.RANGES.items())))
def p15_check_ranges(spark, d):
    return C.check_ranges(raw_coerced(spark, d, True))


@query("p16_check_domains", Q.with_(LOWER, "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ("
    + ", ".join(f"'{v}'" for v in vals) + ")) AS BIGINT) AS n_violations FROM lw" for c, vals in S.DOMAINS.items())))
def p16_check_domains(spark, d):
    return C.check_domains(raw_coerced(spark, d, True))


_BAD = " OR ".join([f"{c} IS NULL" for c in S.INPUT_FIELDS] +
                   [f"({c} IS NOT NULL AND {c} NOT IN (" + ", ".join(f"'{v}'" for v in vals) + "))"
                    for c, vals in S.DOMAINS.items()] +
                   [f"({c} < {lo} OR {c} > {hi})" for c, (lo, hi) in S.RANGES.items()])


@query("p17_validate_split", Q.with_(LOWER, f"""SELECT CASE WHEN {_BAD} THEN 'rejected' ELSE 'valid' END AS outcome,
  CAST(count(*) AS BIGINT) AS n FROM lw GROUP BY 1"""))
def p17_validate_split(spark, d):
    ok, bad = C.validate(raw_coerced(spark, d, True))
    return (ok.select(F.lit("valid").alias("outcome")).unionByName(bad.select(F.lit("rejected").alias("outcome")))
              .groupBy("outcome").agg(F.count(F.lit(1)).cast("bigint").alias("n")))


@query("p18_audit_internet", Q.with_(Q.SNAPSHOT, """SELECT coalesce(internet_service = 'No' AND (""" + " OR ".join(
    f"{c} = 'Yes'" for c in S.INTERNET_ADDONS) + """), false) AS audit_no_internet_active_addon,
  CAST(count(*) AS BIGINT) AS n FROM snap GROUP BY 1"""))
def p18_audit_internet(spark, d):
    a = C.audit_internet(T.snapshot(spark, d))
    return a.groupBy("audit_no_internet_active_addon").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("p23_out_of_domain", Q.with_(LOWER, "SELECT column, value, CAST(count(*) AS BIGINT) AS n FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, {c} AS value FROM lw WHERE {c} IS NOT NULL AND {c} NOT IN ("
    + ", ".join(f"'{v}'" for v in vals) + ")" for c, vals in S.DOMAINS.items()) + ") GROUP BY 1, 2"))
def p23_out_of_domain(spark, d):
    return C.flag_out_of_domain(raw_coerced(spark, d, True))


_DEDUP_COLS = [c for c in SNAP_COLS if c not in ("customerid", "state", "y_score")]


@query("p19_dedupe", Q.with_(Q.CLEAN, "SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT " +
                            ", ".join(_DEDUP_COLS) + " FROM clean)) AS BIGINT) AS n_duplicates, "
                            "CAST((SELECT count(*) FROM (SELECT DISTINCT " + ", ".join(_DEDUP_COLS) +
                            " FROM clean)) AS BIGINT) AS n_after FROM clean"))
def p19_dedupe(spark, d):
    """Exact duplicates after dropping the id columns (P5 + P19)."""
    df = C.clean_snapshot(T.snapshot(spark, d)).select(*_DEDUP_COLS)
    out, cnt = C.dedupe(df)
    return cnt.withColumn("_j", F.lit(1)).join(
        out.agg(F.count(F.lit(1)).cast("bigint").alias("n_after")).withColumn("_j", F.lit(1)), "_j").drop("_j")


@query("p5_drop_leakage", Q.with_(Q.SNAPSHOT, "SELECT * EXCLUDE (customerid, state, churn_label, cltv, churn_reason) FROM snap"))
def p5_drop_leakage(spark, d):
    return C.drop_leakage(T.snapshot(spark, d).withColumnRenamed("state", "state"))


# ------------------------------------------------------------------ S
@query("s15_profile_delta", Q.with_(Q.CLEAN + ",\nc1b AS (SELECT * FROM c1)", """SELECT
  CAST((SELECT count(*) FROM c1b) AS BIGINT) AS rows_before,
  CAST((SELECT """ + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in SNAP_COLS) + """ FROM c1b) AS BIGINT) AS nulls_before,
  """ + str(len(SNAP_COLS)) + """ AS cols_before,
  CAST((SELECT count(*) FROM clean) AS BIGINT) AS rows_after,
  CAST((SELECT """ + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in SNAP_COLS) + """ FROM clean) AS BIGINT) AS nulls_after,
  """ + str(len(SNAP_COLS)) + """ AS cols_after,
  CAST((SELECT count(*) FROM c1b) - (SELECT count(*) FROM clean) AS BIGINT) AS rows_removed,
  CAST((SELECT """ + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in SNAP_COLS) + """ FROM c1b)
     - (SELECT """ + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in SNAP_COLS) + """ FROM clean) AS BIGINT) AS nulls_removed"""))
def s15_profile_delta(spark, d):
    from churnspark.sources.io import profile_delta
    before = raw_coerced(spark, d)
    after = C.clean_snapshot(T.snapshot(spark, d)).select(*SNAP_COLS)
    return profile_delta(before, after).withColumns({"cols_before": F.col("cols_before").cast("int"),
                                                     "cols_after": F.col("cols_after").cast("int")})


@query("s10_fingerprint")
def s10_fingerprint(spark, d):
    """Order-free table fingerprint of the cleaned snapshot (rows, columns,
    xor of row hashes, positive rate)."""
    from churnspark.sources.io import fingerprint
    return fingerprint(C.clean_snapshot(T.snapshot(spark, d)), label="churn_value")


@query("s11_parse_records", Q.with_(Q.SNAPSHOT, "SELECT customerid, " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c in S.INPUT_FIELDS) + " FROM snap"))
def s11_parse_records(spark, d):
    """Records serialised as JSON with Title-Case keys (and the alternative
    'Monthly Charge' spelling), parsed back into the 19 fields."""
    from churnspark.sources.io import parse_records
    s = T.snapshot(spark, d)
    title = {c: ("Monthly Charge" if c == "monthly_charges" else " ".join(w.capitalize() for w in c.split("_")))
             for c in S.INPUT_FIELDS}
    js = s.select("customerid", F.to_json(F.struct(*[F.col(c).cast("string").alias(title[c])
                                                     for c in S.INPUT_FIELDS])).alias("value"))
    return parse_records(js, "value")


# ------------------------------------------------------------------ P1/P2/P6/P7, P10, F8, F10, F11
@query("p1_p2_p6_p7_normalize_columns", Q.with_(Q.SNAPSHOT, "SELECT " + ", ".join(S.INPUT_FIELDS) +
                                                ", CAST(churn_value AS INTEGER) AS churn_value FROM snap"))
def p1_p2_p6_p7_normalize_columns(spark, d):
    """Raw file header spellings (Title Case, 'Monthly Charge', 'Churn Value'
    as text) -> snake_case (P1) -> key aliases (P2) -> the 19 inputs (P6) ->
    target resolved and cast (P7)."""
    s = T.snapshot(spark, d)
    title = {c: ("Monthly Charge" if c == "monthly_charges" else " ".join(w.capitalize() for w in c.split("_")))
             for c in S.INPUT_FIELDS}
    raw = s.select(*[F.col(c).alias(title[c]) for c in S.INPUT_FIELDS],
                   F.col("churn_value").cast("string").alias("Churn Value"), F.col("cltv").alias("CLTV"))
    df = C.resolve_target(C.alias_columns(C.snake_columns(raw)))
    return C.select_inputs(df, keep=["churn_value"])


@query("p10_impute_constant", Q.with_(Q.SNAPSHOT, "SELECT customerid, coalesce(TRY_CAST(total_charges AS DOUBLE), 0.0) "
                                                 "AS total_charges FROM snap"))
def p10_impute_constant(spark, d):
    return C.impute_constant(raw_coerced(spark, d), "total_charges", 0.0).select("customerid", "total_charges")


_F8 = (["missing_" + c for c in S.NEW_FEATURES] + ["not_binary_" + c for c in S.PASS_PIPE] +
       ["num_services_out_of_range", "tenure_group_unknown", "charges_per_month_negative"])


@query("f8_feature_violations", Q.with_(Q.FEAT, "SELECT " + ", ".join(
    [f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing_{c}" for c in S.NEW_FEATURES] +
    [f"CAST(count(*) FILTER (WHERE {c} NOT IN (0, 1)) AS BIGINT) AS not_binary_{c}" for c in S.PASS_PIPE] +
    ["CAST(count(*) FILTER (WHERE num_services < 0 OR num_services > 7) AS BIGINT) AS num_services_out_of_range",
     "CAST(count(*) FILTER (WHERE tenure_group NOT IN ('novo', 'medio', 'longo')) AS BIGINT) AS tenure_group_unknown",
     "CAST(count(*) FILTER (WHERE charges_per_month < 0) AS BIGINT) AS charges_per_month_negative"]) + " FROM feat"))
def f8_feature_violations(spark, d):
    """F8 output contract as one aggregate of violation counts."""
    return FT.feature_violations(cleaned_features(spark, d))


@query("f10_f11_encode_and_log", Q.with_(Q.FEAT, "SELECT customerid, " + ", ".join(
    f"CASE WHEN {c} = 'Yes' THEN 1 WHEN {c} = 'No' THEN 0 END AS {c}" for c in ["partner", "dependents",
                                                                             "paperless_billing"]) +
    ", round(ln(1 + total_charges), 6) AS total_charges_log FROM feat"))
def f10_f11_encode_and_log(spark, d):
    f = cleaned_features(spark, d)
    x = FT.log1p_col(FT.yes_no_to_int(f, ["partner", "dependents", "paperless_billing"]), "total_charges")
    return x.select("customerid", "partner", "dependents", "paperless_billing",
                    F.round("total_charges_log", 6).alias("total_charges_log"))


@query("a26_stack", Q.with_(Q.SCORES, """SELECT model, 'confusion' AS source, CAST(count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS BIGINT) AS tp,
  NULL::DOUBLE AS roc_auc FROM scores GROUP BY model
UNION ALL SELECT model, 'auc', NULL::BIGINT, CAST(sum(pos * (2 * (N - fp) + neg)) AS DOUBLE) / (2.0 * any_value(P) * any_value(N))
FROM (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS fp, sum(pos) OVER (PARTITION BY model) AS P,
             sum(neg) OVER (PARTITION BY model) AS N
      FROM (SELECT model, score, sum(label) AS pos, sum(1 - label) AS neg FROM scores GROUP BY model, score)) GROUP BY model"""))
def a26_stack(spark, d):
    """Result tables of different shape stacked by name (missing columns null)."""
    from churnspark.operators import evaluate as A
    s = T.scores(spark, d)
    c = A.confusion(s, 0.5).select("model", F.lit("confusion").alias("source"), "tp")
    a = A.roc_auc(s).select("model", F.lit("auc").alias("source"), "roc_auc")
    return A.stack(c, a)
