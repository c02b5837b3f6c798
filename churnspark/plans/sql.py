"""DuckDB-dialect SQL building blocks for the oracle side of every query.

The oracle is an independent statement of each operator's result in plain
SQL (windows over small tables are fine there: DuckDB runs it on one machine
at sf0.01 only).  Shared CTEs: the customer snapshot, the cleaned snapshot,
the feature table and the (model, id, label, score) evaluation input.
"""

from __future__ import annotations

import re

from churnspark import schemas as S

SNAPSHOT = """
o AS (
  SELECT o_custkey AS k, count(*) AS n_orders,
         sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS rev_cents,
         min(o_orderdate) AS d0, max(o_orderdate) AS d1
  FROM orders GROUP BY o_custkey),
b AS (
  SELECT c.c_custkey AS k, c.c_acctbal, c.c_nationkey, o.n_orders, o.rev_cents,
         CASE WHEN d1 IS NULL THEN 0 ELSE least((year(d1)*12 + month(d1)) - (year(d0)*12 + month(d0)), 72) END AS tenure_months,
         CASE WHEN year(d1)*12 + month(d1) < 2000*12 + 9 THEN 1 ELSE 0 END AS churn_value
  FROM customer c LEFT JOIN o ON o.k = c.c_custkey),
snap AS (
SELECT k AS customerid, c_nationkey AS state,
  CASE WHEN k % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
  CASE WHEN k % 6 = 0 THEN 'Yes' ELSE 'No' END AS senior_citizen,
  CASE WHEN k % 7 < 3 THEN 'Yes' ELSE 'No' END AS partner,
  CASE WHEN k % 13 < 3 THEN 'Yes' ELSE 'No' END AS dependents,
  tenure_months,
  CASE WHEN (k % 10) < 3 + 5*churn_value THEN 'Month-to-month' WHEN k % 3 = 0 THEN 'One year' ELSE 'Two year' END AS contract,
  CASE WHEN k % 5 < 3 THEN 'Yes' ELSE 'No' END AS paperless_billing,
  CASE k % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check' WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS payment_method,
  coalesce(CAST(round(rev_cents / 250000.0 / n_orders, 2) AS DOUBLE), 0.0) AS monthly_charges,
  CASE WHEN tenure_months = 0 THEN ' ' ELSE CAST(CAST(rev_cents // 100000 AS BIGINT) AS VARCHAR) END AS total_charges,
  CASE WHEN k % 10 = 9 THEN 'No' ELSE 'Yes' END AS phone_service,
  CASE WHEN k % 10 = 9 THEN 'No phone service' WHEN k % 3 = 1 THEN 'Yes' ELSE 'No' END AS multiple_lines,
  CASE WHEN k % 9 < 4 THEN 'Fiber optic' WHEN k % 9 < 7 THEN 'DSL' ELSE 'No' END AS internet_service,
  CASE WHEN k % 9 >= 7 AND k % 4 <> 0 THEN 'No internet service' WHEN k % 11 < 4 THEN 'Yes' ELSE 'No' END AS online_security,
  CASE WHEN k % 9 >= 7 THEN 'No internet service' WHEN k % 17 < 7 THEN 'Yes' ELSE 'No' END AS online_backup,
  CASE WHEN k % 9 >= 7 THEN 'No internet service' WHEN k % 19 < 8 THEN 'Yes' ELSE 'No' END AS device_protection,
  CASE WHEN k % 9 >= 7 THEN 'No internet service' WHEN k % 23 < 8 THEN 'Yes' ELSE 'No' END AS tech_support,
  CASE WHEN k % 9 >= 7 THEN 'No internet service' WHEN k % 29 < 14 THEN 'Yes' ELSE 'No' END AS streaming_tv,
  CASE WHEN k % 9 >= 7 THEN 'No internet service' WHEN k % 31 < 15 THEN 'Yes' ELSE 'No' END AS streaming_movies,
  churn_value, CASE WHEN churn_value = 1 THEN 'Yes' ELSE 'No' END AS churn_label,
  CAST(floor(c_acctbal / 2) AS BIGINT) + 2000 AS cltv,
  CASE WHEN churn_value = 1 THEN 'Competitor' END AS churn_reason,
  CAST(((k * 7919) % 60 + 30*churn_value + 5) / 100.0 AS DOUBLE) AS y_score
FROM b)"""


def canon(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.CANONICAL.items())
    return f"CASE lower(trim({col})) {whens} ELSE trim({col}) END"


def _addon(c: str) -> str:
    return (f"CASE WHEN internet_service = 'No' THEN 'No' "
            f"WHEN {c} = 'No internet service' THEN 'No' ELSE {c} END AS {c}")


_other = [c for c in S.CATEGORICAL_INPUTS if c not in S.INTERNET_ADDONS and c != "multiple_lines"]

CLEAN = SNAPSHOT + """,
c1 AS (SELECT * REPLACE (TRY_CAST(total_charges AS DOUBLE) AS total_charges) FROM snap),
med AS (SELECT quantile_cont(total_charges, 0.5) AS median FROM c1),
c2 AS (SELECT c1.* REPLACE (coalesce(total_charges, med.median) AS total_charges) FROM c1, med),
clean AS (SELECT customerid, state, """ + ", ".join(_other) + """, tenure_months,
  monthly_charges, total_charges,
  CASE WHEN multiple_lines = 'No phone service' THEN 'No' ELSE multiple_lines END AS multiple_lines,
  """ + ",\n  ".join(_addon(c) for c in S.INTERNET_ADDONS) + """,
  churn_value, churn_label, cltv, churn_reason, y_score FROM c2)"""

_num_services = " + ".join(f"(CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END)" for c in S.SERVICE_COLS)
TENURE_GROUP = ("CASE WHEN tenure_months IS NULL OR tenure_months < 0 THEN 'nan' "
                "WHEN tenure_months <= 12 THEN 'novo' WHEN tenure_months <= 48 THEN 'medio' "
                "ELSE 'longo' END")

FEAT = CLEAN + """,
feat AS (SELECT *,
  CAST(""" + _num_services + """ AS INTEGER) AS num_services,
  round_even(monthly_charges / (tenure_months + 1), 4) AS charges_per_month,
  CASE WHEN contract = 'Month-to-month' THEN 1 ELSE 0 END AS is_month_to_month,
  """ + TENURE_GROUP + """ AS tenure_group,
  CASE WHEN online_security = 'Yes' OR tech_support = 'Yes' THEN 1 ELSE 0 END AS has_security_support,
  CASE WHEN internet_service = 'Fiber optic' THEN 1 ELSE 0 END AS is_fiber_optic
FROM clean)"""

SCORES = SNAPSHOT + """,
scores AS (
  SELECT 'vendor' AS model, CAST(customerid AS BIGINT) AS id, CAST(churn_value AS INTEGER) AS label,
         y_score AS score FROM snap
  UNION ALL
  SELECT 'lineitem' AS model, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS id,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_discount * 10 AS score
  FROM lineitem)"""


def with_(ctes: str, body: str) -> str:
    sql = "WITH " + ctes.strip() + "\n" + body
    # "column" (the long-form key) is a reserved word in DuckDB: quote it
    return re.sub(r"(?<![\'\"\w])column(?![\'\"\w])", '"column"', sql)


def round_cols(sql: str, cols, digits: int = 6) -> str:
    """Wrap a statement so the named double columns are rounded."""
    rep = ", ".join(f"round(CAST({c} AS DOUBLE), {digits}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) _r"


def long_sql(table: str, cols, keep=(), cast: str = "DOUBLE") -> str:
    """UNION ALL long form (keep..., column, value) of a table."""
    k = "".join(f"{c}, " for c in keep)
    return "\n  UNION ALL ".join(
        f"SELECT {k}'{c}' AS column, CAST({c} AS {cast}) AS value FROM {table}" for c in cols)
