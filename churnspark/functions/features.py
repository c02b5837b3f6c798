"""Scalar feature functions (F1-F11): pure column expressions, so the whole
feature step fuses into the scan's whole-stage-codegen stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark import schemas as S


def _yes(c: str, v: str = "Yes") -> Column:
    # null compares false -> 0 (a missing service is not an active one)
    return F.coalesce((F.col(c) == v).cast("int"), F.lit(0))


def num_services(cols: Sequence[str] = S.SERVICE_COLS, present: Sequence[str] | None = None) -> Column:
    """how many of the service columns equal 'Yes'."""
    cols = [c for c in cols if present is None or c in present]
    out = F.lit(0)
    for c in cols:
        out = out + _yes(c)
    return out.cast("int")


def charges_per_month(monthly: str = "monthly_charges", tenure: str = "tenure_months") -> Column:
    """monthly / (tenure + 1), rounded to 4 decimals the NumPy way.

    NumPy rounds ``rint(x * 10**4) / 10**4`` (half-to-even on the binary
    product), which differs from ``bround`` (half-even on the decimal text)
    for values such as 1.26625; ``rint`` reproduces NumPy exactly."""
    return numpy_round(F.try_divide(F.col(monthly), F.col(tenure) + 1), 4)


def numpy_round(c: Column, digits: int) -> Column:
    """NumPy/pandas ``round``: rint(x * 10^d) / 10^d."""
    p = float(10 ** digits)
    return F.rint(c * p) / p


def flag_equals(col: str, value: str) -> Column:
    """1 if the column equals value (null -> 0)."""
    return _yes(col, value)


def bucket(col: str, edges: Sequence[float] = S.TENURE_EDGES,
           labels: Sequence[str] = S.TENURE_LABELS) -> Column:
    """right-closed bins [e0,e1], (e1,e2], ..., (e_last, inf); the first bin
    includes its low edge.  Values outside (or null) become the text 'nan'."""
    c = F.col(col)
    out = F.when(c.isNull() | (c < edges[0]), F.lit("nan"))
    for hi, lab in zip(list(edges[1:]), labels):
        out = out.when(c <= hi, F.lit(lab))
    return out.otherwise(F.lit(labels[len(edges) - 1]))


def flag_any(cols: Sequence[str], value: str = "Yes") -> Column:
    """1 if any of the columns equals value."""
    out = F.lit(False)
    for c in cols:
        out = out | F.coalesce(F.col(c) == value, F.lit(False))
    return out.cast("int")


def add_features(df: DataFrame) -> DataFrame:
    """all six derived features in one projection; originals kept."""
    return df.withColumns({
        "num_services": num_services(present=df.columns),
        "charges_per_month": charges_per_month(),
        "is_month_to_month": flag_equals("contract", "Month-to-month"),
        "tenure_group": bucket("tenure_months"),
        "has_security_support": flag_any(["online_security", "tech_support"]),
        "is_fiber_optic": flag_equals("internet_service", "Fiber optic"),
    })


class FeatureContractError(ValueError):
    pass


def feature_violations(df: DataFrame) -> DataFrame:
    """F8 as data: one aggregate of rule-violation counts (one row)."""
    rules = {"missing_" + c: F.col(c).isNull() for c in S.NEW_FEATURES}
    for c in S.PASS_PIPE:
        rules["not_binary_" + c] = ~F.col(c).isin(0, 1)
    rules["num_services_out_of_range"] = (F.col("num_services") < 0) | (F.col("num_services") > 7)
    rules["tenure_group_unknown"] = ~F.col("tenure_group").isin(*S.TENURE_LABELS)
    rules["charges_per_month_negative"] = F.col("charges_per_month") < 0
    return df.agg(*[F.count_if(F.coalesce(r, F.lit(False))).cast("bigint").alias(n)
                    for n, r in rules.items()])


def validate_features(df: DataFrame) -> None:
    """F8: raise if any output contract fails (present, no nulls, ranges)."""
    missing = [c for c in S.NEW_FEATURES if c not in df.columns]
    if missing:
        raise FeatureContractError(f"missing features: {missing}")
    row = feature_violations(df).first().asDict()
    bad = {k: v for k, v in row.items() if v}
    if bad:
        raise FeatureContractError(f"feature contract failed: {bad}")


def output_cols(df_cols: Sequence[str]) -> list[str]:
    """output column names of the feature stage."""
    return list(df_cols) + [c for c in S.NEW_FEATURES if c not in df_cols]


def yes_no_to_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Yes -> 1, No -> 0 (others null)."""
    return df.withColumns({c: F.when(F.col(c) == "Yes", 1).when(F.col(c) == "No", 0)
                           for c in cols})


def log1p_col(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """log1p of a column."""
    return df.withColumn(out or f"{col}_log", F.log1p(F.col(col)))
