"""Schemas, domains, cost models and other fixed values.

Everything in the "fixed values" blocks must equal the values the original
churn project uses, otherwise results differ.  They are stated once here, in
natural order, and every operator takes them as arguments (never as hidden
globals), so a caller can pass a different cost model or domain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Column groups of the customer snapshot
# --------------------------------------------------------------------------
TARGET = "churn_value"
KEY = "customerid"

NUMERIC_INPUTS = ["tenure_months", "monthly_charges", "total_charges"]

CATEGORICAL_INPUTS = [
    "gender", "senior_citizen", "partner", "dependents", "phone_service",
    "multiple_lines", "internet_service", "online_security", "online_backup",
    "device_protection", "tech_support", "streaming_tv", "streaming_movies",
    "contract", "paperless_billing", "payment_method",
]

# the 19 fields of one input record, in record order
INPUT_FIELDS = [
    "gender", "senior_citizen", "partner", "dependents", "tenure_months",
    "phone_service", "multiple_lines", "internet_service", "online_security",
    "online_backup", "device_protection", "tech_support", "streaming_tv",
    "streaming_movies", "contract", "paperless_billing", "payment_method",
    "monthly_charges", "total_charges",
]

# id / geography, label text and post-event leakage columns
ID_GEO_COLS = ["customerid", "customer_id", "count", "country", "state", "city", "zip_code",
               "lat_long", "latitude", "longitude"]
LEAKAGE_COLS = ["churn_label", "churn_score", "cltv", "churn_reason"]

# the six add-ons that depend on internet service
INTERNET_ADDONS = ["online_security", "online_backup", "device_protection",
                   "tech_support", "streaming_tv", "streaming_movies"]

# the seven services counted by num_services
SERVICE_COLS = ["phone_service", "online_security", "online_backup",
                "device_protection", "tech_support", "streaming_tv",
                "streaming_movies"]

# encoder groups
NUM_PIPE = ["tenure_months", "monthly_charges", "total_charges",
            "num_services", "charges_per_month"]
BINARY_PIPE = ["partner", "dependents", "phone_service", "multiple_lines",
               "online_security", "online_backup", "device_protection",
               "tech_support", "streaming_tv", "streaming_movies",
               "paperless_billing", "senior_citizen"]
ONEHOT_PIPE = ["internet_service", "contract", "payment_method", "gender",
               "tenure_group"]
PASS_PIPE = ["is_month_to_month", "has_security_support", "is_fiber_optic"]
NEW_FEATURES = ["num_services", "charges_per_month", "is_month_to_month",
                "tenure_group", "has_security_support", "is_fiber_optic"]
N_FEATURES = 30

# --------------------------------------------------------------------------
# Accepted domains of the input record
# --------------------------------------------------------------------------
YES_NO = ["Yes", "No"]
ADDON_VALUES = ["Yes", "No", "No internet service"]
DOMAINS = {
    "gender": ["Male", "Female"],
    "senior_citizen": YES_NO,
    "partner": YES_NO,
    "dependents": YES_NO,
    "phone_service": YES_NO,
    "paperless_billing": YES_NO,
    "multiple_lines": ["Yes", "No", "No phone service"],
    "internet_service": ["DSL", "Fiber optic", "No"],
    "online_security": ADDON_VALUES,
    "online_backup": ADDON_VALUES,
    "device_protection": ADDON_VALUES,
    "tech_support": ADDON_VALUES,
    "streaming_tv": ADDON_VALUES,
    "streaming_movies": ADDON_VALUES,
    "contract": ["Month-to-month", "One year", "Two year"],
    "payment_method": ["Electronic check", "Mailed check",
                       "Bank transfer (automatic)", "Credit card (automatic)"],
}
# numeric ranges, inclusive
RANGES = {
    "tenure_months": (0, 72),
    "monthly_charges": (0.0, 200.0),
    "total_charges": (0.0, 10000.0),
}

# --------------------------------------------------------------------------
# Canonical spelling (lower-cased key -> canonical value)
# --------------------------------------------------------------------------
CANONICAL = {
    "yes": "Yes",
    "no": "No",
    "male": "Male",
    "female": "Female",
    "dsl": "DSL",
    "fiber optic": "Fiber optic",
    "month-to-month": "Month-to-month",
    "one year": "One year",
    "two year": "Two year",
    "electronic check": "Electronic check",
    "mailed check": "Mailed check",
    "bank transfer (automatic)": "Bank transfer (automatic)",
    "credit card (automatic)": "Credit card (automatic)",
    "no phone service": "No phone service",
    "no internet service": "No internet service",
}
# key aliases (alternative snake_case name -> field)
KEY_ALIASES = {"monthly_charge": "monthly_charges"}

# --------------------------------------------------------------------------
# Tenure groups, thresholds, SLO
# --------------------------------------------------------------------------
TENURE_EDGES = [0, 12, 48]            # [0,12] novo, (12,48] medio, (48,inf) longo
TENURE_LABELS = ["novo", "medio", "longo"]
SLO_RECALL_MIN = 0.70
THRESHOLD_GRID = (5, 93)              # i/100 for i = 5..93 (89 points)
DEFAULT_THRESHOLD = 0.50
PRIORITY_TIERS = [(0.70, "high"), (0.50, "medium"), (0.30, "low")]
PSI_BANDS = [(0.10, "none"), (0.20, "moderate")]   # else "severe"
TENURE_BANDS = [(0, 6, "0-6"), (7, 12, "7-12"), (13, 24, "13-24"),
                (25, 48, "25-48"), (49, 72, "49-72")]
SCORE_BANDS = [(0.25, "<25"), (0.50, "25-50"), (0.75, "50-75")]  # else ">75"


@dataclass(frozen=True)
class CostModel:
    """Money per confusion cell: value = TP*v_tp + TN*v_tn + FN*v_fn + FP*v_fp."""

    v_tp: float
    v_tn: float
    v_fn: float
    v_fp: float

    @classmethod
    def clv_retention(cls, clv: float, retention: float) -> "CostModel":
        return cls(clv, retention, -clv, -retention)


# The three cost models that live side by side
DEFAULT_COSTS = CostModel.clv_retention(2845.00, 73.52)


@dataclass(frozen=True)
class CostConfig:
    """FP/FN cost annotation: total = FP*fp_cost + FN*fn_cost,
    avoided = TP*(clv - retention)."""

    clv: float = 1200.0
    retention: float = 80.0
    fp_cost: float = 80.0
    fn_cost: float = 1200.0


@dataclass(frozen=True)
class CampaignParams:
    """Net savings = TP*(CLV*r - C) - FP*C - FN*CLV."""

    clv: float = 2400.0
    contact_cost: float = 50.0
    retention_rate: float = 0.40


# --------------------------------------------------------------------------
# Explicit schemas (never inferred)
# --------------------------------------------------------------------------
RECORD_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType() if c == "tenure_months" else
                   T.DoubleType() if c in ("monthly_charges", "total_charges")
                   else T.StringType(), True) for c in INPUT_FIELDS])

SCORE_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("id", T.LongType(), False),
    T.StructField("label", T.IntegerType(), False),
    T.StructField("score", T.DoubleType(), False),
])

REQUEST_LOG_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("elapsed_ms", T.DoubleType()),
    T.StructField("ts", T.TimestampType()),
])

PREDICTION_LOG_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("churn_probability", T.DoubleType()),
    T.StructField("prediction", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

# Chi-square bounds of the 5 % level for 1, 2, ... degrees of freedom.
CHI2_05 = (3.841458820694124, 5.991464547107979, 7.814727903251179, 9.487729036781154)
