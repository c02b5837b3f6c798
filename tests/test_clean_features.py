"""Cleaning, validation and feature rules (one-row literal cases)."""
import pytest
from pyspark.sql import functions as F

from churnspark import schemas as S
from churnspark.functions import features as FT
from churnspark.operators import clean as C


@pytest.mark.parametrize("raw,snake", [
    ("TenureMonths", "tenure_months"), ("Monthly Charges", "monthly_charges"), ("Churn Value", "churn_value"),
    ("PhoneService", "phone_service"), ("  Total  Charges  ", "total_charges"), ("CustomerID", "customer_id"),
    ("Zip-Code", "zip_code")])
def test_snake_case(raw, snake):
    assert C.to_snake(raw) == snake


def _rec(spark, **over):
    base = {"gender": "Male", "senior_citizen": "No", "partner": "Yes", "dependents": "No", "tenure_months": 24,
            "phone_service": "Yes", "multiple_lines": "No", "internet_service": "Fiber optic",
            "online_security": "No", "online_backup": "Yes", "device_protection": "No", "tech_support": "No",
            "streaming_tv": "Yes", "streaming_movies": "No", "contract": "Month-to-month",
            "paperless_billing": "Yes", "payment_method": "Electronic check", "monthly_charges": 65.0,
            "total_charges": 1560.0}
    base.update(over)
    return spark.createDataFrame([tuple(base[c] for c in S.INPUT_FIELDS)], S.RECORD_SCHEMA)


def test_feature_row(spark):
    r = FT.add_features(_rec(spark)).first()
    assert (r.num_services, r.charges_per_month, r.is_month_to_month, r.tenure_group,
            r.has_security_support, r.is_fiber_optic) == (3, 2.6, 1, "medio", 0, 1)


@pytest.mark.parametrize("t,g", [(0, "novo"), (12, "novo"), (13, "medio"), (48, "medio"), (49, "longo"), (-1, "nan")])
def test_tenure_edges(spark, t, g):
    assert FT.add_features(_rec(spark, tenure_months=t)).first().tenure_group == g


def test_numpy_rounding_rule(spark):
    df = spark.createDataFrame([(91.17, 71)], "monthly_charges double, tenure_months int")
    assert df.select(FT.charges_per_month().alias("c")).first().c == 1.2663


def test_no_service_and_inconsistent(spark):
    df = spark.createDataFrame([("DSL", "No internet service", "Yes"), ("No", "Yes", None)],
                               "internet_service string, online_security string, tech_support string")
    out, cnt = C.normalize_no_service(df, ["online_security", "tech_support", "missing_col"])
    assert [tuple(r) for r in out.collect()] == [("DSL", "No", "Yes"), ("No", "Yes", None)]
    assert cnt.first().online_security == 1
    fixed, c2 = C.fix_inconsistent_services(out, cols=["online_security", "tech_support"])
    assert [tuple(r) for r in fixed.collect()][1] == ("No", "No", "No")
    assert (c2.first().online_security, c2.first().tech_support) == (1, 1)   # null counts as inconsistent


def test_canonicalize(spark):
    df = spark.createDataFrame([(" yes ", "FIBER OPTIC", "month-to-month", "Weird")],
                               "partner string, internet_service string, contract string, gender string")
    r = C.canonicalize(df).first()
    assert tuple(r) == ("Yes", "Fiber optic", "Month-to-month", "Weird")


@pytest.mark.parametrize("field,value", [("gender", "Other"), ("tenure_months", 73), ("monthly_charges", -1.0),
                                         ("contract", "Weekly"), ("payment_method", "Crypto"),
                                         ("senior_citizen", "Maybe"), ("internet_service", "5G")])
def test_validate_rejects(spark, field, value):
    ok, bad = C.validate(_rec(spark, **{field: value}))
    assert ok.count() == 0
    assert [e.field for e in bad.first().errors] == [field]


@pytest.mark.parametrize("over", [{"tenure_months": 0}, {"total_charges": 0.0},
                                  {"online_backup": "No internet service"},
                                  {"internet_service": "No", "online_security": "Yes"}])
def test_validate_accepts(spark, over):
    ok, bad = C.validate(_rec(spark, **over))
    assert ok.count() == 1 and bad.count() == 0


def test_audit_flag(spark):
    r = C.audit_internet(_rec(spark, internet_service="No", online_security="Yes")).first()
    assert r.audit_no_internet_active_addon is True


def test_contracts_raise(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(C.ContractError):
        C.check_coverage(df, {"g": ["a"]})
    with pytest.raises(C.ContractError):
        C.require_columns(df, ["a", "zz"])
    with pytest.raises(C.ContractError):
        C.check_shape(df, rows=10, tol=5)


def test_impute_median_audit(spark):
    df = spark.createDataFrame([(1.0, 5), (None, 0), (3.0, 7), (10.0, 9)], "total_charges double, tenure_months int")
    out, audit = C.impute_median(df)
    assert sorted(r.total_charges for r in out.collect()) == [1.0, 3.0, 3.0, 10.0]
    a = audit.first()
    assert (a.n_null, a.nulls_have_zero_tenure, a.median) == (1, True, 3.0)
