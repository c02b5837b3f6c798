"""Driver contract and a representative set of Spark-vs-DuckDB oracles."""
import pytest

import __spark_entry__ as E

from conftest import SF01, rows

FAST = ["slice_churn_by_segment", "s1_snapshot", "p_clean_snapshot", "f7_features", "a1_confusion",
        "a4_roc_auc", "a5_average_precision", "a9_best_f1_threshold", "a13_best_threshold", "a17_net_value_curve",
        "b1_residual_clv", "b9_top_lift", "d3_numeric_profile", "d6_histogram", "d15_mann_whitney",
        "d16_chi2_assoc", "d18_binned_rate", "d21_vif", "r1_psi", "r4_ks_drift", "r8_attach_outcome",
        "r14_failure_runs", "r23_sessions", "v3_fold_sizes", "i8_contact_list_by_segment"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["contract", "tenure_group", "n_customers", "n_churned", "churn_rate",
                          "mrr_at_risk", "residual_clv_at_risk"]
    assert df.count() > 0


#: Operators without a query of their own name: helpers on the driver, and parts that other queries run.
UNNAMED = ("S2 S12 S14 S17 P3 P8 P14 P21 P22 F2 F3 F4 F5 F6 F9 E2 E6 V8 I4 I10 A3 A19 B8 B10 B20 R2").split()


def test_every_query_has_a_callable_and_oracles_are_known():
    q, o = E.queries(), E.oracle_sql()
    assert len(q) >= 150
    assert set(o) <= set(q)


def test_every_operator_has_its_query():
    """By the IDs of the coverage list, so that a lost registration is seen."""
    import os
    import re
    named = {t.upper() for n in E.queries() for t in re.findall(r"(?:^|_)([spfevmiabdr]\d{1,2})(?=_|$)", n)}
    text = open(os.path.join(os.path.dirname(E.__file__), "COVERAGE.md")).read()
    ids = re.findall(r"^- \*\*([A-Z]\d+)\*\*", text, flags=re.M)
    assert len(ids) == 195 and [i for i in ids if i not in named] == UNNAMED


@pytest.mark.parametrize("name", FAST)
def test_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF01)
    cur = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows(df) == rows(cur.fetchall(), cols)
