"""Sources and sinks (S operators) on small frames in a private folder."""
import json
import os
import tempfile

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from churnspark.sources import io as IO


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="cs-io-")


def test_write_checked_and_profile_delta(spark, tmp):
    df = spark.createDataFrame([(1, None), (2, 3.0)], "a int, b double")
    assert IO.write_checked(df, os.path.join(tmp, "t")) == {"rows": 2, "columns": 2}
    d = IO.profile_delta(df, df.dropna()).first()
    assert (d.rows_removed, d.nulls_removed) == (1, 1)


def test_vectors_roundtrip(spark, tmp):
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("features", VectorUDT()), T.StructField("churn_value", T.IntegerType())])
    df = spark.createDataFrame([(Vectors.dense([1.0, 2.0]), 1), (Vectors.sparse(2, [1], [5.0]), 0)], schema)
    assert IO.write_vectors(df, os.path.join(tmp, "v"), width=2) == {"rows": 2, "width": 2}
    back = IO.read_vectors(spark, os.path.join(tmp, "v"), width=2)
    assert sorted(r.features for r in back.collect()) == [[0.0, 5.0], [1.0, 2.0]]


def test_params_and_layers(spark, tmp):
    p = os.path.join(tmp, "params.json")
    json.dump({"MLP": {"best_params": {"n_layers": 2, "dim_0": 128, "dim_1": 64, "lr": 0.001},
                       "cv_best_value": 1.0}}, open(p, "w"))
    prm = IO.read_params(spark, p, "MLP")
    assert IO.layer_dims(prm).first().layers == [128, 64]
    with pytest.raises(KeyError):
        IO.read_params(spark, p, "GBT")
    with pytest.raises(IO.MissingInputError):
        IO.read_params(spark, os.path.join(tmp, "nope.json"), "MLP")


def test_require_paths(spark, tmp):
    IO.require_paths(spark, [tmp])
    with pytest.raises(IO.MissingInputError):
        IO.require_paths(spark, [tmp, os.path.join(tmp, "missing")])


def test_run_log_and_search(spark, tmp):
    IO.log_run(spark, tmp, "r1", "mlp", {"lr": 0.001}, {"roc_auc": 0.85, "recall": 0.99}, {"stage": "tuning"})
    IO.log_run(spark, tmp, "r2", "gbt", {"depth": 4}, [(0, "roc_auc", 0.80), (1, "roc_auc", 0.84)])
    s = {r.run_id: r for r in IO.search_runs(spark, tmp, ["roc_auc", "recall"]).collect()}
    assert s["r2"].roc_auc == 0.84 and s["r1"].recall == 0.99
    only = IO.search_runs(spark, tmp, ["roc_auc"], where=F.col("tags")["stage"] == "tuning").collect()
    assert [r.run_id for r in only] == ["r1"]


def test_prediction_sink_is_idempotent(spark, tmp):
    path = os.path.join(tmp, "pred")
    day = spark.createDataFrame([(1, 0.7, "2024-01-02"), (2, 0.1, "2024-01-02")], "id int, p double, score_date string")
    other = spark.createDataFrame([(3, 0.5, "2024-01-01")], "id int, p double, score_date string")
    IO.write_predictions(other, path)
    IO.write_predictions(day, path)
    IO.write_predictions(day, path)          # a retried run replaces its own date only
    back = spark.read.parquet(path)
    assert back.count() == 3 and back.where("score_date = '2024-01-01'").count() == 1


def test_parse_records_key_spellings(spark):
    js = spark.createDataFrame([('{"Gender": "Male", "TenureMonths": "5", "Monthly Charge": "9.5"}',)], "value string")
    r = IO.parse_records(js).first()
    assert (r.gender, r.tenure_months, r.monthly_charges) == ("Male", "5", "9.5")


def test_fingerprint_is_order_free(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (1, "x")], "k int, v string").repartition(3)
    assert IO.fingerprint(a).first() == IO.fingerprint(b).first()
