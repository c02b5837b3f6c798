"""Sources and sinks.

Writes go through Spark's committers; checked writes re-read what was
written and compare row count and schema (a job, not a driver copy).
Prediction sinks overwrite only their own date partition, so a retried
nightly run replaces its output instead of duplicating it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingInputError(FileNotFoundError):
    pass


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: T.StructType | None = None, header: bool = True) -> DataFrame:
    """Read the raw customer file with an explicit schema (never inferred)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", header).option("inferSchema", False)
    if fmt == "json":
        r = r.option("multiLine", False)
    return r.load(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan."""
    return spark.read.parquet(path)


def require_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Fail early, listing every missing input."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if not hp.getFileSystem(conf).exists(hp):
            missing.append(p)
    if missing:
        raise MissingInputError(f"missing inputs: {missing}")


def write_checked(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> dict:
    """S3: parquet sink, then read back and compare rows and schema."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    back = df.sparkSession.read.parquet(path)
    n_in, n_out = df.count(), back.count()
    same_cols = sorted(df.columns) == sorted(back.columns)
    if n_in != n_out or not same_cols:
        raise IOError(f"read-back mismatch at {path}: rows {n_in} vs {n_out}, columns equal={same_cols}")
    return {"rows": n_out, "columns": len(back.columns)}


def write_vectors(df: DataFrame, path: str, features: str = "features", label: str = "churn_value",
                  width: int | None = None) -> dict:
    """float32 matrix sink: ``features array<float>`` + label (float),
    checked for width and nulls after writing."""
    out = df.select(vector_to_array(F.col(features), "float32").alias("features"),
                    F.col(label).cast("float").alias("label"))
    out.write.mode("overwrite").parquet(path)
    return check_matrix(df.sparkSession.read.parquet(path), width)


def read_vectors(spark: SparkSession, path: str, width: int | None = None) -> DataFrame:
    """Scan + shape/dtype check."""
    df = spark.read.parquet(path)
    check_matrix(df, width)
    return df


def check_matrix(df: DataFrame, width: int | None) -> dict:
    t = df.schema["features"].dataType
    if not (isinstance(t, T.ArrayType) and isinstance(t.elementType, T.FloatType)):
        raise TypeError(f"features must be array<float>, got {t.simpleString()}")
    r = df.agg(F.count(F.lit(1)).alias("rows"), F.min(F.size("features")).alias("w0"),
               F.max(F.size("features")).alias("w1"),
               F.count_if(F.col("label").isNull()).alias("null_labels")).first()
    if r["w0"] != r["w1"] or (width is not None and r["w0"] != width) or r["null_labels"]:
        raise ValueError(f"matrix check failed: {r.asDict()}")
    return {"rows": r["rows"], "width": r["w0"]}


def write_report_csv(df: DataFrame, path: str) -> None:
    """CSV report (small result tables only: one file)."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_report_json(df: DataFrame, path: str) -> None:
    """JSON report sink (one JSON object per row, one file)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def to_json_record(df: DataFrame, name: str = "report") -> DataFrame:
    """S6 helper: the whole (small) result as one nested JSON string."""
    return df.agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias(name))


def read_params(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Tuned parameters of one model from a nested JSON file; clear
    errors for a missing file or key."""
    try:
        d = spark.read.option("multiLine", True).json(path)
    except AnalysisException as e:
        raise MissingInputError(f"parameter file not found: {path}") from e
    if key not in d.columns:
        raise KeyError(f"model {key!r} not in {path}")
    inner = d.select(f"{key}.*")
    if "best_params" not in inner.columns:
        raise KeyError(f"{key}.best_params missing in {path}")
    return d.select(f"{key}.best_params.*")


def layer_dims(params: DataFrame) -> DataFrame:
    """Layer list from flat tuned parameters (n_layers, dim_0, ...)."""
    dims = [c for c in params.columns if c.startswith("dim_")]
    m = F.create_map(*[x for c in dims for x in (F.lit(c), F.col(c).cast("int"))])
    idx = F.sequence(F.lit(0), F.col("n_layers").cast("int") - 1)
    return params.select(F.transform(idx, lambda i: F.element_at(m, F.concat(F.lit("dim_"), i.cast("string"))))
                         .alias("layers"))


def save_pipeline(model, path: str) -> None:
    """ML writer (overwrite)."""
    model.write().overwrite().save(path)


def load_pipeline(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def verify_reload(original, reloaded, df: DataFrame, key: str, col: str = "features",
                  atol: float = 1e-10) -> float:
    """Same output after reload: join on the key, max |difference|."""
    a = original.transform(df).select(key, vector_to_array(col).alias("a"))
    b = reloaded.transform(df).select(key, vector_to_array(col).alias("b"))
    d = a.join(b, key).select(F.array_max(F.zip_with("a", "b", lambda x, y: F.abs(x - y))).alias("d"))
    m = d.agg(F.max("d")).first()[0] or 0.0
    if m > atol:
        raise AssertionError(f"reloaded pipeline differs by {m}")
    return m


def reload_check(model, path: str, df: DataFrame, key: str, col: str, atol: float = 1e-10) -> DataFrame:
    """Save a fitted stage or pipeline, load it, and compare vector
    column ``col`` of both on every row of ``df``: one row ``rows, max_diff, same``.
    ``key`` must be unique.  A row that only one of the two returns, a vector of
    another length and a NaN on one side count as different."""
    from pyspark.ml import PipelineModel
    save_pipeline(PipelineModel(stages=[model]), path)
    again = load_pipeline(path)
    a = model.transform(df).select(key, vector_to_array(col).alias("a"))
    b = again.transform(df).select(key, vector_to_array(col).alias("b"))
    off = F.aggregate(F.zip_with("a", "b", lambda x, y: F.when(x.eqNullSafe(y), 0.0).otherwise(F.abs(x - y))),
                      F.lit(0.0), lambda m, x: F.greatest(m, F.coalesce(x, F.lit(float("inf")))))
    d = a.join(b, key, "full").select(F.coalesce(off, F.lit(float("inf"))).alias("d"))
    return d.agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.max("d").alias("max_diff"),
                 (F.coalesce(F.max("d"), F.lit(0.0)) <= atol).alias("same"))


def file_md5(spark: SparkSession, path: str) -> DataFrame:
    """MD5 of files (binaryFile source; one row per file)."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.md5("content").alias("md5"))


def fingerprint(df: DataFrame, label: str | None = None) -> DataFrame:
    """Order-free table fingerprint: rows, columns, xor of row hashes,
    positive rate."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("rows"), F.lit(len(df.columns)).alias("cols"),
            F.bit_xor(F.xxhash64(*[F.col(c) for c in df.columns])).alias("content_hash")]
    if label:
        aggs.append(F.avg(F.col(label).cast("double")).alias("positive_rate"))
    return df.agg(*aggs)


def parse_records(df: DataFrame, json_col: str = "value") -> DataFrame:
    """JSON records (19- or 33-field form, any key spelling) -> columns.

    Keys are snake_cased and aliased; values stay text until validation."""
    from churnspark.operators.clean import snake_key
    from churnspark.schemas import INPUT_FIELDS, KEY_ALIASES
    m = F.from_json(F.col(json_col), T.MapType(T.StringType(), T.StringType()))
    # normalise keys inside the map: lower snake case + aliases, by expression
    keys = F.map_keys(m)
    norm = F.transform(keys, snake_key)

    def alias_fn(a, b):
        return lambda k: F.when(k == a, F.lit(b)).otherwise(k)
    for a, b in KEY_ALIASES.items():
        norm = F.transform(norm, alias_fn(a, b))
    nm = F.map_from_arrays(norm, F.map_values(m))
    x = df.withColumn("_m", nm)
    return x.select(*[c for c in df.columns if c != json_col],
                    *[F.element_at(F.col("_m"), F.lit(f)).alias(f) for f in INPUT_FIELDS])


def write_predictions(df: DataFrame, path: str, date_col: str = "score_date") -> None:
    """Dated prediction sink; dynamic partition overwrite replaces only
    the dates present, so re-running a day is idempotent."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(date_col).parquet(path))


RUNS_SCHEMA = "run_id string, model string, started_at timestamp, params map<string,string>, tags map<string,string>"
METRICS_SCHEMA = "run_id string, step int, name string, value double"


def log_run(spark: SparkSession, root: str, run_id: str, model: str, params: Mapping[str, object],
            metrics: Mapping[str, float] | Sequence[tuple[int, str, float]], tags: Mapping[str, str] | None = None) -> None:
    """Experiment log as two appendable tables: runs and metrics."""
    import datetime as _dt
    run = spark.createDataFrame([(run_id, model, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
                                  {k: str(v) for k, v in params.items()}, dict(tags or {}))], RUNS_SCHEMA)
    rows = ([(run_id, 0, k, float(v)) for k, v in metrics.items()] if isinstance(metrics, Mapping)
            else [(run_id, int(s), n, float(v)) for s, n, v in metrics])
    run.write.mode("append").parquet(f"{root}/runs")
    spark.createDataFrame(rows, METRICS_SCHEMA).write.mode("append").parquet(f"{root}/metrics")


def search_runs(spark: SparkSession, root: str, names: Sequence[str], where=None) -> DataFrame:
    """Runs filtered by tag/param predicate with their final metrics pivoted."""
    runs = spark.read.parquet(f"{root}/runs")
    if where is not None:
        runs = runs.where(where)
    m = spark.read.parquet(f"{root}/metrics")
    last = m.groupBy("run_id", "name").agg(F.max_by("value", "step").alias("value"))
    p = last.groupBy("run_id").pivot("name", list(names)).agg(F.first("value"))
    return runs.join(p, "run_id", "left")


def profile_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows, columns and nulls before vs after a step (two one-row aggs)."""
    def one(df, tag):
        return df.agg(F.count(F.lit(1)).cast("bigint").alias(f"rows_{tag}"),
                      sum(F.count_if(F.col(c).isNull()) for c in df.columns).cast("bigint").alias(f"nulls_{tag}")
                      ).withColumn(f"cols_{tag}", F.lit(len(df.columns)))
    a, b = one(before, "before"), one(after, "after")
    j = a.withColumn("_j", F.lit(1)).join(F.broadcast(b.withColumn("_j", F.lit(1))), "_j").drop("_j")
    return j.withColumns({"rows_removed": F.col("rows_before") - F.col("rows_after"),
                          "nulls_removed": F.col("nulls_before") - F.col("nulls_after")})
