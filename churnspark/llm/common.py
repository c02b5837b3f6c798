"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.session import checkpoint_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the cluster's shared checkpoint folder and read it back.

    Columnar, so later readers prune columns; a lost executor costs a re-read
    of these files, never a recomputation of what stands before them.  Row ids
    made by ``monotonically_increasing_id`` are fixed from here on.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches of this session hold ``rows`` rows at most: the default of 10,000 whole texts is much for one task."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, label: str, key: str) -> DataFrame:
    """As ``written``, but dealt into buckets of ``key``, one for each shuffle partition, by the tasks that hold the rows.

    Nothing is shuffled to write it, and later joins and groupings on ``key``
    read it in place: only their other side moves.  The table's name is dropped
    from the catalogue at once; its files stay in the shared folder.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    df.write.option("path", f"{checkpoint_dir(spark)}/{name}").bucketBy(shuffle_partitions(spark), key).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out
