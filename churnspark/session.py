"""Session helpers: configuration for large jobs, and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces shuffle
# partitions at runtime, and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "churnspark",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings every job here expects."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.ui.enabled", "false")
    if master and master.startswith("local") and "spark__driver__memory" not in conf:
        # local mode: the driver JVM is the whole cluster
        b = b.config("spark.driver.memory", "16g")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir.

    Only in local mode (tests), where driver and executors are one process, is
    a private folder made when the setting is absent; on a cluster its absence
    is an error, since a machine-local folder would break later reads.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and current.isDefined():
        return current.get()
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="churnspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not current.isDefined():
        sc.setCheckpointDir(d)
    return d


#: Rows from which a table that is read many times is dealt to all cores.
DEALT_ROWS = 20_000


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as many parts as the session has cores, if ``rows``, its count, are many.

    A written part is one row group, and so one task of every later pass: a
    table left in the few parts that a window or join gave it keeps the other
    cores idle through all passes of a fit."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if rows > DEALT_ROWS else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Survives executor loss, and later readers prune columns and push filters
    down, which a row checkpoint does not allow.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
