"""Registry of named queries: each is a Spark callable ``(spark, sf_dir) ->
DataFrame`` plus (where SQL can state it) the equivalent DuckDB SQL over the
same parquet tables.  Column names are aliased identically on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``sql`` is its DuckDB oracle."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from churnspark.plans import q_core, q_eval, q_profile, q_business, q_monitor, q_ml, q_stream, q_jobs, q_checks  # noqa: F401


def rounded(df, cols, digits: int = 6):
    """Round the named double columns (results compared across engines)."""
    from pyspark.sql import functions as F
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})
