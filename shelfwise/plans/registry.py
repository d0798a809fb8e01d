"""Registry of named queries: a Spark plan and, where SQL can express it, its DuckDB oracle."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..oracle.fixture_sql import with_fixture

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
FLOAT_DIGITS = 6


def register(name: str, sql: str | None = None, round_cols: tuple = (), extra_ctes: dict | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``round_cols`` are double columns rounded to FLOAT_DIGITS on both sides, so
    summation order cannot change the compared values.
    """
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            if round_cols:
                df = df.withColumns({c: F.round(F.col(c), FLOAT_DIGITS) for c in round_cols})
            return df
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            body = sql
            if round_cols:
                repl = ", ".join(f"ROUND({c}, {FLOAT_DIGITS}) AS {c}" for c in round_cols)
                body = f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) q"
            ORACLE[name] = with_fixture(body, extra_ctes)
        return run
    return deco
