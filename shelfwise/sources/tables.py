"""Reading and writing tables."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

GIVEN_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(root: str, name: str) -> str:
    """A table is either ``<root>/<name>.parquet`` (one file or folder) or ``<root>/<name>/``."""
    root = root.rstrip("/")
    single = f"{root}/{name}.parquet"
    if os.path.exists(single) or "://" in root:
        return single
    return f"{root}/{name}"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """S3: read one table; projection and filters are pushed into the parquet scan by Catalyst."""
    return spark.read.parquet(table_path(root, name))


def read_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """Scan every file matching a glob as one table."""
    return spark.read.parquet(pattern)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite",
                dealt: bool = False) -> None:
    """Write a table folder; ``partition_by`` lets later as-of filters prune folders.

    ``dealt`` says that the rows of a partition value already lie together (read from a table partitioned alike, or
    rebalanced before): they are written where they are."""
    if partition_by and not dealt:
        # AQE rebalance: rows of a partition value meet in few tasks (few files per folder), while
        # skewed values are split and tiny ones coalesced (no single-task week at scale)
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
