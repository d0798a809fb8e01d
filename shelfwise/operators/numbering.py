"""Consecutive numbers in a global order without a global window."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def number_rows(df: DataFrame, order: list[Column], name: str = "n") -> DataFrame:
    """``df`` with ``name`` = 1, 2, ... in ``order`` (which should be unique).

    Rows are dealt by range of the order and sorted per partition, written once to the shared folder with
    their place in their partition; a partition's offset is the row count of those before it (one row per
    partition). The write fixes the ranges, so a recomputed task cannot number rows differently.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/numbered-{uuid.uuid4().hex}"
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_size")).select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))  # a row per partition
    return (rows.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + F.col("_place") + 1).drop("_part", "_place", "_offset"))
