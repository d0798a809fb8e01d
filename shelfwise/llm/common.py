"""Helpers shared by the training-data operators."""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

ARROW_ROWS = 2000
_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> str:
    """Ship the package to the Python workers once per application, bound the Arrow batches that hold
    whole texts, and return the shared folder for intermediate tables."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        top = os.path.dirname(package)
        target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="llm-ship-")), "llm_package.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(package):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, top))
        sc.addPyFile(target)
        _SHIPPED.add(sc.applicationId)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return ensure_checkpoint_dir(spark).rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{prepare(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names starting with ``bases`` that clash with no column of ``df`` (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for b in bases:
        while b.lower() in taken:
            b += "_"
        taken.add(b.lower())
        out.append(b)
    return out


def long_id(name: str = "doc_id"):
    return F.col(name).cast("long").alias(name)


def smallest_hashes(keys: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` distinct values of the single long column of ``keys``, those that come first in a fixed
    pseudo-random order. A threshold on that order leaves about twice as many values before they meet in one task."""
    name, = keys.columns
    order = F.pmod(F.xxhash64(name), F.lit(1 << 40))
    n = keys.agg(F.approx_count_distinct(name, 0.02)).first()[0]
    some = keys.where(order < int(min(1.0, 2.0 * limit / max(n, 1) + 64.0 / max(n, 1)) * (1 << 40)))
    return some.distinct().orderBy(order, name).limit(limit)
