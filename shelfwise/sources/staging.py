"""Tables derived once per application and written to the shared folder.

The retail schema is derived from the given tables once: the sales lines, the
dimensions, weekly demand and the marts that many queries read are written as
parquet and read back, so a query scans them instead of deriving them from
``lineitem`` again. A written table is found by the application, the source
folder, the scenario and a fingerprint of the source files (path, length and
modification time of each), so changed sources are derived anew.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .tables import table_path

_WRITTEN: dict[tuple, tuple] = {}


def source_files(spark: SparkSession, root: str, names: list[str]) -> tuple[tuple, dict[str, int]]:
    """A fingerprint of the source files' metadata, and the bytes of each table; file contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load([table_path(root, n) for n in names]).select("path", "modificationTime", "length"))
    table = F.regexp_extract("path", r"/([a-z]+)(?:\.parquet)?(?:/[^/]*)?$", 1)
    rows = files.groupBy(table.alias("name")).agg(
        F.sum("length").alias("size"), F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)")).alias("mark")).collect()
    return tuple(sorted((r.name, r.size, r.mark) for r in rows)), {r.name: r.size for r in rows}


SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false",
            "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}


@contextmanager
def written_with(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The session with ``settings`` while a derived table is planned and written; the values before come back.

    Joins and windows on more columns than those that rows are bucketed by then run where the rows lie, whatever the
    session says (``session.build_session`` sets it, other sessions have Spark's default), and time stamps are written
    as numbers."""
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def once(spark: SparkSession, key: tuple, name: str, build: Callable[[], DataFrame], bucket_by: list[str] | None = None,
         sort_by: list[str] | None = None) -> DataFrame:
    """The table ``name`` of the source ``key``: written on first use, read back afterwards.

    ``bucket_by`` writes a catalog table bucketed and sorted by those columns, as many buckets as shuffle partitions:
    aggregates, joins and windows over them in later jobs need no exchange. Build it with ``repartition`` on the
    same columns, so that a bucket is one file."""
    at = (spark.sparkContext.applicationId, *key, name)
    if at not in _WRITTEN:
        mark = uuid.uuid4().hex
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/derived-{name}-{mark}"
        with written_with(spark, SETTINGS):
            df = build()
            if bucket_by:
                table = f"derived_{name}_{mark}"
                buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
                (df.write.format("parquet").bucketBy(buckets, *bucket_by).sortBy(*bucket_by, *(sort_by or []))
                 .option("path", path).saveAsTable(table))
                _WRITTEN[at] = (table, None)
            else:
                df.write.parquet(path)
                _WRITTEN[at] = (path, df.schema)
    where, schema = _WRITTEN[at]
    return spark.table(where) if schema is None else spark.read.schema(schema).parquet(where)
