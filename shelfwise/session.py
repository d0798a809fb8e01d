"""Spark session settings for the planning jobs."""
from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "shelfwise",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with AQE, skew-join handling and UTC time.

    On a cluster `master` is None and the cluster's own settings win; local
    runs (tests, bench) pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # windows and joins on (location, sku) may reuse a (location, sku) partitioning
        # produced once upstream instead of re-shuffling on every key subset
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    It is the one that ``spark.checkpoint.dir`` names. Only a local run (one machine, so every folder is
    shared) may do without the setting and gets a scratch folder; on a cluster its absence is an error.
    """
    current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="shelfwise-ckpt-", dir=os.environ.get("SHELFWISE_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: a job may run with the package on the
    driver's path only."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="shelfwise-ship-")), "shelfwise_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
