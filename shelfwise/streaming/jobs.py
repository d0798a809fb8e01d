"""Runnable streaming jobs: start, drain (availableNow) and read back the published results."""
from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..session import ensure_checkpoint_dir, ship_package
from . import pos


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (on a cluster the folder that spark.checkpoint.dir names)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/stream-{name}-{uuid.uuid4().hex[:12]}"


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB (on the executors' disks, not their heap)."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def _drain(spark: SparkSession, writer: DataStreamWriter, root: str) -> None:
    with rocksdb_state(spark):
        q = writer.option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start()
        q.awaitTermination()


def run_units_per_tick(spark: SparkSession, events_folder: str, glob: str = "events*.parquet", lateness: str = "2 hours") -> DataFrame:
    """T1 + T2: drain the event files through the tick aggregate; an event delivered again counts once.

    Update mode keyed by tick: a batch publishes only the ticks it changed, each with its new totals, and the
    watermark lets the state of closed ticks go; readers take the newest batch of each tick. A row later than
    the watermark starts a tick anew in no case: it is dropped by the aggregate, as the watermark promises.
    """
    root = scratch(spark, "ticks")
    out = f"{root}/ticks"
    lines = pos.first_deliveries(pos.pos_lines(pos.read_events_stream(spark, events_folder, glob)), lateness)
    _drain(spark, pos.units_per_tick(lines).writeStream.outputMode("update")
           .foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch_id={i}")), root)
    rows = spark.read.schema("tick_start timestamp, units long, revenue double, batch_id long").parquet(out)
    newest = rows.groupBy("tick_start").agg(F.max_by(F.struct("units", "revenue"), "batch_id").alias("s"))
    return newest.select("tick_start", "s.units", "s.revenue")


def run_listing_state(spark: SparkSession, events_folder: str, glob: str = "events*.parquet", lateness: str = pos.LATENESS,
                      idle_ticks: int = pos.IDLE_TICKS, attributes: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """T3 + T7: drain the events through the per-listing state and return the latest published raw state, with the
    listing attributes that ``attributes`` joined to every micro-batch (T11)."""
    ship_package(spark)
    root = scratch(spark, "state")
    pub = pos.StatePublisher(f"{root}/state", attributes=attributes, attribute_schema=pos.ATTRIBUTES if attributes else None)
    lines = pos.first_deliveries(pos.pos_lines(pos.read_events_stream(spark, events_folder, glob)), lateness)
    _drain(spark, pos.listing_state_updates(lines, idle_ticks).writeStream.outputMode("update").foreachBatch(pub), root)
    state = pub.current(spark)
    return spark.createDataFrame([], pos.OUT_SCHEMA) if state is None else state


def live_state(spark: SparkSession, raw: DataFrame, universe: DataFrame | None = None, last_ticks: bool = False) -> DataFrame:
    """T5 + T6 on the published raw state, against the global current and first tick; ``universe`` gives the listing
    attributes where the stream has not joined them (T11)."""
    cur = raw.select(F.max(F.array_max("hist_ticks"))).scalar()   # uncorrelated scalar subqueries
    first = raw.select(F.min("first_tick")).scalar()
    more = [F.array_max("hist_ticks").alias("last_tick")] if last_ticks else []
    return pos.derive_state(raw.withColumn("current_tick", cur).withColumn("stream_first_tick", first), universe, *more)


def run_visitor_sessions(spark: SparkSession, events_folder: str, glob: str = "events*.parquet", lateness: str = "2 hours",
                         gap: str = pos.SESSION_GAP) -> DataFrame:
    """T1 + T12: drain the event files through the session window (append mode: each session once, when it is over).

    The watermark stops at the newest event, so the feed is closed by a clock row behind it, which lands in a folder
    of its own after the events and belongs to no user; it lets the watermark pass the last sessions.
    """
    root = scratch(spark, "sessions")
    clock, out = f"{root}/clock", f"{root}/sessions"
    spark.createDataFrame([], pos.EVENT_SCHEMA).write.parquet(clock)

    def drain() -> None:
        events = pos.read_events_stream(spark, events_folder, glob).unionByName(pos.read_events_stream(spark, clock, "*.parquet"))
        sessions = pos.visitor_sessions(pos.first_deliveries(pos.visits(events), lateness), gap)
        _drain(spark, sessions.writeStream.outputMode("append").format("parquet").option("path", out), root)
    drain()
    span = F.expr(f"INTERVAL {lateness}") + F.expr(f"INTERVAL {gap}") + F.expr("INTERVAL 1 second")
    events = spark.read.schema(pos.EVENT_SCHEMA).option("pathGlobFilter", glob).parquet(events_folder)
    end = events.agg(F.max("ts").alias("ts")).where("ts IS NOT NULL").select(
        F.lit(None).cast("long").alias("event_id"), (F.col("ts") + span).alias("ts"), F.lit(None).cast("long").alias("user_id"),
        F.lit(pos.CLOCK).alias("event_type"), F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("props"))
    end.write.mode("append").parquet(clock)
    drain()
    return spark.read.schema("user_id long, session_start timestamp, session_end timestamp, n_events long, units long, revenue double").parquet(out)


def land_twice(events: DataFrame, files: int) -> str:
    """A landing folder that holds every event file of ``events`` twice, as a feed with replays leaves it."""
    folder = scratch(events.sparkSession, "landing")
    rows = events.select(*[F.col(f.name).cast(f.dataType) for f in pos.EVENT_SCHEMA.fields])
    for _ in range(2):
        rows.repartitionByRange(files, "ts").sortWithinPartitions("ts").write.mode("append").parquet(folder)
    return folder
