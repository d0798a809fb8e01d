"""Live point-of-sale monitor on Structured Streaming.

Source: event files of the ``events`` shape; a ``purchase`` event is one POS
sale of ``1 + event_id % 3`` units on listing ``user_id``. A listing is a
(store, SKU) pair of the static catalog. Ticks are
event-time buckets of ``tick`` length.

* T1: an event counts once however often its file lands: repeated deliveries
  are dropped within the watermark, older ones as late rows.
* T2: units and revenue per tick: tumbling event-time window + watermark.
* T12: visitor sessions: all events of a user up to a gap of 30 minutes
  (``session_window``), emitted when the watermark has passed their end.
* T3/T5/T6: per-listing state (``transformWithStateInPandas``): demand of the
  last six ticks by tick and of all older ones together, whatever order files
  come in. Lines are folded to one row per listing and tick inside each task
  before the shuffle, so a hot listing sends a state task no more rows than
  there are tasks and ticks. A timer drops the state of a listing that has been
  idle; its published rows stay and a return opens a new life of the listing.
  Realised units, velocity and ticks-to-stockout are derived at publish time
  against the global current tick, so idle ticks count as zero.
* T7: every micro-batch publishes the listings it changed as a logged delta;
  deltas are folded into a full version at intervals, and what the version
  before the last no longer needs is deleted.
* T11: a micro-batch joins its rows to stores and SKUs as they are then.
* T8/T9/T10: panel, alerts and control phase are batch queries over the
  published state and ticks.

All folders live under the session's shared checkpoint directory.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.expr import stock_status
from ..params import ROLLING_WINDOW_TICKS, STOCKOUT_WARNING_ON_HAND

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])
TICK = "1 hour"
TICK_SECONDS = 3600
START_ON_HAND_MIN, START_ON_HAND_SPAN = 15, 31
OUT_SCHEMA = T.StructType([
    T.StructField("listing_id", T.LongType()),
    T.StructField("older_units", T.LongType()),
    T.StructField("cum_units", T.LongType()),
    T.StructField("first_tick", T.LongType()),
    T.StructField("hist_ticks", T.ArrayType(T.LongType())),
    T.StructField("hist_units", T.ArrayType(T.LongType())),
])
FIELDS = [f.name for f in OUT_SCHEMA.fields]
LIFE_SCHEMA = T.StructType([*OUT_SCHEMA.fields, T.StructField("epoch", T.LongType())])
ATTRIBUTES = "location_id string, store_name string, store_tier string, sku_id string"
SESSION_GAP = "30 minutes"
CLOCK = "_clock"
LATENESS = "31 days"
IDLE_TICKS = 24 * 31
FOLD_ROWS = 500_000


def read_events_stream(spark: SparkSession, folder: str, glob: str = "events*.parquet",
                       files_per_trigger: int = 1) -> DataFrame:
    """Event files as they land in ``folder`` (fixed schema, no inference)."""
    return (spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", glob)
            .option("maxFilesPerTrigger", files_per_trigger).parquet(folder))


def pos_lines(events: DataFrame) -> DataFrame:
    """T4: sales events only, with units, revenue, event time (timestamp, for the watermark) and tick."""
    ts = F.col("ts").cast("timestamp")
    return events.where(F.col("event_type") == "purchase").select(
        "event_id", ts.alias("ts"), F.col("user_id").alias("listing_id"),
        (F.lit(1) + F.col("event_id") % 3).cast("long").alias("units"),
        F.col("value").alias("gross_revenue"),
        F.floor(F.unix_timestamp(ts) / TICK_SECONDS).cast("long").alias("tick"))


def first_deliveries(rows: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Each event once, however often its file is delivered.

    ``lateness`` is how far behind the newest event a first delivery may come. A repeat inside that span is
    known by its event_id (without one, by all its columns), an older one is dropped as a late row, so the
    state holds the ids of that span only. Sets the watermark of what follows."""
    named = F.concat(F.lit("row "), F.xxhash64(*rows.columns).cast("string"))
    return (rows.withWatermark("ts", lateness).withColumn("_delivery", F.coalesce(F.col("event_id").cast("string"), named))
            .dropDuplicatesWithinWatermark(["_delivery"]).drop("_delivery"))


def units_per_tick(lines: DataFrame) -> DataFrame:
    """Tumbling event-time window per tick; ``lines`` carry the watermark."""
    return (lines.groupBy(F.window("ts", TICK).alias("w"))
            .agg(F.sum("units").alias("units"), F.sum("gross_revenue").alias("revenue"))
            .select(F.col("w.start").alias("tick_start"), "units", "revenue"))


def start_on_hand(listing_id):
    return START_ON_HAND_MIN + listing_id % START_ON_HAND_SPAN


def visits(events: DataFrame) -> DataFrame:
    """Every event of a known user with its units and revenue (purchases; others 0)."""
    bought = F.col("event_type") == "purchase"
    return events.where(F.col("user_id").isNotNull() | (F.col("event_type") == CLOCK)).select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
        F.when(bought, F.lit(1) + F.col("event_id") % 3).otherwise(F.lit(0)).cast("long").alias("units"),
        F.when(bought, F.col("value")).otherwise(F.lit(0.0)).alias("revenue"))


def visitor_sessions(visits: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """Sessions of a user, closed by ``gap`` without an event; ``visits`` carry the watermark. Rows without a
    user only move the clock."""
    return (visits.groupBy(F.session_window("ts", gap).alias("w"), "user_id")
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum("units").alias("units"), F.sum("revenue").alias("revenue"))
            .where(F.col("user_id").isNotNull())
            .select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events", "units", "revenue"))


def _fold(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Units per (listing, tick) of a task's lines, in parts of bounded size."""
    total: dict[tuple[int, int], int] = {}

    def rows():
        return pd.DataFrame([(listing, tick, n) for (listing, tick), n in total.items()], columns=["listing_id", "tick", "units"]).astype("int64")
    for pdf in pdfs:
        for key, n in pdf.groupby(["listing_id", "tick"])["units"].sum().items():
            total[key] = total.get(key, 0) + int(n)
        if len(total) >= FOLD_ROWS:
            yield rows()
            total.clear()
    yield rows()


class ListingDemand(StatefulProcessor):
    """Demand of a listing per tick, so files may arrive in any order.

    The state is the demand of the last ROLLING_WINDOW_TICKS ticks seen (by tick, not by arrival) and the demand
    and first tick of all older ones; what was realised per tick follows from the cumulative demand. When the
    watermark has passed the last tick by ``idle_ticks``, the state goes. A later event starts a new life: its
    epoch, the first tick it saw, is above all ticks of the lives before, as older rows are late by then."""

    def __init__(self, idle_ticks: int):
        self.idle_ticks = idle_ticks

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.life = handle.getValueState("life", "epoch long, older_units long, first_tick long, last_tick long")
        self.recent = handle.getMapState("recent", "tick long", "units long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        life = self.life.get() if self.life.exists() else None
        known = {t[0]: n[0] for t, n in self.recent.iterator()} if life else {}
        demand = dict(known)
        for pdf in rows:
            for tick, n in pdf.groupby("tick")["units"].sum().items():
                demand[int(tick)] = demand.get(int(tick), 0) + int(n)
        ticks = sorted(demand)
        epoch, older, first, last = life or (ticks[0], 0, ticks[0], None)
        kept = ticks[-ROLLING_WINDOW_TICKS:]
        older += sum(demand[t] for t in ticks[:-ROLLING_WINDOW_TICKS])
        for t in known:
            if t not in kept:
                self.recent.removeKey((t,))
        for t in kept:
            if demand[t] != known.get(t):
                self.recent.updateValue((t,), (demand[t],))
        self.life.update((epoch, older, min(first, ticks[0]), ticks[-1]))
        if last != ticks[-1]:
            if last is not None:
                self.handle.deleteTimer(self._expiry(last))
            self.handle.registerTimer(self._expiry(ticks[-1]))
        units = [demand[t] for t in kept]
        yield pd.DataFrame({"listing_id": [key[0]], "older_units": [older], "cum_units": [older + sum(units)], "first_tick": [min(first, ticks[0])],
                            "hist_ticks": [kept], "hist_units": [units], "epoch": [epoch]})

    def _expiry(self, last_tick: int) -> int:
        return (last_tick + 1 + self.idle_ticks) * TICK_SECONDS * 1000

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.life.clear()
        self.recent.clear()
        return iter(())

    def close(self) -> None:
        pass


def listing_state_updates(lines: DataFrame, idle_ticks: int = IDLE_TICKS) -> DataFrame:
    """Keyed state per listing (update mode); one output row per listing touched in the batch. ``lines`` carry
    the watermark; lines without a listing or time have no state."""
    known = lines.where(F.col("listing_id").isNotNull() & F.col("tick").isNotNull()).select("listing_id", "tick", "units")
    return (known.mapInPandas(_fold, "listing_id long, tick long, units long").groupBy("listing_id")
            .transformWithStateInPandas(ListingDemand(idle_ticks), LIFE_SCHEMA, "update", "eventTime"))


def one_row_per_listing(lives: DataFrame) -> DataFrame:
    """The lives of a listing as one row: older lives' demand is older demand of the newest."""
    newest = lives.groupBy("listing_id").agg(
        F.sum("cum_units").alias("cum_units"), F.min("first_tick").alias("first_tick"),
        F.max_by(F.struct("hist_ticks", "hist_units"), "epoch").alias("h"))
    recent = F.aggregate("h.hist_units", F.lit(0).cast("long"), lambda a, x: a + x)
    return newest.select("listing_id", (F.col("cum_units") - recent).alias("older_units"), "cum_units", "first_tick",
                         F.col("h.hist_ticks").alias("hist_ticks"), F.col("h.hist_units").alias("hist_units"))


def listing_universe(numbered_stores: DataFrame, numbered_skus: DataFrame, n_stores: int, n_skus: int,
                     listing_ids: DataFrame) -> DataFrame:
    """Static listing attributes: store = listing % stores, SKU = listing % SKUs (``store_no``, ``sku_no``)."""
    return (listing_ids.withColumn("store_no", F.col("listing_id") % n_stores)
            .withColumn("sku_no", F.col("listing_id") % n_skus)
            .join(numbered_stores, "store_no").join(numbered_skus, "sku_no")
            .select("listing_id", F.col("store_id").alias("location_id"), "store_name", "store_tier", "sku_id"))


def derive_state(raw: DataFrame, universe: DataFrame | None = None, *more) -> DataFrame:
    """T5 + T6 over the merged raw state: on-hand, trailing velocity (zeros for idle ticks), ticks to stockout.

    ``raw`` carries the global ``current_tick`` and ``stream_first_tick`` as columns, and the listing's attributes
    if its stream joined them; otherwise ``universe`` gives them. ``more`` are further columns over ``raw``.
    """
    current_tick, first_tick = F.col("current_tick"), F.col("stream_first_tick")
    k = F.least(F.lit(ROLLING_WINDOW_TICKS), (current_tick - first_tick + 1)).cast("double")
    start = F.lit(START_ON_HAND_MIN) + F.col("listing_id") % START_ON_HAND_SPAN
    # realised units of the recent ticks: what the cumulative demand before and after them could take
    recent_demand = F.aggregate(F.arrays_zip("hist_ticks", "hist_units"), F.lit(0).cast("long"),
                                lambda acc, x: acc + F.when(x["hist_ticks"] > current_tick - ROLLING_WINDOW_TICKS,
                                                            x["hist_units"]).otherwise(F.lit(0).cast("long")))
    recent = F.least(F.col("cum_units"), start) - F.least(F.col("cum_units") - recent_demand, start)
    on_hand = F.greatest(start - F.col("cum_units"), F.lit(0))
    v = recent / k
    joined = raw if universe is None else raw.join(universe, "listing_id")
    return (joined
            .select("listing_id", "location_id", "store_name", "store_tier", "sku_id",
                    on_hand.cast("long").alias("on_hand"), v.alias("trailing_velocity"),
                    F.least(F.greatest(F.when(v > 0, on_hand / v).otherwise(F.lit(999.0)), F.lit(0.0)), F.lit(999.0))
                    .alias("ticks_to_stockout"),
                    stock_status(on_hand, STOCKOUT_WARNING_ON_HAND).alias("status"), *more))


class StatePublisher:
    """``foreachBatch`` sink that publishes changed listings as deltas and folds them at intervals.

    A batch writes only the listings it changed, to a folder of its own, then a one-row log entry that names
    it; readers see logged folders only, so a half-written one is never read, and a replayed batch writes its
    folder and entry again with the same content. Every ``compact_every`` batches the newest rows of each
    listing are written as a full version, and readers start from the highest full version.

    Retention: when a full version is logged, everything that the full version before it replaced is deleted,
    log entries first. A reader of the previous version (its full folder and the deltas behind it) still finds
    all its folders. At most two full versions and twice ``compact_every`` deltas exist, and the log is as short.

    ``attributes`` (T11) is a function that gives the listing attributes as they are now, a row per listing of its
    argument; it is called in every batch, so a changed store or SKU table counts from the next batch on. Its
    columns are published with the state.
    """

    LOG = "batch_id long, kind string, path string"

    def __init__(self, root: str, compact_every: int = 10, attributes: Callable[[DataFrame], DataFrame] | None = None,
                 attribute_schema: str | None = None):
        self.root, self.compact_every, self.attributes = root.rstrip("/"), compact_every, attributes
        self.log = f"{self.root}/_versions"
        extra = T.StructType.fromDDL(attribute_schema).fields if attribute_schema else []
        self.schema = T.StructType([*LIFE_SCHEMA.fields, *extra])
        self.extra = [f.name for f in extra]

    def entries(self, spark: SparkSession) -> list:
        """Log rows in order of their batch; empty before the first batch (only a missing log means that)."""
        try:
            rows = spark.read.schema(self.LOG).option("recursiveFileLookup", "true").json(self.log).collect()  # bounded by the retention
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(set(map(tuple, rows)), key=lambda r: (r[0], r[1]))

    def lives(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """The newest row of every life of a listing over the logged folders (of batches below ``before``)."""
        rows = [r for r in self.entries(spark) if before is None or r[0] < before]
        if not rows:
            return None
        base = max((r[0] for r in rows if r[1] == "full"), default=-1)
        parts = [spark.read.schema(self.schema).parquet(p).withColumn("batch_id", F.lit(b)) for b, kind, p in rows
                 if b == base and kind == "full" or b > base and kind == "delta"]
        both = parts[0]
        for p in parts[1:]:
            both = both.unionByName(p)
        newest = both.groupBy("listing_id", "epoch").agg(F.max_by(F.struct(*FIELDS[1:], *self.extra), "batch_id").alias("s"))
        return newest.select("listing_id", "epoch", "s.*")

    def current(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """One row per listing over the logged folders (of batches below ``before``)."""
        lives = self.lives(spark, before)
        if lives is None:
            return None
        rows = one_row_per_listing(lives)
        if not self.extra:
            return rows
        newest = lives.groupBy("listing_id").agg(F.max_by(F.struct(*self.extra), "epoch").alias("a")).select("listing_id", "a.*")
        return rows.join(newest, "listing_id")

    def _folded(self, spark: SparkSession, before: int) -> DataFrame:
        """The rows of a full version: the newest life of a listing, and its closed ones as one row."""
        lives = self.lives(spark, before).withColumn("open", F.col("epoch") == F.max("epoch").over(Window.partitionBy("listing_id")))
        closed = lives.where(~F.col("open"))
        gone = one_row_per_listing(closed).join(closed.groupBy("listing_id").agg(
            F.max("epoch").alias("epoch"), *[F.max_by(c, "epoch").alias(c) for c in self.extra]), "listing_id")
        return lives.where("open").select(*self.schema.names).unionByName(gone.select(*self.schema.names))

    def _publish(self, df: DataFrame, batch_id: int, kind: str) -> None:
        spark, path = df.sparkSession, f"{self.root}/{kind}={batch_id:08d}"
        df.write.mode("overwrite").parquet(path)
        # one log file per batch and kind: a replay replaces it
        (spark.createDataFrame([(int(batch_id), kind, path)], self.LOG).coalesce(1)
         .write.mode("overwrite").json(self._entry(kind, batch_id)))

    def _entry(self, kind: str, batch_id: int) -> str:
        return f"{self.log}/{kind}-{batch_id:08d}"

    def _expire(self, spark: SparkSession) -> None:
        rows = self.entries(spark)
        full = sorted(b for b, kind, _ in rows if kind == "full")
        if len(full) < 2:
            return
        previous = full[-2]
        old = [r for r in rows if r[0] < previous or r[0] == previous and r[1] == "delta"]
        for path in [self._entry(kind, b) for b, kind, _ in old] + [p for *_, p in old]:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch if "epoch" in batch.columns else batch.withColumn("epoch", F.lit(0).cast("long"))
        rows = rows.select(*LIFE_SCHEMA.names)
        if self.attributes is not None:
            rows = rows.join(self.attributes(rows.select("listing_id").distinct()).select("listing_id", *self.extra), "listing_id")
        self._publish(rows, batch_id, "delta")
        if (batch_id + 1) % self.compact_every == 0:
            self._publish(self._folded(spark, batch_id + 1), batch_id, "full")
            self._expire(spark)


def hot_item_panel(state: DataFrame) -> DataFrame:
    """On-hand and velocity per store, lowest on-hand first; a store goes by the name that its latest sale met,
    if ``state`` has the listings' last ticks."""
    store = F.struct("store_name", "store_tier")
    latest = F.max_by(store, F.struct("last_tick", store)) if "last_tick" in state.columns else F.max(store)
    return (state.groupBy("location_id")
            .agg(latest.alias("s"), F.sum("on_hand").alias("on_hand"), F.sum("trailing_velocity").alias("velocity"))
            .select("location_id", "s.store_name", "s.store_tier", "on_hand", "velocity")
            .orderBy("on_hand", "location_id"))


def stock_alerts(panel: DataFrame) -> DataFrame:
    """STOCKOUT / WATCH / HEALTHY per store, counted per status with the first five store names."""
    s = panel.withColumn("status", stock_status("on_hand", STOCKOUT_WARNING_ON_HAND))
    ranked = s.withColumn("rank", F.row_number().over(Window.partitionBy("status").orderBy("store_name")))  # keeps a top-n per status
    first = ranked.where(F.col("rank") <= 5).groupBy("status").agg(F.array_sort(F.collect_list("store_name")).alias("names"))
    counts = s.groupBy("status").agg(F.count(F.lit(1)).alias("n_stores"))
    return counts.join(first, "status").select("status", "n_stores", F.concat(F.array_join("names", ", "), F.when(
        F.col("n_stores") > 5, F.concat(F.lit(" (+"), (F.col("n_stores") - 5).cast("string"), F.lit(" more)"))).otherwise(F.lit(""))).alias("stores"))


CONTROL_SCHEMA = "triggered boolean, triggered_at_tick long"


def control_flag(spark: SparkSession, path: str) -> DataFrame:
    """T10 + F26: the tick of the flag's first sighting as one row (null: missing, malformed or not triggered)."""
    try:
        raw = spark.read.option("wholetext", "true").text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], "value string")
    c = raw.select(F.from_json("value", CONTROL_SCHEMA).alias("c")).where("c.triggered")
    return c.agg(F.min("c.triggered_at_tick").alias("triggered_at"))


def with_phase(ticks: DataFrame, flag: DataFrame, spike_ticks: int = 8) -> DataFrame:
    """T10 + F25: the phase of every published tick (``tick`` long) against the flag: baseline, SPIKING, SETTLED."""
    at = flag.scalar()
    since = F.col("tick") - at
    return ticks.withColumn("phase", F.when(at.isNull() | (since < 0), "baseline").when(since < spike_ticks, "SPIKING").otherwise("SETTLED"))
