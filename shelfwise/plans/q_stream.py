"""Registered streaming queries (T1-T11): each drains the event files through a Structured Streaming
job (availableNow) and returns the published result; the SQL twin is the batch answer."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..oracle.fixture_sql import CTES
from ..params import ROLLING_WINDOW_TICKS
from ..operators.numbering import number_rows
from ..sources.fixture import Fixture
from ..sources.tables import read_table
from ..streaming import jobs, pos
from .catalog import numbered_skus
from .registry import register

GLOB = "events.parquet"


@register("t2_units_per_tick",
          """SELECT time_bucket(INTERVAL 1 hour, CAST(ts AS TIMESTAMP)) AS tick_start,
                    CAST(SUM(1 + event_id % 3) AS BIGINT) AS units, SUM(value) AS revenue
             FROM events WHERE event_type = 'purchase' GROUP BY 1""",
          round_cols=("revenue",))
def q_t2(spark, sf_dir):
    """T1 + T2 + T4: POS units and revenue per tick from the event-file stream (watermarked window)."""
    return jobs.run_units_per_tick(spark, sf_dir, GLOB)


def _universe(spark, sf_dir, listing_ids):
    fx = Fixture(spark, sf_dir)
    n_stores = fx.dim_store.count()      # catalog sizes: two scalars to the driver
    n_skus = fx.dim_sku.count()
    stores = number_rows(fx.dim_store.select("store_id", "store_name", "store_tier"), [F.col("store_id")]).withColumn(
        "store_no", F.col("n") - 1).drop("n")
    return pos.listing_universe(stores, numbered_skus(fx.dim_sku), n_stores, n_skus, listing_ids)


def live(spark, sf_dir, last_ticks=False):
    """Every micro-batch is joined to the stores and SKUs as they are then."""
    raw = jobs.run_listing_state(spark, sf_dir, GLOB, attributes=lambda ids: _universe(spark, sf_dir, ids))
    return jobs.live_state(spark, raw, last_ticks=last_ticks)


CTES["pos_state"] = f"""
WITH lines AS (SELECT user_id AS listing_id, 1 + event_id % 3 AS units,
                      CAST(FLOOR(epoch(CAST(ts AS TIMESTAMP)) / 3600) AS BIGINT) AS tick
               FROM events WHERE event_type = 'purchase'),
per_tick AS (SELECT listing_id, tick, SUM(units) AS d FROM lines GROUP BY 1, 2),
cum AS (SELECT *, SUM(d) OVER (PARTITION BY listing_id ORDER BY tick) AS c FROM per_tick),
rl AS (SELECT *, LEAST(c, 15 + listing_id % 31) - LEAST(c - d, 15 + listing_id % 31) AS realized FROM cum),
g AS (SELECT MAX(tick) AS cur, MIN(tick) AS first FROM per_tick),
agg AS (SELECT listing_id, SUM(d) AS cum_units,
               SUM(CASE WHEN tick > g.cur - {ROLLING_WINDOW_TICKS} THEN realized ELSE 0 END) AS recent,
               ANY_VALUE(LEAST({ROLLING_WINDOW_TICKS}, g.cur - g.first + 1)) AS k
        FROM rl, g GROUP BY listing_id),
st AS (SELECT store_id, store_name, store_tier, ROW_NUMBER() OVER (ORDER BY store_id) - 1 AS store_no FROM fx_dim_store),
sk AS (SELECT sku_id, ROW_NUMBER() OVER (ORDER BY sku_id) - 1 AS sku_no FROM fx_dim_sku),
v AS (SELECT a.listing_id, st.store_id AS location_id, st.store_name, st.store_tier, sk.sku_id,
             CAST(GREATEST(15 + a.listing_id % 31 - a.cum_units, 0) AS BIGINT) AS on_hand,
             CAST(a.recent AS DOUBLE) / CAST(a.k AS DOUBLE) AS trailing_velocity
      FROM agg a
      JOIN st ON st.store_no = a.listing_id % (SELECT COUNT(*) FROM fx_dim_store)
      JOIN sk ON sk.sku_no = a.listing_id % (SELECT COUNT(*) FROM fx_dim_sku))
SELECT *, LEAST(GREATEST(CASE WHEN trailing_velocity > 0 THEN on_hand / trailing_velocity ELSE 999.0 END, 0.0), 999.0)
            AS ticks_to_stockout,
       CASE WHEN on_hand <= 0 THEN 'STOCKOUT' WHEN on_hand < 5 THEN 'WATCH' ELSE 'HEALTHY' END AS status
FROM v"""


@register("t7_live_listing_state", "SELECT * FROM pos_state", round_cols=("trailing_velocity", "ticks_to_stockout"))
def q_t7(spark, sf_dir):
    """T3 + T5 + T6 + T7 + T11: keyed state per listing, published by version; velocity counts idle ticks."""
    return live(spark, sf_dir)


@register("t8_hot_item_panel",
          """SELECT location_id, store_name, store_tier, CAST(SUM(on_hand) AS BIGINT) AS on_hand,
                    SUM(trailing_velocity) AS velocity FROM pos_state GROUP BY 1, 2, 3""",
          round_cols=("velocity",))
def q_t8(spark, sf_dir):
    """On-hand and velocity per store from the published state."""
    return pos.hot_item_panel(live(spark, sf_dir, last_ticks=True))


@register("t9_stock_alerts",
          """SELECT status, COUNT(*) AS n_stores,
                    CASE WHEN COUNT(*) > 5
                         THEN array_to_string(list_slice(list(store_name ORDER BY store_name), 1, 5), ', ')
                              || ' (+' || CAST(COUNT(*) - 5 AS VARCHAR) || ' more)'
                         ELSE array_to_string(list(store_name ORDER BY store_name), ', ') END AS stores
             FROM (SELECT store_name, CASE WHEN SUM(on_hand) <= 0 THEN 'STOCKOUT' WHEN SUM(on_hand) < 5 THEN 'WATCH'
                                           ELSE 'HEALTHY' END AS status
                   FROM pos_state GROUP BY location_id, store_name, store_tier)
             GROUP BY status""")
def q_t9(spark, sf_dir):
    """T9 + F18 + F29: stock alerts per status with the first five store names."""
    return pos.stock_alerts(pos.hot_item_panel(live(spark, sf_dir, last_ticks=True)))


@register("t2_recent_ticks",
          """SELECT time_bucket(INTERVAL 1 hour, CAST(ts AS TIMESTAMP)) AS tick_start,
                    CAST(SUM(1 + event_id % 3) AS BIGINT) AS units, SUM(value) AS revenue
             FROM events WHERE event_type = 'purchase' GROUP BY 1 ORDER BY 1 DESC LIMIT 30""",
          round_cols=("revenue",))
def q_t2_recent(spark, sf_dir):
    """The last 30 ticks of the live ticker (ordered top-k over the published tick table)."""
    return jobs.run_units_per_tick(spark, sf_dir, GLOB).orderBy(F.col("tick_start").desc()).limit(30)


@register("t1_replayed_files",
          """SELECT time_bucket(INTERVAL 1 hour, CAST(ts AS TIMESTAMP)) AS tick_start,
                    CAST(SUM(1 + event_id % 3) AS BIGINT) AS units, SUM(value) AS revenue
             FROM events WHERE event_type = 'purchase' GROUP BY 1""",
          round_cols=("revenue",))
def q_t1_replayed(spark, sf_dir):
    """A landing folder that holds every event file twice gives the ticks of one delivery."""
    landing = jobs.land_twice(read_table(spark, sf_dir, "events"), files=4)
    return jobs.run_units_per_tick(spark, landing, "*.parquet", pos.LATENESS)  # the landed files have no order


@register("t12_visitor_sessions",
          """WITH e AS (SELECT user_id, CAST(ts AS TIMESTAMP) AS ts, event_id, event_type, value FROM events WHERE user_id IS NOT NULL),
                  b AS (SELECT *, CASE WHEN ts <= LAG(ts) OVER w + INTERVAL 30 minutes THEN 0 ELSE 1 END AS opens
                        FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
                  n AS (SELECT *, SUM(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS visit FROM b)
             SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 30 minutes AS session_end, COUNT(*) AS n_events,
                    CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 + event_id % 3 ELSE 0 END) AS BIGINT) AS units,
                    CAST(SUM(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS DOUBLE) AS revenue
             FROM n GROUP BY user_id, visit""",
          round_cols=("revenue",))
def q_t12(spark, sf_dir):
    """Visitor sessions (session_window, 30-minute gap, watermark) of the event-file stream."""
    return jobs.run_visitor_sessions(spark, sf_dir, GLOB)
