"""Registered gold-mart queries (M1-M6) and the engine tables (E3-E12), with their SQL twins."""
from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import functions as F

from ..oracle.fixture_sql import AS_OF, AS_OF_DATE, CTES, lit
from ..params import DEFAULT as SC
from ..session import ensure_checkpoint_dir
from ..sources import incremental
from ..sources.fixture import Fixture
from ..operators import engine as eng
from . import marts
from .registry import register


class Gold:
    """The gold marts of one fixture. Signals and scorecards are written once and read by every query that
    needs them; the exposure marts stay lazy."""

    def __init__(self, fx: Fixture):
        self.fx = fx

    @cached_property
    def m3(self):
        """The signals need weeks up to the as-of week only: the engine is truncated there."""
        fx = self.fx

        def build():
            return marts.inventory_imbalance_signals(marts.weekly_demand_store_sku(fx.engine), fx.dim_sku, fx.dim_style, fx.sc.as_of_week)
        return fx.once("signals", build)

    @cached_property
    def m4(self):
        fx = self.fx
        return fx.once("returns_scorecard", lambda: marts.returns_scorecard(fx.sales, fx.returns, fx.dim_sku, fx.dim_style, fx.dim_week))

    @cached_property
    def delays(self):
        return self.fx.once("open_delays", lambda: marts.open_delays(self.fx.po_lines_ahead, self.fx.sc.as_of_date))

    @cached_property
    def m5(self):
        return marts.supply_risk_exposure(self.m3, self.delays)

    @cached_property
    def exposed(self):
        return marts.exposed_signals(self.m3, self.delays)

    def __getitem__(self, name: str):
        return getattr(self, name)


def gold(fx: Fixture) -> Gold:
    if getattr(fx, "_gold", None) is None:
        fx._gold = Gold(fx)
    return fx._gold


def cohort(fx: Fixture):
    return fx.once("cohort_scorecard", lambda: marts.customer_cohort_scorecard(
        fx.sales, fx.order_customers, fx.dim_customer, fx.sc.cohort_campaign_id, fx.sc.capsule_prefix))


# ------------------------------------------------------------------ SQL twins of the marts (shared CTEs)
# first one row per selling place and week, then the style's regions
CTES["gold_m1"] = """
WITH place AS (SELECT style_id, region_code, week_id, location_id, SUM(units) AS pieces, SUM(revenue_cents) AS cents
               FROM fx_sales GROUP BY style_id, region_code, week_id, location_id)
SELECT style_id, region_code, week_id, week_start_date, fiscal_year, fiscal_season, CAST(SUM(pieces) AS BIGINT) AS units,
       CAST(SUM(cents) AS DOUBLE) / 100.0 AS gross_revenue, COUNT(*) AS n_locations
FROM place JOIN fx_dim_week USING (week_id)
GROUP BY style_id, region_code, week_id, week_start_date, fiscal_year, fiscal_season"""

CTES["gold_m2"] = """
SELECT location_id, location_type, region_code, sku_id, week_id, on_hand_units, weeks_of_supply,
       CAST(demand_units AS BIGINT) AS units_sold, CAST(revenue_cents AS DOUBLE) / 100.0 AS gross_revenue
FROM fx_engine"""

# the pace of a listing over the eight weeks up to each week, then the as-of week only
CTES["gold_pace"] = f"""
SELECT * FROM (SELECT *, AVG(units_sold) OVER eight AS pace FROM gold_m2
               WINDOW eight AS (PARTITION BY location_id, sku_id ORDER BY week_id RANGE BETWEEN 7 PRECEDING AND CURRENT ROW))
WHERE week_id = {AS_OF}"""

CTES["gold_outlook"] = f"""
SELECT p.*, k.style_id, k.color_name, k.size, k.current_retail_price AS price, y.style_name, y.category,
       CASE WHEN y.exit_week_uncapped > {AS_OF} THEN y.exit_week_uncapped - {AS_OF} ELSE 1 END AS horizon
FROM gold_pace p, fx_dim_sku k, fx_dim_style y
WHERE k.sku_id = p.sku_id AND y.style_id = k.style_id"""

CTES["gold_m3"] = """
SELECT location_id, location_type, region_code, sku_id, style_id, style_name, category, color_name, size,
       price AS current_retail_price, on_hand_units, weeks_of_supply, pace AS trailing_avg_weekly_sales,
       horizon AS remaining_season_weeks, need AS projected_remaining_demand, on_hand_units - need AS overstock_units,
       (on_hand_units - need) / CASE WHEN need > 0 THEN need END AS overstock_pct,
       on_hand_units / CASE WHEN pace > 0 THEN pace END * 7 AS stockout_est_days
FROM (SELECT *, pace * horizon AS need FROM gold_outlook)"""

# sold and returned units as one stream of movements, aggregated once
CTES["gold_m4"] = """
SELECT b.style_id, y.style_name, b.size, b.week_id, cal.week_start_date, CAST(b.sold AS BIGINT) AS units_sold,
       CAST(b.back AS BIGINT) AS units_returned, CAST(b.back AS DOUBLE) / b.sold AS return_rate
FROM (SELECT m.style_id, k.size, m.week_id, SUM(m.sold) AS sold, SUM(m.back) AS back
      FROM (SELECT style_id, sku_id, week_id, units AS sold, 0 AS back FROM fx_sales
            UNION ALL SELECT style_id, sku_id, week_id, 0, units_returned FROM fx_returns) m
      JOIN fx_dim_sku k USING (sku_id) GROUP BY ALL HAVING SUM(m.sold) > 0) b
JOIN fx_dim_style y USING (style_id) JOIN fx_dim_week cal USING (week_id)"""

CTES["gold_delays"] = f"""
SELECT style_id, supplier_id, dc_id, original_expected_receipt_date, revised_expected_receipt_date, actual_receipt_date
FROM fx_po_lines
WHERE is_delayed AND order_date <= {AS_OF_DATE} AND revised_expected_receipt_date >= {AS_OF_DATE} GROUP BY ALL"""

CTES["gold_m5"] = """
SELECT m.*, d.* EXCLUDE (style_id) FROM (FROM gold_m3 WHERE location_type = 'Store') m, gold_delays d
WHERE d.style_id = m.style_id"""

# orders first, then customers
CTES["gold_m6"] = f"""
SELECT c.customer_id, c.home_region, c.loyalty_tier, c.acquisition_campaign_id,
       c.acquisition_campaign_id IS NOT DISTINCT FROM {lit(SC.cohort_campaign_id)} AS is_cohort,
       COALESCE(b.n_lines, 0) AS n_orders, CAST(COALESCE(b.pieces, 0) AS BIGINT) AS total_units,
       COALESCE(CAST(b.cents AS DOUBLE), 0) / 100.0 AS total_revenue, CAST(COALESCE(b.capsule, 0) AS BIGINT) AS capsule_units,
       COALESCE(b.n_lines, 0) > 1 AS is_repeat_purchaser
FROM fx_dim_customer c LEFT JOIN (
  SELECT o.o_custkey, CAST(SUM(b.n_lines) AS BIGINT) AS n_lines, SUM(b.pieces) AS pieces, SUM(b.cents) AS cents, SUM(b.capsule) AS capsule
  FROM orders o JOIN (SELECT l_orderkey, COUNT(*) AS n_lines, SUM(units) AS pieces, SUM(revenue_cents) AS cents,
                             SUM(units) FILTER (WHERE starts_with(style_id, {lit(SC.capsule_prefix)})) AS capsule
                      FROM fx_sales GROUP BY l_orderkey) b ON b.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey) b ON b.o_custkey = c.customer_id"""


# ------------------------------------------------------------------ registrations
@register("m1_weekly_demand_style_region", "SELECT * FROM gold_m1")
def q_m1(spark, sf_dir):
    """M1: weekly demand by style × region (J1 + A1)."""
    fx = Fixture(spark, sf_dir)
    return marts.weekly_demand_style_region(fx.sales, fx.dim_week)


@register("m2_weekly_demand_store_sku", "SELECT * FROM gold_m2")
def q_m2(spark, sf_dir):
    """M2: every inventory row with its week's sales, zero-filled."""
    return marts.weekly_demand_store_sku(Fixture(spark, sf_dir).engine)


@register("m3_inventory_imbalance_signals", "SELECT * FROM gold_m3")
def q_m3(spark, sf_dir):
    """M3: as-of snapshot with trailing velocity, overstock and stockout."""
    return gold(Fixture(spark, sf_dir))["m3"]


@register("m4_returns_scorecard", "SELECT * FROM gold_m4")
def q_m4(spark, sf_dir):
    """M4: returns scorecard (A3 + J4)."""
    return gold(Fixture(spark, sf_dir))["m4"]


@register("m5_supply_risk_exposure", "SELECT * FROM gold_m5")
def q_m5(spark, sf_dir):
    """M5: store signals of styles with a delayed PO."""
    return gold(Fixture(spark, sf_dir))["m5"]


@register("m6_customer_cohort_scorecard", "SELECT * FROM gold_m6")
def q_m6(spark, sf_dir):
    """M6: customer cohort scorecard (A4 + J6)."""
    return cohort(Fixture(spark, sf_dir))


# ------------------------------------------------------------------ engine tables
@register("e9_constrained_sell_through",
          """SELECT location_id, sku_id, week_id, demand_units, s_t, cum_demand, realized_cum_sales, realized_sales,
                    on_hand_units, weeks_of_supply, unmet_cum_demand FROM fx_engine""")
def q_e9(spark, sf_dir):
    """E3 + E5 + E9 + E10 + E12: dense listing × week explode and closed-form sell-through."""
    e = Fixture(spark, sf_dir).engine
    return e.select("location_id", "sku_id", "week_id", "demand_units", "s_t", "cum_demand", "realized_cum_sales",
                    "realized_sales", "on_hand_units", "weeks_of_supply", "unmet_cum_demand")


@register("e9_resumed_sell_through",
          """SELECT location_id, sku_id, week_id, demand_units, s_t, cum_demand, realized_cum_sales, realized_sales,
                    on_hand_units, weeks_of_supply, unmet_cum_demand FROM fx_engine""")
def q_e9_resumed(spark, sf_dir):
    """E9 in two parts: the weeks up to the as-of week, a written closing state, and the weeks after it from there."""
    fx = Fixture(spark, sf_dir)
    weekly, k = fx.weekly, fx.sc.as_of_week
    plan = fx.once("listing_plan", lambda: eng.listing_plan(weekly, fx.dim_style), eng.LISTING_KEYS)
    done = fx.once("engine_until_as_of", lambda: eng.resume(plan, weekly, 1, k), eng.LISTING_KEYS, ["week_id"])
    closing = fx.once("engine_closing", lambda: eng.closing_state(done), eng.LISTING_KEYS)
    rest = eng.resume(plan, weekly, k + 1, fx.sc.n_weeks, closing)
    columns = ["location_id", "sku_id", "week_id", "demand_units", "s_t", "cum_demand", "realized_cum_sales",
               "realized_sales", "on_hand_units", "weeks_of_supply", "unmet_cum_demand"]
    return done.select(*columns).unionByName(rest.select(*columns))


@register("s5_incremental_layers", "SELECT * FROM gold_m1")
def q_s5(spark, sf_dir):
    """S2 + S5 + S8: M1 built without the lines of two weeks, then refreshed with all lines; only those weeks are rebuilt."""
    fx = Fixture(spark, sf_dir)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/incremental-{uuid.uuid4().hex}"
    columns = ["location_id", "region_code", "style_id", "week_id", "units", "revenue_cents"]
    lines = fx.sales.select(*columns)
    tables = {"m1": lambda part: marts.weekly_demand_style_region(part, fx.dim_week)}
    late = [fx.sc.as_of_week - 1, fx.sc.as_of_week]
    incremental.refresh(lines.where(~F.col("week_id").isin(late)), root, tables)
    incremental.refresh(lines, root, tables)
    schema = tables["m1"](lines).schema
    return spark.read.schema(schema).parquet(f"{root}/m1").select(*schema.names)


@register("e2_store_sku_assortment", "SELECT * FROM fx_assortment")
def q_assortment(spark, sf_dir):
    """Listing windows of the fixture: first/last sale week per region × SKU."""
    return Fixture(spark, sf_dir).assortment


@register("p1_silver_sales",
          """SELECT order_id, location_id, channel, region_code, sku_id, style_id, category, week_id, units,
                    markdown_pct, unit_price, gross_revenue FROM fx_sales""")
def q_silver_sales(spark, sf_dir):
    """Silver sales: projection + positive-units filter."""
    s = Fixture(spark, sf_dir).sales
    return s.select("order_id", "location_id", "channel", "region_code", "sku_id", "style_id", "category", "week_id",
                    "units", "markdown_pct", "unit_price", "gross_revenue")
