"""Gold marts M1-M6 as DataFrame plans.

Every function takes DataFrames and returns a DataFrame; nothing is
collected. Small dimensions arrive already size-checked for broadcast (see
``operators.broadcast``); facts are joined by shuffle on their keys.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import safe_div


def weekly_demand_style_region(sales: DataFrame, dim_week: DataFrame) -> DataFrame:
    """M1: units, revenue and distinct selling locations per style × region × week."""
    w = dim_week.select("week_id", "week_start_date", "fiscal_year", "fiscal_season")
    return (sales.join(w, "week_id")
            .groupBy("style_id", "region_code", "week_id", "week_start_date", "fiscal_year", "fiscal_season")
            .agg(F.sum("units").alias("units"),
                 (F.sum("revenue_cents").cast("double") / 100.0).alias("gross_revenue"),
                 F.countDistinct("location_id").alias("n_locations")))


def weekly_demand_store_sku(engine: DataFrame) -> DataFrame:
    """M2: every inventory row, with units and revenue sold that week (0 when none).

    The engine has already left-joined weekly demand (zero-filled) to its dense
    listing weeks, so this is a projection of it.
    """
    return engine.select("location_id", "location_type", "region_code", "sku_id", "week_id", "on_hand_units",
                         "weeks_of_supply", F.col("demand_units").alias("units_sold"),
                         (F.col("revenue_cents").cast("double") / 100.0).alias("gross_revenue"))


def inventory_imbalance_signals(m2: DataFrame, dim_sku: DataFrame, dim_style: DataFrame, as_of_week: int) -> DataFrame:
    """M3: as-of snapshot with trailing 8-week velocity, projected demand, overstock and stockout days.

    One pass over the weeks as_of-7..as_of (a pushed-down range filter; on a
    week-partitioned M2 it prunes folders): the trailing average over the rows
    that exist and the as-of row's values come out of one aggregate per
    listing, so the inventory frame is read once. Over a table bucketed by
    listing the aggregate needs no exchange.
    """
    at = F.col("week_id") == as_of_week
    w = (m2.where(F.col("week_id").between(as_of_week - 7, as_of_week))
         .groupBy("location_id", "sku_id")
         .agg(F.avg("units_sold").alias("trailing_avg"),
              F.max(at).alias("has_snap"),
              F.max(F.when(at, F.col("location_type"))).alias("location_type"),
              F.max(F.when(at, F.col("region_code"))).alias("region_code"),
              F.max(F.when(at, F.col("on_hand_units"))).alias("on_hand_units"),
              F.max(F.when(at, F.col("weeks_of_supply"))).alias("weeks_of_supply"))
         .where(F.col("has_snap")))
    sku = dim_sku.select("sku_id", "style_id", "color_name", "size", "current_retail_price")
    sty = dim_style.select("style_id", "style_name", "category", "exit_week_uncapped")
    j = w.join(sku, "sku_id").join(sty, "style_id")
    v = F.coalesce(F.col("trailing_avg"), F.lit(0.0))
    remaining = F.greatest(F.col("exit_week_uncapped") - F.lit(as_of_week), F.lit(1))
    projected = v * remaining
    out = j.select(
        "location_id", "location_type", "region_code", "sku_id", "style_id", "style_name", "category",
        "color_name", "size", "current_retail_price", "on_hand_units", "weeks_of_supply",
        v.alias("trailing_avg_weekly_sales"),
        remaining.alias("remaining_season_weeks"),
        projected.alias("projected_remaining_demand"),
        (F.col("on_hand_units") - projected).alias("overstock_units"),
        F.when(projected > 0, (F.col("on_hand_units") - F.col("trailing_avg") * remaining)
               / (F.col("trailing_avg") * remaining)).alias("overstock_pct"),
        F.when(v > 0, (F.col("on_hand_units") / F.col("trailing_avg")) * 7).alias("stockout_est_days"),
    )
    return out


def returns_scorecard(sales: DataFrame, returns: DataFrame, dim_sku: DataFrame, dim_style: DataFrame,
                      dim_week: DataFrame) -> DataFrame:
    """M4: sold and returned units per style × size × week; returns in weeks without sales drop out."""
    sku = dim_sku.select("sku_id", "size")
    sa = (sales.select("style_id", "sku_id", "week_id", "units").join(sku, "sku_id")
          .groupBy("style_id", "size", "week_id").agg(F.sum("units").alias("units_sold")))
    ra = (returns.select("style_id", "sku_id", "week_id", "units_returned").join(sku, "sku_id")
          .groupBy("style_id", "size", "week_id").agg(F.sum("units_returned").alias("units_returned")))
    j = (sa.join(dim_week.select("week_id", "week_start_date"), "week_id")
         .join(dim_style.select("style_id", "style_name"), "style_id")
         .join(ra, ["style_id", "size", "week_id"], "left"))
    ur = F.coalesce(F.col("units_returned"), F.lit(0))
    return j.select("style_id", "style_name", "size", "week_id", "week_start_date", "units_sold",
                    ur.alias("units_returned"),
                    safe_div(ur.cast("double"), F.col("units_sold")).alias("return_rate"))


PO_TERMS = ["style_id", "supplier_id", "dc_id", "original_expected_receipt_date",
            "revised_expected_receipt_date", "actual_receipt_date"]


def open_delays(po_lines: DataFrame, as_of_date) -> DataFrame:
    """Distinct terms of delayed POs that are open at the as-of date: ordered by then, receipt still ahead."""
    day = F.lit(as_of_date)
    return (po_lines.where(F.col("is_delayed") & (F.col("order_date") <= day) & (F.col("revised_expected_receipt_date") >= day))
            .select(*PO_TERMS).distinct())


def supply_risk_exposure(signals: DataFrame, delays: DataFrame) -> DataFrame:
    """M5: store signals of every style with an open delayed PO, one row per distinct PO terms."""
    return (signals.where(F.col("location_type") == "Store").join(delays, "style_id")
            .select(*signals.columns, *PO_TERMS[1:]))


def exposed_signals(signals: DataFrame, delays: DataFrame) -> DataFrame:
    """M5 before its fan-out: a store signal once, with the number of terms of its style and their lowest DC.

    Sums over M5 weigh a row by ``n_terms`` instead of reading it that many times.
    """
    per_style = delays.groupBy("style_id").agg(F.count(F.lit(1)).alias("n_terms"), F.min("dc_id").alias("dc_id"))
    return signals.where(F.col("location_type") == "Store").join(per_style, "style_id")


def order_totals(sales: DataFrame, capsule_prefix: str) -> DataFrame:
    """Lines, units, revenue and capsule units per order: what M6 needs of a sales line, summed map-side before the
    shuffle on the order key."""
    return (sales.groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 F.sum("units").alias("total_units"),
                 F.sum("revenue_cents").alias("total_revenue"),
                 F.sum(F.when(F.col("style_id").startswith(capsule_prefix), F.col("units")).otherwise(0))
                  .alias("capsule_units")))


def customer_cohort_scorecard(sales: DataFrame, order_customers: DataFrame, dim_customer: DataFrame,
                              cohort_campaign_id: str, capsule_prefix: str) -> DataFrame:
    """M6: orders, units, revenue and capsule units per customer; customers without sales kept with 0."""
    sums = ["n_orders", "total_units", "total_revenue", "capsule_units"]
    orders = (order_totals(sales, capsule_prefix)
              .join(order_customers.where(F.col("customer_id").isNotNull()), F.col("l_orderkey") == F.col("o_orderkey"))
              .groupBy("customer_id").agg(*[F.sum(c).alias(c) for c in sums]))
    c = dim_customer.select("customer_id", "home_region", "loyalty_tier", "acquisition_campaign_id")
    n = F.coalesce(F.col("n_orders"), F.lit(0))
    return c.join(orders, "customer_id", "left").select(
        "customer_id", "home_region", "loyalty_tier", "acquisition_campaign_id",
        F.coalesce(F.col("acquisition_campaign_id") == cohort_campaign_id, F.lit(False)).alias("is_cohort"),
        n.alias("n_orders"),
        F.coalesce(F.col("total_units"), F.lit(0)).alias("total_units"),
        F.coalesce(F.col("total_revenue").cast("double") / 100.0, F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.col("capsule_units"), F.lit(0)).alias("capsule_units"),
        (n >= 2).alias("is_repeat_purchaser"),
    )
