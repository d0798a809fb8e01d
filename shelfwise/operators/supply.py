"""Supply-chain and demand-signal operators."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import case_map, christmas_ramp, event_window_mult, lifecycle_mult, weather_mult
from ..params import (BASE_SCALE, CATEGORY_HOLIDAY_FACTOR, EVENT_SEQUENCE_DISRUPTED, EVENT_SEQUENCE_NORMAL,
                      RETURN_BASELINE_RATE, TIER_WEIGHT)

VIEWS_PER_UNIT = 22.0
ATC_PER_UNIT = 3.5


def digital_engagement(sales: DataFrame, viral_style: str, trigger_week: int) -> DataFrame:
    """Ecommerce units per (sku, week) -> page views (22/unit, at least 1) and add-to-cart (3.5/unit);
    the two weeks before the trigger get x3.5 views and x3.0 add-to-cart for the viral style."""
    agg = (sales.where(F.col("channel") == "Ecommerce")
           .groupBy("sku_id", "style_id", "week_id").agg(F.sum("units").alias("units")))
    views = F.greatest(F.round(F.col("units") * VIEWS_PER_UNIT), F.lit(1.0))
    atc = F.greatest(F.round(F.col("units") * ATC_PER_UNIT), F.lit(0.0))
    lead = (F.col("style_id") == viral_style) & F.col("week_id").isin(trigger_week - 2, trigger_week - 1)
    return agg.select(
        "sku_id", "week_id",
        F.when(lead, F.round(views * 3.5)).otherwise(views).cast("int").alias("page_views"),
        F.when(lead, F.round(atc * 3.0)).otherwise(atc).cast("int").alias("add_to_cart"))


def shipment_events(po_lines: DataFrame) -> DataFrame:
    """E18 + F10: milestones spread evenly from order date to revised receipt; delayed lines stop at a hold."""
    normal = F.array(*[F.lit(e) for e in EVENT_SEQUENCE_NORMAL])
    held = F.array(*[F.lit(e) for e in EVENT_SEQUENCE_DISRUPTED])
    p = po_lines.select("po_line_id", "order_date", "revised_expected_receipt_date", "dc_id",
                        F.when(F.col("is_delayed"), held).otherwise(normal).alias("seq"))
    p = p.select("*", F.posexplode("seq").alias("i", "event_type"))
    span = F.greatest(F.datediff("revised_expected_receipt_date", "order_date"), F.lit(1))
    steps = F.greatest(F.size("seq") - 1, F.lit(1))
    offset = F.floor(span * (F.col("i") / steps)).cast("int")
    return p.select(
        F.concat(F.lit("SHP-"), F.col("po_line_id"), F.lit("-"), (F.col("i") + 1).cast("string")).alias("shipment_event_id"),
        "po_line_id",
        (F.col("i") + 1).alias("event_seq"),
        "event_type",
        F.date_add("order_date", offset).alias("event_date"),
        F.when(F.col("event_type") == "Received-DC", F.col("dc_id")).otherwise(F.lit("In-Transit")).alias("location_hint"))


def po_delay(po_lines: DataFrame) -> DataFrame:
    """Revised - original days per PO line, with the late flag."""
    return po_lines.select("po_line_id", "style_id", "supplier_id", "dc_id", "is_delayed",
                           F.datediff("revised_expected_receipt_date", "original_expected_receipt_date").alias("delay_days"))


def forecast_snapshots(weather: DataFrame, n_weeks: int, shock_week: int, warm_regions: list[str],
                       horizon: int = 8) -> DataFrame:
    """E20 + E21: as-of × target (1..horizon weeks ahead, target <= last week) with the actual at the target.

    A forecast made before the shock for a warm region's target inside the shock
    is a surprise: it shows normal (0) instead of the actual. The offsets are a
    generated array per row (explode), not a join, and the actual at the target
    comes from an equi-join on (region, target week) (J18).
    """
    offs = weather.select("region_code", F.col("week_id").alias("as_of_week_id"),
                          F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("offset"))
    offs = offs.withColumn("target_week_id", F.col("as_of_week_id") + F.col("offset")).where(F.col("target_week_id") <= n_weeks)
    actual = weather.select("region_code", F.col("week_id").alias("target_week_id"),
                            F.col("avg_temp_vs_normal_c").alias("actual_at_target"))
    j = offs.join(actual, ["region_code", "target_week_id"])
    surprise = (F.col("region_code").isin(warm_regions) & (F.col("target_week_id") >= shock_week)
                & (F.col("as_of_week_id") < shock_week))
    return j.select("region_code", "as_of_week_id", "target_week_id",
                    F.when(surprise, F.lit(0.0)).otherwise(F.col("actual_at_target")).cast("float").alias("forecast_temp_vs_normal_c"),
                    surprise.alias("is_surprise"),
                    (F.col("actual_at_target") - F.when(surprise, F.lit(0.0)).otherwise(F.col("actual_at_target")))
                    .cast("float").alias("forecast_error"))


def expected_returns(sales: DataFrame, fit_style: str, fit_sizes: list[str], fit_start_week: int,
                     fit_rate: float) -> DataFrame:
    """Expected returned units = units × category baseline rate, overridden for the fit-problem window."""
    base = case_map("category", RETURN_BASELINE_RATE, 0.10)
    fit = (F.col("style_id") == fit_style) & F.col("size").isin(fit_sizes) & (F.col("week_id") >= fit_start_week)
    rate = F.when(fit, F.lit(fit_rate)).otherwise(base)
    return sales.select("order_id", "style_id", "size", "week_id", "units", rate.alias("return_rate"),
                        (F.col("units") * rate).alias("expected_units_returned"), fit.alias("is_fit_problem"))


def location_weight(listings: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Store tier weight (unknown tier 0.6); a virtual ecommerce location weighs 0.5 per store in its region."""
    stores = dim_store.select(F.col("store_id").alias("location_id"), "store_tier")
    per_region = dim_store.groupBy("region_code").agg((F.count(F.lit(1)) * 0.5).alias("ecom_weight"))
    j = listings.join(F.broadcast(stores), "location_id", "left").join(F.broadcast(per_region), "region_code", "left")
    tier_w = case_map("store_tier", TIER_WEIGHT, 0.6)
    return j.withColumn("location_weight",
                        F.when(F.col("location_type") == "Store", tier_w)
                        .otherwise(F.coalesce(F.col("ecom_weight"), F.lit(1.0))))


def demand_rate(dense: DataFrame, trigger_week: int, viral_style: str, spike_weeks: int = 4,
                spike_mult: float = 5.0, settle_mult: float = 2.0) -> DataFrame:
    """Expected weekly demand = lifecycle · holiday · Christmas ramp · weather · event window · weights · 0.55.

    Needs week_id, launch_week, category, warmth_rating, is_holiday_week,
    days_to_christmas, avg_temp_vs_normal_c, style_id, location_weight.
    """
    t = F.greatest(F.col("week_id") - F.col("launch_week"), F.lit(0))
    holiday = F.when(F.col("is_holiday_week"), case_map("category", CATEGORY_HOLIDAY_FACTOR, 1.3)).otherwise(F.lit(1.0))
    viral = F.when(F.col("style_id") == viral_style,
                   event_window_mult("week_id", trigger_week, spike_weeks, spike_mult, settle_mult)).otherwise(F.lit(1.0))
    lam = (F.col("location_weight") * lifecycle_mult(t) * holiday * christmas_ramp("days_to_christmas")
           * weather_mult("category", "warmth_rating", F.coalesce(F.col("avg_temp_vs_normal_c"), F.lit(0.0)))
           * viral * F.lit(BASE_SCALE))
    return dense.withColumn("demand_rate", F.greatest(lam, F.lit(0.0)))
