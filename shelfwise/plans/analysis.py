"""Scenario analyses (M15-M38): weather shock, viral product, fit problem, supply
disruption, allocation, cohort and the executive roll-up.

Where the reference picks one region, store or DC from an unordered frame,
these plans compute the answer for every key and break ties on the lowest key
(N11). Option costing is one generic operator: a literal array of option
structs exploded per exposure row (no join, no driver loop).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import exact_sum, safe_div
from .decisions import revenue_at_risk


# ------------------------------------------------------------------ one-row combination
def scalars(parts: dict[str, DataFrame]) -> DataFrame:
    """Combine one-row, one-column aggregates into one row (a union and one tiny aggregate, no join)."""
    tagged = None
    for name, df in parts.items():
        t = df.select(F.lit(name).alias("_k"), F.col(df.columns[0]).cast("double").alias("_v"))
        tagged = t if tagged is None else tagged.unionByName(t)
    return tagged.agg(*[F.max(F.when(F.col("_k") == n, F.col("_v"))).alias(n) for n in parts])


# ------------------------------------------------------------------ option costing
def cost_options(exposure: DataFrame, options: list[dict], keys: list[str]) -> DataFrame:
    """Explode one row per option for every exposure row.

    ``options``: dicts with ``option`` (name), ``units``/``revenue``/``cost``
    (Column expressions over the exposure row) and ``risk`` (text).
    """
    structs = [F.struct(F.lit(o["option"]).alias("option"),
                        o["units"].cast("long").alias("units"),
                        F.round(o["revenue"], 0).cast("double").alias("expected_revenue"),
                        F.round(o["cost"], 0).cast("double").alias("cost"),
                        F.lit(o.get("risk", "")).alias("risk"))
               for o in options]
    return exposure.select(*keys, F.inline(F.array(*structs)))


# ------------------------------------------------------------------ weather shock (notebook 02)
def temperature_series(weather: DataFrame, dim_week: DataFrame, regions: list[str]) -> DataFrame:
    """M15."""
    return (weather.where(F.col("region_code").isin(regions))
            .join(dim_week.select("week_id", "week_start_date"), "week_id")
            .select("week_start_date", "region_code", "avg_temp_vs_normal_c"))


def category_sell_through(m1: DataFrame, dim_week: DataFrame, dim_style: DataFrame, category: str,
                          regions: list[str]) -> DataFrame:
    """Units per week and region for one category."""
    return (m1.where(F.col("region_code").isin(regions))
            .join(dim_style.where(F.col("category") == category).select("style_id"), "style_id")
            .groupBy("week_start_date", "region_code").agg(F.sum("units").alias("units")))


def regional_exposure(signals: DataFrame, category: str, regions: list[str]) -> DataFrame:
    """On-hand, projected demand, value at risk and overstock % per region."""
    s = signals.where(F.col("region_code").isin(regions) & (F.col("category") == category)
                      & (F.col("location_type") == "Store"))
    g = s.groupBy("region_code").agg(F.sum("on_hand_units").alias("on_hand"),
                                     exact_sum("projected_remaining_demand").cast("double").alias("proj_demand"),
                                     exact_sum(F.col("on_hand_units") * F.col("current_retail_price"), 2).cast("double")
                                     .alias("inventory_value_at_risk"))
    return g.withColumn("overstock_pct", safe_div(F.col("on_hand") - F.col("proj_demand"), F.col("proj_demand")) * 100)


def weather_options(exposure: DataFrame, warm_regions: list[str]) -> DataFrame:
    """Transfer / hold / digital options for every warm region (the reference costs the first one)."""
    e = exposure.where(F.col("region_code").isin(warm_regions) & (F.col("on_hand") > 0))
    avg_price = F.col("inventory_value_at_risk") / F.col("on_hand")
    e = e.select("region_code", "on_hand", avg_price.alias("avg_price"),
                 F.floor(F.col("on_hand") * 0.25).alias("transfer_units"))
    tu, p = F.col("transfer_units"), F.col("avg_price")
    return cost_options(e, [
        dict(option="A - Transfer to cold regions", units=tu, revenue=tu * p * 0.85, cost=tu * 28, risk="Medium"),
        dict(option="B - Hold & markdown at season end", units=F.lit(0),
             revenue=-(F.col("on_hand") * 0.30 * p), cost=F.lit(0.0), risk="High (margin)"),
        dict(option="C - Increase digital allocation", units=tu, revenue=tu * p * 0.85 * 0.8, cost=tu * 28 * 0.3,
             risk="Low"),
    ], ["region_code"])


# ------------------------------------------------------------------ viral product (notebook 03)
def style_sales_and_views(sales: DataFrame, engagement: DataFrame, dim_sku: DataFrame, dim_week: DataFrame,
                          style_id: str) -> DataFrame:
    """Weekly units of one style beside its page views (views lead sales)."""
    w = dim_week.select("week_id", "week_start_date")
    units = (sales.where(F.col("style_id") == style_id).groupBy("week_id").agg(F.sum("units").alias("units")))
    skus = dim_sku.where(F.col("style_id") == style_id).select("sku_id")
    views = (engagement.join(skus, "sku_id").groupBy("week_id").agg(F.sum("page_views").alias("page_views")))
    return (units.join(views, "week_id", "full").join(w, "week_id")
            .select("week_start_date", "units", "page_views"))


def closest_to_stockout(signals: DataFrame, dim_store: DataFrame, style_id: str, n: int = 15) -> DataFrame:
    """Store rows of one style nearest to stockout (top n, ascending days; ties by store, sku)."""
    st = dim_store.select(F.col("store_id").alias("location_id"), "store_name", "city")
    return (signals.where((F.col("style_id") == style_id) & F.col("stockout_est_days").isNotNull())
            .join(st, "location_id")
            .select("store_name", "city", "sku_id", "on_hand_units", "stockout_est_days")
            .orderBy("stockout_est_days", "store_name", "sku_id").limit(n))


def spike_options(at_risk: DataFrame, dim_sku: DataFrame, style_id: str, days: float = 14) -> DataFrame:
    """Expedite / reallocate options for the stores under ``days`` to stockout."""
    lost = at_risk.where(F.col("stockout_est_days") < days).agg(
        F.floor(F.coalesce(F.sum("on_hand_units"), F.lit(0)) * 0.4).alias("lost_units"))
    price = dim_sku.where(F.col("style_id") == style_id).agg(F.avg("current_retail_price").alias("price"))
    e = scalars({"lost_units": lost, "price": price})
    lu, p = F.col("lost_units"), F.col("price")
    return cost_options(e, [
        dict(option="Do nothing", units=F.lit(0), revenue=F.lit(0.0), cost=F.lit(0.0)),
        dict(option="Expedite replenishment from DC", units=lu, revenue=lu * p, cost=lu * 6),
        dict(option="Reallocate from slower stores", units=F.floor(lu * 0.7), revenue=lu * 0.7 * p, cost=lu * 0.7 * 15),
    ], [])


# ------------------------------------------------------------------ fit problem (notebook 04)
def return_rate_by_size(m4: DataFrame, style_id: str, sizes: list[str]) -> DataFrame:
    """M22."""
    return (m4.where((F.col("style_id") == style_id) & F.col("size").isin(sizes))
            .select("week_start_date", "size", "return_rate"))


def reason_mix(returns: DataFrame, style_id: str) -> DataFrame:
    """Return lines per reason code, most frequent first."""
    return (returns.where(F.col("style_id") == style_id).groupBy("reason_code").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), "reason_code"))


def review_sample(reviews: DataFrame, style_id: str, n: int = 8) -> DataFrame:
    """First n review texts of a style's returns (ordered by return line id)."""
    return (reviews.where((F.col("style_id") == style_id) & F.col("review_text").isNotNull())
            .select("return_line_id", "review_text").orderBy("return_line_id").limit(n))


def fit_return_cost(returns: DataFrame, dim_sku: DataFrame, style_id: str, sizes: list[str], reason: str,
                    processing_cost: float = 18.0) -> DataFrame:
    """Units returned for a fit reason × (half the average price + processing cost)."""
    r = (returns.where((F.col("style_id") == style_id) & (F.col("reason_code") == reason))
         .join(dim_sku.select("sku_id", F.col("size").alias("sku_size"), "current_retail_price"), "sku_id")
         .where(F.col("sku_size").isin(sizes)))
    g = r.agg(F.sum("units_returned").alias("units_returned"), F.avg("current_retail_price").alias("avg_price"))
    return g.withColumn("total_cost", F.col("units_returned") * (F.col("avg_price") * 0.5 + processing_cost))


# ------------------------------------------------------------------ supply disruption (notebook 05)
def delayed_po_timeline(po_lines: DataFrame, dim_style: DataFrame, events: DataFrame) -> DataFrame:
    """Delayed PO lines with their style and milestone events."""
    return (po_lines.where(F.col("is_delayed"))
            .join(dim_style.select("style_id", "style_name"), "style_id")
            .join(events.select("po_line_id", "event_seq", "event_type", "event_date"), "po_line_id")
            .select("po_line_id", "style_id", "style_name", "order_date", "original_expected_receipt_date",
                    "revised_expected_receipt_date", "actual_receipt_date", "event_seq", "event_type", "event_date"))


def revenue_at_risk_by_region(exposed: DataFrame) -> DataFrame:
    """M27 over ``marts.exposed_signals``: every sum weighs a row by its number of PO terms."""
    n = F.col("n_terms")
    return (exposed.groupBy("region_code")
            .agg(F.sum(F.col("on_hand_units") * n).alias("on_hand"),
                 (F.sum(F.col("weeks_of_supply") * n) / F.sum(F.when(F.col("weeks_of_supply").isNotNull(), n))).alias("avg_weeks_of_supply"),
                 revenue_at_risk().cast("double").alias("revenue_at_risk_3wk"))
            .orderBy(F.col("revenue_at_risk_3wk").desc()))


def vip_exposure(dim_customer: DataFrame, exposed: DataFrame, tiers: list[str]) -> DataFrame:
    """Distinct high-tier customers living in an exposed region (semi join)."""
    regions = exposed.select(F.col("region_code").alias("home_region")).distinct()
    return (dim_customer.where(F.col("loyalty_tier").isin(tiers)).join(regions, "home_region", "left_semi")
            .groupBy("loyalty_tier").agg(F.countDistinct("customer_id").alias("n_customers")))


def supply_options(by_region: DataFrame) -> DataFrame:
    """Options as shares of the total revenue at risk."""
    total = by_region.agg(F.coalesce(F.sum("revenue_at_risk_3wk"), F.lit(0.0)).alias("total_risk"))
    t = F.col("total_risk")
    return cost_options(total, [
        dict(option="Do nothing (accept the delay)", units=F.lit(0), revenue=F.lit(0.0), cost=F.lit(0.0)),
        dict(option="Expedite freight (air vs. ocean)", units=F.lit(0), revenue=t * 0.7, cost=t * 0.07),
        dict(option="Transfer from other DCs", units=F.lit(0), revenue=t * 0.45, cost=t * 0.03),
        dict(option="Controlled stockout, VIP-priority allocation", units=F.lit(0), revenue=t * 0.3, cost=t * 0.01),
    ], [])


# ------------------------------------------------------------------ allocation (notebook 06)
def city_extremes(signals: DataFrame, dim_store: DataFrame, style_names: list[str], short_days: float = 30) -> DataFrame:
    """Per city, the worst surplus row (max overstock_pct > 0) and worst shortage row (min days < 30)."""
    st = dim_store.select(F.col("store_id").alias("location_id"), "city")
    s = signals.where(F.col("style_name").isin(style_names)).join(st, "location_id")
    cols = ["style_name", "color_name", "size", "on_hand_units", "overstock_pct", "stockout_est_days", "sku_id"]
    surplus = (s.where(F.col("overstock_pct") > 0).withColumn("kind", F.lit("surplus"))
               .withColumn("_k", F.struct(F.col("overstock_pct").alias("a"), F.col("sku_id").alias("b"))))
    shortage = (s.where(F.col("stockout_est_days") < short_days).withColumn("kind", F.lit("shortage"))
                .withColumn("_k", F.struct((-F.col("stockout_est_days")).alias("a"), F.col("sku_id").alias("b"))))
    both = surplus.unionByName(shortage)
    g = both.groupBy("city", "kind").agg(F.max_by(F.struct(*cols), "_k").alias("r"))
    return g.select("city", "kind", "r.*")


def portfolio_rollup(signals: DataFrame, style_names: list[str] | None = None) -> DataFrame:
    """Store on-hand vs projected demand per region × style."""
    s = signals.where(F.col("location_type") == "Store")
    if style_names:
        s = s.where(F.col("style_name").isin(style_names))
    g = s.groupBy("region_code", "style_id", "style_name").agg(
        F.sum("on_hand_units").alias("on_hand"),
        exact_sum("projected_remaining_demand").cast("double").alias("proj_demand"))
    return g.withColumn("overstock_pct", safe_div(F.col("on_hand") - F.col("proj_demand"), F.col("proj_demand")) * 100)


def transfer_decisions(portfolio: DataFrame, dim_sku: DataFrame) -> DataFrame:
    """M32 generalised: per style, move stock from its most overstocked region to its most under-supplied one.

    One surplus and one shortage region per style (max_by / min_by), so no
    pairs are enumerated; options A/B/C as in the reference.
    """
    p = portfolio
    surplus = (p.where(F.col("overstock_pct") > 0).groupBy("style_id")
               .agg(F.max_by(F.struct("region_code", "on_hand"), F.struct("overstock_pct", "region_code")).alias("s")))
    shortage = (p.where(F.col("on_hand") < F.col("proj_demand")).groupBy("style_id")
                .agg(F.min_by(F.struct("region_code", "proj_demand"),
                              F.struct(F.col("on_hand") - F.col("proj_demand"), F.col("region_code"))).alias("d")))
    # prices carry cents: their exact sum over the count gives the same mean on every partitioning
    price = dim_sku.groupBy("style_id").agg(
        (exact_sum("current_retail_price", 2).cast("double") / F.count(F.lit(1))).alias("avg_price"))
    e = surplus.join(shortage, "style_id").join(price, "style_id").select(
        "style_id", F.col("s.region_code").alias("from_region"), F.col("d.region_code").alias("to_region"),
        F.col("s.on_hand").alias("surplus_on_hand"), F.col("avg_price"),
        F.floor(F.least(F.col("s.on_hand") * 0.4, F.col("d.proj_demand") * 1.2)).alias("transfer_units"))
    tu, pr = F.col("transfer_units"), F.col("avg_price")
    return cost_options(e, [
        dict(option="A - Transfer", units=tu, revenue=tu * pr * 0.9, cost=tu * 26, risk="Medium"),
        dict(option="B - Hold inventory", units=F.lit(0), revenue=-(F.col("surplus_on_hand") * pr * 0.35 * 0.5),
             cost=F.lit(0.0), risk="High - markdown exposure"),
        dict(option="C - Increase digital allocation", units=tu, revenue=tu * pr * 0.85, cost=tu * 26 * 0.25, risk="Low"),
    ], ["style_id", "from_region", "to_region"])


# ------------------------------------------------------------------ cohort (notebook 07)
def weighted_cohort_lift(scorecard: DataFrame, region: str, tiers: list[str]) -> DataFrame:
    """Per-tier averages re-weighted by tier size, then cohort / control."""
    c = scorecard.where((F.col("home_region") == region) & F.col("loyalty_tier").isin(tiers))
    per_tier = c.groupBy("is_cohort", "loyalty_tier").agg(F.count(F.lit(1)).alias("n"),
                                                                F.avg("n_orders").alias("avg_orders"))
    s = per_tier.groupBy("is_cohort").agg((F.sum(F.col("avg_orders") * F.col("n")) / F.sum("n")).alias("avg_orders"),
                                                F.sum("n").alias("n"))
    lift = safe_div(F.max(F.when(F.col("is_cohort"), F.col("avg_orders"))).over(Window.partitionBy()),
                    F.max(F.when(~F.col("is_cohort"), F.col("avg_orders"))).over(Window.partitionBy()))
    return s.withColumn("lift", lift)  # s has at most two rows (cohort / control)


def capsule_affinity(scorecard: DataFrame, region: str) -> DataFrame:
    """M35."""
    return (scorecard.where(F.col("home_region") == region).groupBy("is_cohort")
            .agg(F.avg("capsule_units").alias("avg_capsule_units")))


# ------------------------------------------------------------------ executive roll-up (notebook 08)
def executive_rollup(signals: DataFrame, exposed: DataFrame, returns: DataFrame, dim_sku: DataFrame, as_of_week: int,
                     recovery_rate: float = 0.55) -> DataFrame:
    """Four exposures as one row, plus total and expected recovery."""
    # every part is an exact fixed-point sum (exact_sum), so it does not depend on partitioning
    price = F.col("current_retail_price")
    sig = signals.agg(
        exact_sum(F.when(F.col("overstock_pct") > 0.2, F.greatest(F.col("overstock_units"), F.lit(0.0)) * price * 0.35)).alias("overstock_cost"),
        exact_sum(F.when(F.col("stockout_est_days") < 14, F.col("trailing_avg_weekly_sales") * 3 * price)).alias("stockout_cost"))
    sup = exposed.agg(revenue_at_risk().alias("supply_risk_cost"))
    ret = (returns.where(F.col("week_id") >= as_of_week - 12)
           .join(dim_sku.select("sku_id", "current_retail_price"), "sku_id")
           .agg(exact_sum(F.col("units_returned") * 0.5 * F.col("current_retail_price")).alias("returns_cost")))
    parts = ["overstock_cost", "stockout_cost", "supply_risk_cost", "returns_cost"]
    # three one-row frames, of different columns each, stacked and folded into one row
    row = sig.unionByName(sup, allowMissingColumns=True).unionByName(ret, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in parts])
    # cents and below are kept (4 places) so the total and recovery are stable sums of the parts
    row = row.select(*[F.round(F.coalesce(F.col(c), F.lit(0).cast("decimal(20,9)")), 4).cast("double").alias(c)
                       for c in parts])
    total = sum((F.col(c) for c in parts[1:]), F.col(parts[0]))
    return row.withColumn("total_exposure", total).withColumn("total_recovery", F.col("total_exposure") * recovery_rate)
