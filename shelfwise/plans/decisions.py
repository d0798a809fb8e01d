"""Rules-derived decision queue (M7-M14) and approvals.

Each rule is a DataFrame of typed decision rows; the queue is their union in
rule order, numbered DEC-0001... over range partitions; the marts it reads are
never collected.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import contains_any, safe_div, zero_padded_id
from ..operators.numbering import number_rows
from ..params import FLOORS, FULL_SCALE_CUSTOMERS, SEVERITY_RANK, Scenario

QUEUE_SCHEMA = T.StructType([
    T.StructField("decision_id", T.StringType()),
    T.StructField("decision_type", T.StringType()),
    T.StructField("region_code", T.StringType()),
    T.StructField("style_id", T.StringType()),
    T.StructField("style_name", T.StringType()),
    T.StructField("metric_value", T.DoubleType()),
    T.StructField("metric_label", T.StringType()),
    T.StructField("headline", T.StringType()),
])

APPROVALS_SCHEMA = T.StructType([
    T.StructField("action_id", T.StringType()),
    T.StructField("decision_id", T.StringType()),
    T.StructField("option_chosen", T.StringType()),
    T.StructField("approved_by", T.StringType()),
    T.StructField("approved_at", T.TimestampType()),
    T.StructField("notes", T.StringType()),
])

_ORDER_COLS = ["blk", "k1", "k2", "k3", "k4", "rule"]


def whole_number(c: Column) -> Column:
    """Python-style ``{x:.0f}`` text: half-even to an integer."""
    return F.bround(c, 0).cast("long").cast("string")


def _typed(df: DataFrame, blk: int, keys: list[Column], rule: int, decision_type: str, region: Column,
           style_id: Column, style_name: Column, metric: Column, label: str, headline: Column) -> DataFrame:
    keys = keys + [F.lit(None).cast("string")] * (4 - len(keys))
    return df.select(F.lit(blk).alias("blk"), *[k.cast("string").alias(f"k{i + 1}") for i, k in enumerate(keys)],
                     F.lit(rule).alias("rule"), F.lit(decision_type).alias("decision_type"),
                     region.cast("string").alias("region_code"), style_id.cast("string").alias("style_id"),
                     style_name.alias("style_name"), metric.cast("double").alias("metric_value"),
                     F.lit(label).alias("metric_label"), headline.alias("headline"))


def region_rollup(signals: DataFrame) -> DataFrame:
    """Store signals rolled up to region × style (null keys dropped, as a pandas group-by does)."""
    keys = ["region_code", "style_id", "style_name", "category"]
    s = signals.where(F.col("location_type") == "Store").dropna(subset=keys)
    r = s.groupBy(*keys).agg(F.sum("on_hand_units").alias("on_hand_units"),
                             F.sum("projected_remaining_demand").alias("projected_remaining_demand"),
                             F.sum("trailing_avg_weekly_sales").alias("trailing_avg_weekly_sales"),
                             F.max("remaining_season_weeks").alias("remaining_season_weeks"))
    return (r.withColumn("overstock_pct", safe_div(F.col("on_hand_units") - F.col("projected_remaining_demand"),
                                                   F.col("projected_remaining_demand")))
             .withColumn("stockout_est_days", safe_div("on_hand_units", "trailing_avg_weekly_sales") * 7))


def materiality_floors(customers: DataFrame) -> dict[str, Column]:
    """Rule floors scaled by the number of customers in the data (a scalar subquery), with least values."""
    n = customers.select(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    return {k: F.greatest(F.lit(full) * n / F.lit(float(FULL_SCALE_CUSTOMERS)), F.lit(least)) for k, (full, least) in FLOORS.items()}


def overstock_stockout_rules(signals: DataFrame, sc: Scenario, floors: dict[str, Column]) -> DataFrame:
    """M7 + M8: region × style rows over the materiality floors."""
    th = sc.thresholds
    r = region_rollup(signals).where((F.col("projected_remaining_demand") >= floors["min_remaining_demand"])
                                     & (F.col("trailing_avg_weekly_sales") >= floors["min_weekly_rate"]))
    keys = [F.col("region_code"), F.col("style_id"), F.col("style_name"), F.col("category")]
    pct = F.col("overstock_pct")
    days = F.col("stockout_est_days")
    over = _typed(
        r.where(pct.isNotNull() & (pct >= th["overstock_pct_min"]) & (F.col("remaining_season_weeks") >= 4)),
        1, keys, 1, "Overstock", F.col("region_code"), F.col("style_id"), F.col("style_name"),
        F.round(pct * 100, 1), "% over projected remaining-season demand",
        F.concat(F.col("style_name"), F.lit(" -- "), F.col("region_code"),
                 F.lit(" inventory is projected to exceed remaining-season demand by "),
                 whole_number(pct * 100), F.lit("%.")))
    stock = _typed(
        r.where(days.isNotNull() & (days >= 0) & (days <= th["stockout_days_max"])),
        1, keys, 2, "Stockout", F.col("region_code"), F.col("style_id"), F.col("style_name"),
        F.round(days, 1), "estimated days to stockout",
        F.concat(F.col("style_name"), F.lit(" -- "), F.col("region_code"),
                 F.lit(" is expected to stock out within "), whole_number(days), F.lit(" days.")))
    return over.unionByName(stock)


def return_rate_shift(scorecard: DataFrame, as_of_week: int) -> DataFrame:
    """A11 + W4: per style × size, baseline (first 8 weeks of life) and recent (week >= as_of - 3) return rates."""
    g = scorecard.dropna(subset=["style_id", "size"])
    first = F.min("week_id").over(Window.partitionBy("style_id", "size"))
    g = g.withColumn("first_week", first)
    recent = F.col("week_id") >= as_of_week - 3
    return (g.groupBy("style_id", "size")
            .agg(F.avg(F.when(F.col("week_id") < F.col("first_week") + 8, F.col("return_rate"))).alias("baseline"),
                 F.avg(F.when(recent, F.col("return_rate"))).alias("recent"),
                 F.sum(F.when(recent, F.col("units_sold"))).alias("recent_units"),
                 F.min_by("style_name", "week_id").alias("style_name")))


def returns_rule(scorecard: DataFrame, sc: Scenario, floors: dict[str, Column]) -> DataFrame:
    """M9: recent return rate at least ``return_rate_delta_min`` above the style-size's own baseline."""
    s = return_rate_shift(scorecard, sc.as_of_week)
    delta = F.col("recent") - F.col("baseline")
    s = s.where((F.coalesce(F.col("recent_units"), F.lit(0)) >= floors["min_recent_units"])
                & F.col("baseline").isNotNull() & F.col("recent").isNotNull()
                & (delta >= sc.thresholds["return_rate_delta_min"]))
    label = F.concat(F.col("style_name"), F.lit(" ("), F.col("size"), F.lit(")"))
    return _typed(s, 2, [F.col("style_id"), F.col("size")], 3, "Returns", F.lit(None), F.col("style_id"), label,
                  F.round(delta * 100, 1), "pt increase in return rate",
                  F.concat(label, F.lit(" -- return rate increased from "), whole_number(F.col("baseline") * 100),
                           F.lit("% to "), whole_number(F.col("recent") * 100), F.lit("%.")))


def revenue_at_risk() -> Column:
    """A17 over ``marts.exposed_signals``: three weeks of trailing sales at current price for each of the PO
    terms, summed exactly (as ``exact_sum`` over the fanned-out M5 would); a decimal."""
    return F.sum((F.col("trailing_avg_weekly_sales") * 3 * F.col("current_retail_price")).cast("decimal(20,9)")
                 * F.col("n_terms").cast("decimal(10,0)"))


def supply_risk_rule(exposed: DataFrame, sc: Scenario) -> DataFrame:
    """Revenue at risk over 3 weeks across all delayed-PO exposure; one row when over the threshold.

    The reference names the first DC of an unordered frame; ours names the
    lowest dc_id (N11).
    """
    total = exposed.agg(revenue_at_risk().cast("double").alias("total"), F.min("dc_id").alias("dc_id"))
    total = total.where(F.col("total") >= sc.thresholds["revenue_at_risk_min"])
    name = F.concat(F.col("dc_id"), F.lit(" delayed supplier shipment"))
    return _typed(total, 3, [], 4, "Supply Risk", F.lit(None), F.lit(None), name, F.round("total", 0),
                  "revenue at risk (USD, 3wk window)",
                  F.concat(F.col("dc_id"), F.lit(" delay may expose $"), F.format_number(F.bround("total", 0), 0),
                           F.lit(" of revenue over the next three weeks.")))


def cohort_lift(cohort_scorecard: DataFrame, sc: Scenario, high_tiers: list[str]) -> DataFrame:
    """Mean orders of the cohort over the matched control (same region, high tiers, not in cohort); one row."""
    c = cohort_scorecard
    control = (F.col("home_region") == sc.cohort_region) & ~F.col("is_cohort") & F.col("loyalty_tier").isin(high_tiers)
    agg = c.agg(F.avg(F.when(control, F.col("n_orders"))).alias("control_rate"),
                F.avg(F.when(F.col("is_cohort"), F.col("n_orders"))).alias("cohort_rate"))
    return agg.withColumn("lift", F.when(F.col("control_rate") > 0, F.col("cohort_rate") / F.col("control_rate")))


def cohort_rule(cohort_scorecard: DataFrame, sc: Scenario, high_tiers: list[str]) -> DataFrame:
    """Cohort opportunity when the lift reaches ``cohort_lift_min``."""
    lift = cohort_lift(cohort_scorecard, sc, high_tiers)
    lift = lift.where(F.col("lift").isNotNull() & (F.col("lift") >= sc.thresholds["cohort_lift_min"]))
    return _typed(lift, 4, [], 5, "Cohort Opportunity", F.lit(sc.cohort_region), F.lit(None),
                  F.lit("Campaign cohort"), F.round("lift", 2), "x avg orders per customer vs matched control",
                  F.concat(F.lit("Customers acquired through the campaign show "),
                           F.format_string("%.1f", F.bround("lift", 1)), F.lit("x higher repeat-purchase probability.")))


def decision_queue(rules: list[DataFrame]) -> DataFrame:
    """Union in rule order, numbered DEC-0001.. by (rule block, group keys, rule)."""
    q = rules[0]
    for r in rules[1:]:
        q = q.unionByName(r)
    q = number_rows(q, [F.col(c).asc_nulls_first() for c in _ORDER_COLS])
    return q.select(zero_padded_id("DEC-", F.col("n")).alias("decision_id"),
                    *[c.name for c in QUEUE_SCHEMA.fields[1:]])


def triage(queue: DataFrame, flagship_styles: list[str], n: int = 5) -> DataFrame:
    """Flagship styles and programmes first, then severity, then metric size; top n."""
    programme = F.col("decision_type").isin("Supply Risk", "Cohort Opportunity")
    flag = contains_any("style_name", flagship_styles) | programme
    rank = F.coalesce(*[F.when(F.col("decision_type") == k, F.lit(v)) for k, v in SEVERITY_RANK.items()])
    return (queue.withColumn("is_flagship", flag).withColumn("severity_rank", rank)
            .orderBy(F.col("is_flagship").desc(), F.col("severity_rank").asc_nulls_last(),
                     F.col("metric_value").desc_nulls_last(), F.col("decision_id"))
            .limit(n))


def drill_down(queue: DataFrame, signals: DataFrame, n: int = 8) -> DataFrame:
    """For every overstock/stockout decision, its n store rows with the most on-hand (W9 per key)."""
    d = queue.where(F.col("decision_type").isin("Overstock", "Stockout")).select("decision_id", "region_code", "style_id")
    s = signals.where(F.col("location_type") == "Store").select(
        "region_code", "style_id", "location_id", "sku_id", "on_hand_units", "weeks_of_supply", "trailing_avg_weekly_sales")
    j = d.join(s, ["region_code", "style_id"])
    w = Window.partitionBy("decision_id").orderBy(F.col("on_hand_units").desc(), F.col("location_id"), F.col("sku_id"))
    return j.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def empty_approvals(spark) -> DataFrame:
    """The approvals table, empty, with its declared schema."""
    return spark.createDataFrame([], APPROVALS_SCHEMA)


def approval_row(spark, decision_id: str, option: str, approved_by: str, notes: str) -> DataFrame:
    """One approval stamped with the current time; id from the timestamp."""
    base = spark.range(1).select(
        F.lit(decision_id).alias("decision_id"), F.lit(option).alias("option_chosen"),
        F.lit(approved_by).alias("approved_by"), F.current_timestamp().alias("approved_at"), F.lit(notes).alias("notes"))
    return base.select(F.concat(F.lit("ACT-"), F.date_format("approved_at", "yyyyMMddHHmmss")).alias("action_id"),
                       "decision_id", "option_chosen", "approved_by", "approved_at", "notes")


def record_approval(spark, path: str, decision_id: str, option: str, approved_by: str, notes: str) -> DataFrame:
    """Append one approval to the approvals folder and read back the latest three."""
    approval_row(spark, decision_id, option, approved_by, notes).write.mode("append").parquet(path)
    return spark.read.schema(APPROVALS_SCHEMA).parquet(path).orderBy(F.col("approved_at").desc()).limit(3)
