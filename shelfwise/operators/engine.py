"""Listing windows, dense listing × week explode and constrained sell-through.

Closed form (no week loop): with a monotone supply schedule S_t that does not
depend on sales, realised cumulative sales are ``min(cumsum(demand), S_t)``.
Every window here is partitioned by (location_id, sku_id) and ordered by
week_id, so all of them share one exchange and one sort; the exchange runs on
the weekly demand grain (at most n_weeks rows per listing), never on raw lines.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import INITIAL_ALLOC_FRACTION, MARKDOWN_LADDER, MARKDOWN_TAIL
from ..functions.expr import ladder, safe_div, whole

LISTING_KEYS = ["location_id", "sku_id"]
NO_FREEZE = 1_000_000


def weekly_demand(sales: DataFrame, n_partitions: int | None = None) -> DataFrame:
    """Sales grain (N14): units and revenue per (location, sku, week), hash-partitioned by listing.

    The partial aggregate runs map-side, so a hot SKU is combined before the
    shuffle; the explicit (location_id, sku_id) repartition deals the aggregated
    rows as the bucketed table does that keeps them, so each bucket is one file
    and later listing aggregates, joins and windows need no exchange.
    """
    g = (sales.groupBy("location_id", "location_type", "region_code", "sku_id", "style_id", "week_id")
         .agg(F.sum("units").alias("units"), F.sum("revenue_cents").alias("revenue_cents")))
    return g.repartition(n_partitions, *LISTING_KEYS) if n_partitions else g.repartition(*LISTING_KEYS)


def listing_windows(weekly: DataFrame) -> DataFrame:
    """store_sku_assortment of the fixture: first and last sale week and total units per listing."""
    return (weekly.groupBy("location_id", "location_type", "region_code", "sku_id", "style_id")
            .agg(F.min("week_id").alias("assortment_start_week"),
                 F.max("week_id").alias("assortment_end_week"),
                 F.sum("units").alias("total_units")))


def style_windows(dim_style: DataFrame, week_of, clearance_weeks: int = 6, n_weeks: int = 357) -> DataFrame:
    """Launch -> exit + clearance weeks, clipped to the calendar; empty windows dropped."""
    s = week_of(F.col("launch_date"))
    e = week_of(F.date_add(F.col("planned_exit_date"), 7 * clearance_weeks))
    return (dim_style.select("style_id", F.greatest(s, F.lit(1)).alias("start_week"),
                             F.least(e, F.lit(n_weeks)).alias("end_week"))
            .where(F.col("start_week") <= F.col("end_week")))


def supply_plan(listings: DataFrame, cap: Column, initial_fraction: float = INITIAL_ALLOC_FRACTION) -> DataFrame:
    """E5: cap, initial allocation and linear replenishment per listing."""
    n_active = F.greatest(F.col("assortment_end_week") - F.col("assortment_start_week") + 1, F.lit(1))
    return (listings.withColumn("supply_cap", cap.cast("double"))
            .withColumn("initial_alloc", F.lit(initial_fraction) * F.col("supply_cap"))
            .withColumn("replenish_rate", (F.col("supply_cap") - F.col("initial_alloc")) / n_active))


def allocation_bias(plan: DataFrame, surplus: Column, shortage: Column, pct_over: float = 0.35,
                    pct_under: float = 0.35, shortage_replenish: float = 0.2) -> DataFrame:
    """What-if allocation skew: surplus listings get +pct initial and cap, shortage -pct initial and a slower refill."""
    return (plan
            .withColumn("initial_alloc", F.when(surplus, F.col("initial_alloc") * (1 + pct_over))
                        .when(shortage, F.col("initial_alloc") * (1 - pct_under)).otherwise(F.col("initial_alloc")))
            .withColumn("supply_cap", F.when(surplus, F.col("supply_cap") * (1 + pct_over)).otherwise(F.col("supply_cap")))
            .withColumn("replenish_rate", F.when(shortage, F.col("replenish_rate") * shortage_replenish)
                        .otherwise(F.col("replenish_rate"))))


def explode_weeks(listings: DataFrame) -> DataFrame:
    """One row per listing and active week (sparse: only the listing's own window).

    ``explode`` keeps the child's partitioning, so the dense rows are born in
    the listing's partition and never cross the network.
    """
    return listings.withColumn("week_id", F.explode(F.sequence("assortment_start_week", "assortment_end_week")))


def sell_through(dense: DataFrame) -> DataFrame:
    """E7 + E9 + E10 + E12 on a dense (listing, week) frame.

    Needs columns: demand_units and either a given supply schedule ``s_t`` or
    initial_alloc, replenish_rate, supply_cap, launch_week, freeze_week
    (NO_FREEZE when none) to build it (E5 + E7). Adds s_t, cum_demand,
    realized_cum_sales, realized_sales, on_hand, on_hand_units,
    weeks_of_supply, unmet_cum_demand.

    A frame that goes on from an earlier run carries its closing state per
    listing as opening_demand, opening_realized and opening_recent (null for a
    listing that starts now); they are dropped.
    """
    w = Window.partitionBy(*LISTING_KEYS).orderBy("week_id")
    cum = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last4 = w.rowsBetween(-3, Window.currentRow)
    growth = F.greatest(F.least(F.col("week_id"), F.col("freeze_week") - 1) - F.col("launch_week"), F.lit(0))
    s_t = F.least(F.col("initial_alloc") + F.col("replenish_rate") * growth, F.col("supply_cap"))
    if "s_t" not in dense.columns:
        dense = dense.withColumn("s_t", s_t)
    goes_on = "opening_demand" in dense.columns
    cum_demand, before = F.sum("demand_units").over(cum), F.lag("realized_cum_sales", 1, 0.0).over(w)
    trailing = F.avg("realized_sales").over(last4)
    if goes_on:
        cum_demand = cum_demand + F.coalesce("opening_demand", F.lit(0).cast("long"))
        before = F.coalesce(F.lag("realized_cum_sales", 1).over(w), F.col("opening_realized"), F.lit(0.0))
        recent = F.coalesce("opening_recent", F.array().cast("array<int>"))
        taken = F.least(F.size(recent), F.lit(4) - F.count("realized_sales").over(last4).cast("int"))
        carried = F.aggregate(F.slice(recent, F.size(recent) - taken + 1, taken), F.lit(0).cast("long"), lambda a, x: a + x)
        trailing = (F.sum("realized_sales").over(last4) + carried).cast("double") / (F.count("realized_sales").over(last4) + taken)
    # one projection per dependency level (each withColumn call re-analyses the whole window plan)
    out = (dense
           .withColumn("cum_demand", cum_demand)
           .withColumn("realized_cum_sales", F.least(F.col("cum_demand").cast("double"), F.col("s_t")))
           .withColumns({
               "gain": F.greatest(F.col("realized_cum_sales") - before, F.lit(0.0)),
               "on_hand": F.greatest(F.col("s_t") - F.col("realized_cum_sales"), F.lit(0.0))})
           .withColumn("realized_sales", whole("gain", "int"))
           .withColumns({"on_hand_units": whole("on_hand", "int"),
                         "trailing4": trailing})
           .withColumns({
               "weeks_of_supply": F.least(F.coalesce(safe_div("on_hand", "trailing4"), F.lit(52.0)), F.lit(52.0)),
               "unmet_cum_demand": F.col("cum_demand") - F.col("realized_cum_sales")}))
    return out.drop("gain", "trailing4", *OPENING)


OPENING = ["opening_demand", "opening_realized", "opening_recent"]


def closing_state(rows: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """What the sell-through needs to go on after ``rows`` (its output up to some week): per listing the
    cumulative demand, the realised cumulative sales and the last three realised weeks, oldest first.

    ``opening`` is the state before ``rows``; its listings without a row keep theirs. One row per listing and one
    exchange at most (none over a table bucketed by listing), whatever the length of the history."""
    last = F.max_by(F.struct("cum_demand", "realized_cum_sales"), "week_id")
    recent = F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("week_id", "realized_sales")))), 1, 3)  # a listing's weeks
    new = (rows.groupBy(*LISTING_KEYS).agg(last.alias("l"), recent.alias("r"))
           .select(*LISTING_KEYS, F.col("l.cum_demand").alias("opening_demand"), F.col("l.realized_cum_sales").alias("opening_realized"),
                   F.reverse(F.col("r.realized_sales")).alias("opening_recent")))
    if opening is None:
        return new
    old = opening.select(*LISTING_KEYS, *[F.col(c).alias(f"old_{c}") for c in OPENING])
    both = F.concat(F.coalesce("old_opening_recent", F.array().cast("array<int>")), F.coalesce("opening_recent", F.array().cast("array<int>")))
    return new.join(old, LISTING_KEYS, "full").select(
        *LISTING_KEYS, F.coalesce("opening_demand", "old_opening_demand").alias("opening_demand"),
        F.coalesce("opening_realized", "old_opening_realized").alias("opening_realized"),
        F.slice(both, F.greatest(F.size(both) - 2, F.lit(1)), 3).alias("opening_recent"))


def sku_expansion(styles: DataFrame, colours: Column, sizes: Column) -> DataFrame:
    """E23 + F13 + F14: colours × sizes per style, with a colour code, SKU code and size type."""
    e = (styles.withColumn("color_name", F.explode(colours)).withColumn("size", F.explode(sizes)))
    code = F.upper(F.substring("color_name", 1, 3))
    return e.select("style_id", "color_name", "size",
                    F.concat_ws("-", "style_id", code, F.regexp_replace("size", " ", "")).alias("sku_code"),
                    F.when(F.col("size") == "One Size", F.lit("One Size"))
                     .when(F.col("size").rlike("^[0-9]+$"), F.lit("Numeric")).otherwise(F.lit("Alpha")).alias("size_type"))


def markdown(weeks_since_launch: Column) -> Column:
    """0 % before week 17 of life, 20 % before week 31, else 40 %."""
    return ladder(weeks_since_launch, MARKDOWN_LADDER, MARKDOWN_TAIL)


def run_engine(weekly: DataFrame, dim_style: DataFrame, freeze: Column | None = None, plan_fn=None,
               until_week: int | None = None) -> DataFrame:
    """Fixture demand engine: listings from sales, cap = total demand, initial .55 cap.

    Returns the dense (location, sku, week) frame with demand, revenue and the
    sell-through columns. Plan: one hash exchange of the weekly grain on
    (location_id, sku_id); the listing aggregate, the gap-filling join and all
    windows reuse it (requireAllClusterKeysForCoPartition=false).
    """
    plan = listing_plan(weekly, dim_style, freeze, plan_fn)
    if until_week is not None:
        # every window looks backwards only, so weeks past ``until_week`` never change earlier rows
        plan = _weeks(plan, 1, until_week)
    return sell_through(dense_weeks(plan, weekly))


def listing_plan(weekly: DataFrame, dim_style: DataFrame, freeze: Column | None = None, plan_fn=None) -> DataFrame:
    """The supply plan (E5-E7) of every listing: one row with its window, cap, refill, launch and freeze week."""
    plan = supply_plan(listing_windows(weekly), F.col("total_units"))
    plan = plan.join(dim_style.select("style_id", "launch_week"), "style_id", "left")
    plan = plan.withColumn("freeze_week", freeze if freeze is not None else F.lit(NO_FREEZE))
    # what-if edits of the supply plan (E6), per listing, before the explode
    return plan if plan_fn is None else plan_fn(plan)


def _weeks(plan: DataFrame, first: int, last: int) -> DataFrame:
    """The plan's listings that are active in the weeks ``first`` to ``last``, their windows cut to them."""
    return (plan.where((F.col("assortment_start_week") <= last) & (F.col("assortment_end_week") >= first))
            .withColumns({"assortment_start_week": F.greatest("assortment_start_week", F.lit(first)),
                          "assortment_end_week": F.least("assortment_end_week", F.lit(last))}))


def dense_weeks(plan: DataFrame, weekly: DataFrame) -> DataFrame:
    """E3 + J3: a row per listing and week of its window with the week's demand and revenue (0 where none)."""
    demand = weekly.select("location_id", "sku_id", "week_id",
                           F.col("units").alias("demand_units_raw"), F.col("revenue_cents").alias("revenue_raw"))
    return (explode_weeks(plan).join(demand, ["location_id", "sku_id", "week_id"], "left")
            .withColumn("demand_units", F.coalesce(F.col("demand_units_raw"), F.lit(0)).cast("long"))
            .withColumn("revenue_cents", F.coalesce(F.col("revenue_raw"), F.lit(0).cast("long")))
            .drop("demand_units_raw", "revenue_raw"))


def resume(plan: DataFrame, weekly: DataFrame, first_week: int, last_week: int, opening: DataFrame | None = None) -> DataFrame:
    """E9 for the weeks ``first_week`` to ``last_week`` of a fixed supply plan, going on from ``opening`` (the closing
    state of all weeks before; none at the start). Reads the demand of those weeks only; the rows equal those of a
    run over all weeks."""
    window = {"window_start": "assortment_start_week", "window_end": "assortment_end_week"}
    cut = _weeks(plan.withColumns({k: F.col(c) for k, c in window.items()}), first_week, last_week)
    if opening is not None:
        cut = cut.join(opening, LISTING_KEYS, "left")
    out = sell_through(dense_weeks(cut, weekly.where(F.col("week_id").between(first_week, last_week))))
    return out.drop(*window.values()).withColumnsRenamed(window)  # a row keeps its listing's window, not the cut one
