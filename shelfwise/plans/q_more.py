"""Registered what-if engine runs and remaining table operators."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..oracle.fixture_sql import AS_OF, CTES, ENGINE_PLAN, N_WEEKS, case, engine_sql, lit, week_of
from ..operators import engine as eng
from ..operators import fx as fxo
from ..operators.broadcast import bounded_broadcast
from ..operators.supply import demand_rate, location_weight
from ..params import CATEGORY_HOLIDAY_FACTOR, FX_BAND, FX_BASE_RATE_TO_USD, SIZE_LABELS, TIER_WEIGHT
from ..sources.fixture import VIRAL_STYLE, VIRAL_TRIGGER_WEEK, Fixture
from .registry import register

SURPLUS = ("AMERICA", ["Brand#11-LARGE", "Brand#12-LARGE"])
SHORTAGE = ("EUROPE", ["Brand#11-LARGE", "Brand#12-LARGE"])
FREEZE = ("ASIA", "Outerwear", AS_OF - 8)


def _in(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


@register("a10_loyalty_tier_share",
          """SELECT loyalty_tier, COUNT(*) AS n_customers, COUNT(*) / SUM(COUNT(*)) OVER () AS share
             FROM fx_dim_customer GROUP BY 1""", round_cols=("share",))
def q_a10(spark, sf_dir):
    """A9 + A10: customers per loyalty tier and their share of all customers."""
    c = Fixture(spark, sf_dir).dim_customer.groupBy("loyalty_tier").agg(F.count(F.lit(1)).alias("n_customers"))
    # the frame has one row per tier (five rows): a global window over it is bounded
    return c.withColumn("share", F.col("n_customers") / F.sum("n_customers").over(Window.partitionBy()))


@register("e2_style_listing_windows",
          f"""SELECT * FROM (SELECT style_id, GREATEST({week_of('launch_date')}, 1) AS start_week,
                                    LEAST({week_of('planned_exit_date + INTERVAL 42 DAY')}, {N_WEEKS}) AS end_week
                             FROM fx_dim_style) WHERE start_week <= end_week""")
def q_e2(spark, sf_dir):
    """Launch -> exit + 6 clearance weeks, clipped to the calendar, empty windows dropped."""
    fx = Fixture(spark, sf_dir)
    return eng.style_windows(fx.dim_style, lambda c: cal.week_of(c, fx.sc), 6, fx.sc.n_weeks)


def _whatif(plan):
    surplus = (F.col("region_code") == SURPLUS[0]) & F.col("style_id").isin(SURPLUS[1])
    shortage = (F.col("region_code") == SHORTAGE[0]) & F.col("style_id").isin(SHORTAGE[1])
    return eng.allocation_bias(plan, surplus, shortage)


_sur = f"(region_code = {lit(SURPLUS[0])} AND style_id IN {_in(SURPLUS[1])})"
_sho = f"(region_code = {lit(SHORTAGE[0])} AND style_id IN {_in(SHORTAGE[1])})"
_frz = (f"(region_code = {lit(FREEZE[0])} AND style_id IN (SELECT style_id FROM fx_dim_style "
        f"WHERE category = {lit(FREEZE[1])}))")
CTES["fx_engine_whatif"] = engine_sql(f"""
SELECT * REPLACE (
    CASE WHEN {_sur} THEN initial_alloc * {1 + 0.35!r} WHEN {_sho} THEN initial_alloc * {1 - 0.35!r}
         ELSE initial_alloc END AS initial_alloc,
    CASE WHEN {_sur} THEN supply_cap * {1 + 0.35!r} ELSE supply_cap END AS supply_cap,
    CASE WHEN {_sho} THEN replenish_rate * 0.2 ELSE replenish_rate END AS replenish_rate,
    CASE WHEN {_frz} THEN {FREEZE[2]} ELSE 1000000 END AS freeze_week)
FROM ({ENGINE_PLAN})""")


@register("e6_e7_what_if_supply",
          f"""SELECT location_id, sku_id, s_t, realized_cum_sales, on_hand_units, unmet_cum_demand
              FROM fx_engine_whatif WHERE week_id = {AS_OF}""")
def q_e6(spark, sf_dir):
    """E6 + E7: the sell-through engine under a what-if plan: over/under-allocation of two styles and a
    supply freeze for one region's outerwear; as-of snapshot."""
    fx = Fixture(spark, sf_dir)
    outer = fx.dim_style.where(F.col("category") == FREEZE[1]).select("style_id", F.lit(True).alias("_outer"))

    def plan_fn(plan):
        plan = plan.join(outer, "style_id", "left")
        frozen = (F.col("region_code") == FREEZE[0]) & F.coalesce(F.col("_outer"), F.lit(False))
        plan = plan.withColumn("freeze_week", F.when(frozen, F.lit(FREEZE[2])).otherwise(F.col("freeze_week")))
        return _whatif(plan.drop("_outer"))

    e = eng.run_engine(fx.weekly, fx.dim_style, plan_fn=plan_fn)
    return e.where(F.col("week_id") == fx.sc.as_of_week).select(
        "location_id", "sku_id", "s_t", "realized_cum_sales", "on_hand_units", "unmet_cum_demand")


def _d(x) -> str:
    return f"CAST({x!r} AS DOUBLE)"


_life = (f"CASE WHEN t < 4 THEN {_d(0.3)} + {_d(0.175)} * t WHEN t < 17 THEN {_d(1.0)} "
         f"WHEN t < 31 THEN {_d(1.0)} - (t - 17) * {_d(0.65 / 14)} ELSE {_d(0.455)} END")
_hol = f"CASE WHEN is_holiday_week THEN {case('category', CATEGORY_HOLIDAY_FACTOR, 1.3)} ELSE {_d(1.0)} END"
_ramp = (f"{_d(1.0)} + {_d(0.4)} * LEAST(GREATEST({_d(1.0)} - ABS(days_to_christmas) / {_d(21.0)}, {_d(0.0)}), "
         f"{_d(1.0)})")
_wx = (f"CASE WHEN category = 'Outerwear' AND warmth_rating >= 3 THEN LEAST(GREATEST({_d(1.0)} - {_d(0.05)} * "
       f"GREATEST(COALESCE(avg_temp_vs_normal_c, {_d(0.0)}), {_d(0.0)}) * warmth_rating / {_d(5.0)}, {_d(0.4)}), "
       f"{_d(1.05)}) ELSE {_d(1.0)} END")
_vir = (f"CASE WHEN style_id = {lit(VIRAL_STYLE)} THEN (CASE WHEN week_id < {VIRAL_TRIGGER_WEEK} THEN {_d(1.0)} "
        f"WHEN week_id < {VIRAL_TRIGGER_WEEK + 4} THEN {_d(5.0)} * {_d(1.0)} ELSE {_d(2.0)} * {_d(1.0)} END) "
        f"ELSE {_d(1.0)} END")


@register("e8_expected_demand",
          f"""SELECT location_id, sku_id, CAST(SUM(CAST(rate AS DECIMAL(20,9))) AS DOUBLE) AS expected_demand,
                     COUNT(*) AS n_weeks FROM (
                SELECT location_id, sku_id,
                       GREATEST(CAST(location_weight AS DOUBLE) * ({_life}) * ({_hol}) * ({_ramp}) * ({_wx}) * ({_vir})
                                * {_d(0.55)}, {_d(0.0)}) AS rate
                FROM (SELECT e.location_id, e.sku_id, e.week_id, e.style_id,
                             GREATEST(e.week_id - e.launch_week, 0) AS t,
                             sty.category, sty.warmth_rating, w.is_holiday_week, w.days_to_christmas,
                             wx.avg_temp_vs_normal_c,
                             CASE WHEN e.location_type = 'Store' THEN {case('st.store_tier', TIER_WEIGHT, 0.6)}
                                  ELSE (SELECT COUNT(*) * 0.5 FROM fx_dim_store s WHERE s.region_code = e.region_code) END AS location_weight
                      FROM fx_engine e
                      JOIN fx_dim_style sty ON sty.style_id = e.style_id
                      JOIN fx_dim_week w ON w.week_id = e.week_id
                      LEFT JOIN fx_weather_actual wx ON wx.region_code = e.region_code AND wx.week_id = e.week_id
                      LEFT JOIN fx_dim_store st ON st.store_id = e.location_id))
              GROUP BY 1, 2""")
def q_e8(spark, sf_dir):
    """E4 + E8 + F21-F24 + J15: expected weekly demand rate over every listing week, summed per listing."""
    fx = Fixture(spark, sf_dir)
    e = fx.engine.select("location_id", "location_type", "region_code", "sku_id", "style_id", "week_id", "launch_week")
    sty = fx.dim_style.select("style_id", "category", "warmth_rating")
    wk = fx.dim_week.select("week_id", "is_holiday_week", "days_to_christmas")
    wx = fx.weather_actual.select("region_code", "week_id", "avg_temp_vs_normal_c")
    dense = (e.join(sty, "style_id").join(wk, "week_id").join(wx, ["region_code", "week_id"], "left")
             )
    dense = location_weight(dense, fx.dim_store)
    r = demand_rate(dense, VIRAL_TRIGGER_WEEK, VIRAL_STYLE)
    # per-week rates summed as 9-place decimals: exact, so the total does not depend on summation order
    return r.groupBy("location_id", "sku_id").agg(
        F.sum(F.col("demand_rate").cast("decimal(20,9)")).cast("double").alias("expected_demand"),
                                                 F.count(F.lit(1)).alias("n_weeks"))


_alpha = "[" + ", ".join(lit(s) for s in SIZE_LABELS) + "]"
_num = "[" + ", ".join(lit(str(38 + i)) for i in range(5)) + "]"


@register("e23_sku_expansion",
          f"""SELECT style_id, color_name, size,
                     style_id || '-' || upper(substr(color_name, 1, 3)) || '-' || replace(size, ' ', '') AS sku_code,
                     CASE WHEN size = 'One Size' THEN 'One Size' WHEN regexp_matches(size, '^[0-9]+$') THEN 'Numeric'
                          ELSE 'Alpha' END AS size_type
              FROM (SELECT style_id, UNNEST(colours) AS color_name, sizes FROM (
                      SELECT s.style_id, list_sort(list_distinct(list(k.color_name))) AS colours,
                             CASE WHEN s.category = 'Footwear' THEN {_num} ELSE {_alpha} END AS sizes
                      FROM fx_dim_style s JOIN fx_dim_sku k ON k.style_id = s.style_id GROUP BY s.style_id, s.category))
              CROSS JOIN UNNEST(sizes) AS z(size)""")
def q_e23(spark, sf_dir):
    """Every style's colours × its category's size run, with SKU codes (double explode)."""
    fx = Fixture(spark, sf_dir)
    cols = fx.dim_sku.groupBy("style_id").agg(F.array_sort(F.collect_set("color_name")).alias("colours"))
    st = fx.dim_style.select("style_id", "category").join(cols, "style_id")
    sizes = F.when(F.col("category") == "Footwear", F.array(*[F.lit(str(38 + i)) for i in range(5)])) \
             .otherwise(F.array(*[F.lit(s) for s in SIZE_LABELS]))
    return eng.sku_expansion(st, F.col("colours"), sizes)


_cur_rows = ", ".join(f"({lit(c)}, {i}, CAST({r!r} AS DOUBLE))" for i, (c, r) in enumerate(FX_BASE_RATE_TO_USD.items()))


@register("e24_revenue_usd",
          f"""WITH cur(currency_code, currency_no, base_rate) AS (VALUES {_cur_rows}),
             walk AS (
               SELECT c.currency_code, w.week_id, c.base_rate,
                      c.base_rate * EXP(SUM(LN(1 + CASE WHEN c.base_rate = 1.0 THEN 0.0
                                         ELSE CAST((w.week_id * 5 + c.currency_no * 7) % 9 - 4 AS DOUBLE) / 1000.0 END))
                        OVER (PARTITION BY c.currency_code ORDER BY w.week_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS raw_rate
               FROM fx_dim_week w CROSS JOIN cur c),
             rates AS (
               SELECT currency_code, week_id,
                      ROUND(LEAST(GREATEST(raw_rate, base_rate * (1 - {FX_BAND})), base_rate * (1 + {FX_BAND})), 8)
                        AS rate_to_usd
               FROM walk),
             rev AS (
               SELECT s.region_code, r.currency_code, s.week_id, SUM(s.revenue_cents) AS revenue_cents
               FROM fx_sales s JOIN fx_dim_region r ON r.region_code = s.region_code
               GROUP BY 1, 2, 3)
             SELECT rev.region_code, rev.currency_code, rev.week_id,
                    CAST(rev.revenue_cents AS BIGINT) / 100.0 AS revenue_local, rt.rate_to_usd,
                    CAST(rev.revenue_cents AS BIGINT) / 100.0 * rt.rate_to_usd AS revenue_usd
             FROM rev LEFT JOIN rates rt ON rt.currency_code = rev.currency_code AND rt.week_id = rev.week_id""",
          round_cols=("revenue_usd",))
def q_e24(spark, sf_dir):
    """W6 + E24: weekly revenue per region in its currency, converted to USD by the currency × week rate
    of a clipped random walk (cumulative product). Currencies without a rate keep their row with a NULL
    USD amount."""
    fx = Fixture(spark, sf_dir)
    # calendar × literal currency list: bounded by construction
    rates = fxo.rate_walk(fx.dim_week.select("week_id"), FX_BASE_RATE_TO_USD, FX_BAND) \
               .withColumn("rate_to_usd", F.round("rate_to_usd", 8))
    # pre-aggregate map-side to region × week before anything else touches the rows
    rev = fx.sales.groupBy("region_code", "week_id").agg(F.sum("revenue_cents").alias("revenue_cents"))
    rev = rev.join(bounded_broadcast(fx.dim_region.select("region_code", "currency_code")), "region_code")
    rev = rev.select("region_code", "currency_code", "week_id", (F.col("revenue_cents") / 100.0).alias("revenue_local"))
    out = fxo.to_usd(rev, "revenue_local", bounded_broadcast(rates))
    return out.select("region_code", "currency_code", "week_id", "revenue_local", "rate_to_usd",
                      F.col("revenue_local_usd").alias("revenue_usd"))
