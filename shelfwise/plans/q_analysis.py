"""Registered scenario analyses (M15-M38) and supply operators (E17-E21, E25) with SQL twins."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..oracle.fixture_sql import AS_OF, CTES, N_WEEKS, lit
from ..operators import supply
from ..params import DEFAULT as SC
from ..params import EVENT_SEQUENCE_DISRUPTED, EVENT_SEQUENCE_NORMAL, HIGH_TIERS, RETURN_BASELINE_RATE
from ..sources.fixture import VIRAL_STYLE, VIRAL_TRIGGER_WEEK, Fixture
from . import analysis as an
from .q_marts import cohort, gold
from .registry import register

# Fixture scenario keys
WARM = ["AFRICA", "MIDDLE EAST"]
COLD = ["AMERICA", "EUROPE"]
SHOCK_REGIONS = WARM + COLD
CATEGORY = "Outerwear"
FIT_STYLE = "Brand#13-MEDIUM"
FIT_SIZES = ["M", "L"]
FIT_REASON = "Fit-Small"
ALLOC_STYLES = ["Brand#11 Large", "Brand#12 Large"]
SHOCK_WEEK = AS_OF - 20


def _in(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def _seq(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


CTES["fx_engagement"] = f"""
SELECT sku_id, week_id,
       CAST(CASE WHEN lead THEN ROUND(views * 3.5) ELSE views END AS INTEGER) AS page_views,
       CAST(CASE WHEN lead THEN ROUND(atc * 3.0) ELSE atc END AS INTEGER) AS add_to_cart
FROM (SELECT sku_id, week_id, GREATEST(ROUND(SUM(units) * 22.0), 1) AS views, GREATEST(ROUND(SUM(units) * 3.5), 0) AS atc,
             style_id = {lit(VIRAL_STYLE)} AND week_id IN ({VIRAL_TRIGGER_WEEK - 2}, {VIRAL_TRIGGER_WEEK - 1}) AS lead
      FROM fx_sales WHERE channel = 'Ecommerce' GROUP BY sku_id, style_id, week_id)"""

CTES["fx_shipment_events"] = """
SELECT 'SHP-' || po_line_id || '-' || CAST(i + 1 AS VARCHAR) AS shipment_event_id, po_line_id,
       CAST(i + 1 AS INTEGER) AS event_seq, seq[i + 1] AS event_type,
       order_date + CAST(FLOOR(span * (i / GREATEST(len(seq) - 1, 1))) AS INTEGER) AS event_date,
       CASE WHEN seq[i + 1] = 'Received-DC' THEN dc_id ELSE 'In-Transit' END AS location_hint
FROM (SELECT *, UNNEST(range(0, len(seq))) AS i
      FROM (SELECT po_line_id, order_date, dc_id,
                   CASE WHEN is_delayed THEN %s ELSE %s END AS seq,
                   GREATEST(date_diff('day', order_date, revised_expected_receipt_date), 1) AS span
            FROM fx_po_lines))""" % (_seq(EVENT_SEQUENCE_DISRUPTED), _seq(EVENT_SEQUENCE_NORMAL))

CTES["an_exposure"] = f"""
SELECT region_code, CAST(SUM(on_hand_units) AS BIGINT) AS on_hand,
       CAST(SUM(CAST(projected_remaining_demand AS DECIMAL(20,9))) AS DOUBLE) AS proj_demand,
       CAST(SUM(CAST(on_hand_units * current_retail_price AS DECIMAL(20,2))) AS DOUBLE) AS inventory_value_at_risk
FROM gold_m3 WHERE region_code IN {_in(SHOCK_REGIONS)} AND category = {lit(CATEGORY)} AND location_type = 'Store'
GROUP BY 1"""

CTES["an_risk_region"] = """
SELECT region_code, CAST(SUM(on_hand_units) AS BIGINT) AS on_hand, AVG(weeks_of_supply) AS avg_weeks_of_supply,
       CAST(SUM(CAST(trailing_avg_weekly_sales * 3 * current_retail_price AS DECIMAL(20,9))) AS DOUBLE) AS revenue_at_risk_3wk
FROM gold_m5 GROUP BY 1"""

CTES["an_portfolio"] = """
SELECT region_code, style_id, style_name, CAST(SUM(on_hand_units) AS BIGINT) AS on_hand,
       CAST(SUM(CAST(projected_remaining_demand AS DECIMAL(20,9))) AS DOUBLE) AS proj_demand
FROM gold_m3 WHERE location_type = 'Store' GROUP BY 1, 2, 3"""


def _opt(name, units, revenue, cost, risk="") -> str:
    return (f"{{'option': {lit(name)}, 'units': CAST({units} AS BIGINT), 'expected_revenue': CAST(ROUND({revenue}, 0) AS DOUBLE), "
            f"'cost': CAST(ROUND({cost}, 0) AS DOUBLE), 'risk': {lit(risk)}}}")


def _options(opts) -> str:
    return "UNNEST([" + ", ".join(_opt(*o) for o in opts) + "], max_depth := 2)"


@register("m15_temperature_series",
          f"""SELECT w.week_start_date, f.region_code, f.avg_temp_vs_normal_c
              FROM fx_weather_actual f JOIN fx_dim_week w ON w.week_id = f.week_id
              WHERE f.region_code IN {_in(SHOCK_REGIONS)}""")
def q_m15(spark, sf_dir):
    """Temperature deviation series by region (J16 grid + J1 + P4)."""
    fx = Fixture(spark, sf_dir)
    return an.temperature_series(fx.weather_actual, fx.dim_week, SHOCK_REGIONS)


@register("m16_category_sell_through",
          f"""SELECT s.week_start_date, s.region_code, CAST(SUM(s.units) AS BIGINT) AS units
              FROM gold_m1 s JOIN fx_dim_style sty ON sty.style_id = s.style_id
              WHERE sty.category = {lit(CATEGORY)} AND s.region_code IN {_in(SHOCK_REGIONS)} GROUP BY 1, 2""")
def q_m16(spark, sf_dir):
    """Outerwear sell-through by region and week."""
    fx = Fixture(spark, sf_dir)
    from . import marts
    m1 = marts.weekly_demand_style_region(fx.sales, fx.dim_week)
    return an.category_sell_through(m1, fx.dim_week, fx.dim_style, CATEGORY, SHOCK_REGIONS)


@register("m17_regional_exposure",
          """SELECT *, (on_hand - proj_demand) / NULLIF(proj_demand, 0) * 100 AS overstock_pct FROM an_exposure""",
          round_cols=("proj_demand", "inventory_value_at_risk", "overstock_pct"))
def q_m17(spark, sf_dir):
    """Regional on-hand, projected demand, value at risk."""
    return an.regional_exposure(gold(Fixture(spark, sf_dir))["m3"], CATEGORY, SHOCK_REGIONS)


@register("m18_weather_options",
          f"""SELECT region_code, {_options([
              ("A - Transfer to cold regions", "tu", "tu * p * 0.85", "tu * 28", "Medium"),
              ("B - Hold & markdown at season end", "0", "-(on_hand * 0.30 * p)", "0.0", "High (margin)"),
              ("C - Increase digital allocation", "tu", "tu * p * 0.85 * 0.8", "tu * 28 * 0.3", "Low")])}
              FROM (SELECT region_code, on_hand, inventory_value_at_risk / on_hand AS p, FLOOR(on_hand * 0.25) AS tu
                    FROM an_exposure WHERE region_code IN {_in(WARM)} AND on_hand > 0)""")
def q_m18(spark, sf_dir):
    """Option costing for the weather shock (generic option explode)."""
    e = an.regional_exposure(gold(Fixture(spark, sf_dir))["m3"], CATEGORY, SHOCK_REGIONS)
    return an.weather_options(e, WARM)


@register("m19_style_sales_and_views",
          f"""SELECT w.week_start_date, u.units, v.page_views
              FROM (SELECT week_id, CAST(SUM(units) AS BIGINT) AS units FROM fx_sales WHERE style_id = {lit(VIRAL_STYLE)}
                    GROUP BY 1) u
              FULL JOIN (SELECT e.week_id, CAST(SUM(e.page_views) AS BIGINT) AS page_views FROM fx_engagement e
                         JOIN fx_dim_sku k ON k.sku_id = e.sku_id WHERE k.style_id = {lit(VIRAL_STYLE)} GROUP BY 1) v
                ON v.week_id = u.week_id
              JOIN fx_dim_week w ON w.week_id = COALESCE(u.week_id, v.week_id)""")
def q_m19(spark, sf_dir):
    """Sales of the viral style beside its page-view lead series."""
    fx = Fixture(spark, sf_dir)
    return an.style_sales_and_views(fx.sales, fx.engagement, fx.dim_sku, fx.dim_week, VIRAL_STYLE)


@register("e17_digital_engagement", "SELECT * FROM fx_engagement")
def q_e17(spark, sf_dir):
    """Ecommerce engagement roll-up with the pre-spike lead weeks."""
    return Fixture(spark, sf_dir).engagement


@register("m20_closest_to_stockout",
          f"""SELECT st.store_name, st.city, sig.sku_id, sig.on_hand_units, sig.stockout_est_days
              FROM gold_m3 sig JOIN fx_dim_store st ON st.store_id = sig.location_id
              WHERE sig.style_id = {lit(VIRAL_STYLE)} AND sig.stockout_est_days IS NOT NULL
              ORDER BY sig.stockout_est_days, st.store_name, sig.sku_id LIMIT 15""")
def q_m20(spark, sf_dir):
    """Stores closest to stockout on the viral style (O2)."""
    fx = Fixture(spark, sf_dir)
    return an.closest_to_stockout(gold(fx)["m3"], fx.dim_store, VIRAL_STYLE)


@register("m21_spike_options",
          f"""SELECT {_options([
              ("Do nothing", "0", "0.0", "0.0"),
              ("Expedite replenishment from DC", "lu", "lu * p", "lu * 6"),
              ("Reallocate from slower stores", "FLOOR(lu * 0.7)", "lu * 0.7 * p", "lu * 0.7 * 15")])}
              FROM (SELECT (SELECT FLOOR(COALESCE(SUM(on_hand_units), 0) * 0.4) FROM (
                              SELECT sig.on_hand_units, sig.stockout_est_days FROM gold_m3 sig
                              JOIN fx_dim_store st ON st.store_id = sig.location_id
                              WHERE sig.style_id = {lit(VIRAL_STYLE)} AND sig.stockout_est_days IS NOT NULL
                              ORDER BY sig.stockout_est_days, st.store_name, sig.sku_id LIMIT 15)
                            WHERE stockout_est_days < 14) AS lu,
                           (SELECT AVG(current_retail_price) FROM fx_dim_sku WHERE style_id = {lit(VIRAL_STYLE)}) AS p)""")
def q_m21(spark, sf_dir):
    """Expedite / reallocate options for the spike."""
    fx = Fixture(spark, sf_dir)
    top = an.closest_to_stockout(gold(fx)["m3"], fx.dim_store, VIRAL_STYLE)
    return an.spike_options(top, fx.dim_sku, VIRAL_STYLE)


@register("m22_return_rate_by_size",
          f"""SELECT week_start_date, size, return_rate FROM gold_m4
              WHERE style_id = {lit(FIT_STYLE)} AND size IN {_in(FIT_SIZES)}""")
def q_m22(spark, sf_dir):
    """Return rate by size over time."""
    return an.return_rate_by_size(gold(Fixture(spark, sf_dir))["m4"], FIT_STYLE, FIT_SIZES)


@register("m23_return_reason_mix",
          f"SELECT reason_code, COUNT(*) AS n FROM fx_returns WHERE style_id = {lit(FIT_STYLE)} GROUP BY 1")
def q_m23(spark, sf_dir):
    """Return reason mix."""
    return an.reason_mix(Fixture(spark, sf_dir).returns, FIT_STYLE)


@register("m24_review_sample",
          f"""SELECT return_line_id, review_text FROM fx_return_reviews
              WHERE style_id = {lit(FIT_STYLE)} AND review_text IS NOT NULL ORDER BY return_line_id LIMIT 8""")
def q_m24(spark, sf_dir):
    """Review texts of a style's returns (whole texts, ordered limit)."""
    fx = Fixture(spark, sf_dir)
    return an.review_sample(fx.return_reviews, FIT_STYLE)


@register("m25_fit_return_cost",
          f"""SELECT *, units_returned * (avg_price * 0.5 + 18.0) AS total_cost FROM (
                SELECT CAST(SUM(r.units_returned) AS BIGINT) AS units_returned, AVG(k.current_retail_price) AS avg_price
                FROM fx_returns r JOIN fx_dim_sku k ON k.sku_id = r.sku_id
                WHERE r.style_id = {lit(FIT_STYLE)} AND k.size IN {_in(FIT_SIZES)} AND r.reason_code = {lit(FIT_REASON)})""",
          round_cols=("avg_price", "total_cost"))
def q_m25(spark, sf_dir):
    """Cost of fit returns."""
    fx = Fixture(spark, sf_dir)
    return an.fit_return_cost(fx.returns, fx.dim_sku, FIT_STYLE, FIT_SIZES, FIT_REASON)


@register("m26_delayed_po_timeline",
          """SELECT po.po_line_id, po.style_id, sty.style_name, po.order_date, po.original_expected_receipt_date,
                    po.revised_expected_receipt_date, po.actual_receipt_date, e.event_seq, e.event_type, e.event_date
             FROM fx_po_lines po JOIN fx_dim_style sty ON sty.style_id = po.style_id
             JOIN fx_shipment_events e ON e.po_line_id = po.po_line_id WHERE po.is_delayed""")
def q_m26(spark, sf_dir):
    """Delayed PO timeline with milestones."""
    fx = Fixture(spark, sf_dir)
    return an.delayed_po_timeline(fx.po_lines, fx.dim_style, fx.shipment_events)


@register("e18_shipment_events", "SELECT * FROM fx_shipment_events")
def q_e18(spark, sf_dir):
    """PO milestone events spread from order to revised receipt."""
    return Fixture(spark, sf_dir).shipment_events


@register("e19_po_delay",
          """SELECT po_line_id, style_id, supplier_id, dc_id, is_delayed,
                    CAST(date_diff('day', original_expected_receipt_date, revised_expected_receipt_date) AS INTEGER) AS delay_days
             FROM fx_po_lines""")
def q_e19(spark, sf_dir):
    """PO delay days and late flag."""
    return supply.po_delay(Fixture(spark, sf_dir).po_lines)


@register("m27_revenue_at_risk_by_region", "SELECT * FROM an_risk_region",
          round_cols=("avg_weeks_of_supply", "revenue_at_risk_3wk"))
def q_m27(spark, sf_dir):
    """Revenue at risk by region."""
    return an.revenue_at_risk_by_region(gold(Fixture(spark, sf_dir))["exposed"])


@register("m28_vip_exposure",
          f"""SELECT c.loyalty_tier, COUNT(DISTINCT c.customer_id) AS n_customers FROM fx_dim_customer c
              WHERE c.home_region IN (SELECT DISTINCT region_code FROM gold_m5)
                AND c.loyalty_tier IN {_in(HIGH_TIERS)} GROUP BY 1""")
def q_m28(spark, sf_dir):
    """VIP customers in exposed regions (J11 semi join + A14)."""
    fx = Fixture(spark, sf_dir)
    return an.vip_exposure(fx.dim_customer, gold(fx)["exposed"], HIGH_TIERS)


@register("m29_supply_options",
          f"""SELECT {_options([
              ("Do nothing (accept the delay)", "0", "0.0", "0.0"),
              ("Expedite freight (air vs. ocean)", "0", "t * 0.7", "t * 0.07"),
              ("Transfer from other DCs", "0", "t * 0.45", "t * 0.03"),
              ("Controlled stockout, VIP-priority allocation", "0", "t * 0.3", "t * 0.01")])}
              FROM (SELECT COALESCE(SUM(revenue_at_risk_3wk), 0.0) AS t FROM an_risk_region)""")
def q_m29(spark, sf_dir):
    """Supply mitigation options."""
    return an.supply_options(an.revenue_at_risk_by_region(gold(Fixture(spark, sf_dir))["exposed"]))


_cols30 = "style_name, color_name, size, on_hand_units, overstock_pct, stockout_est_days, sku_id"


@register("m30_city_extremes",
          f"""SELECT city, kind, {_cols30} FROM (
                SELECT *, ROW_NUMBER() OVER (PARTITION BY city, kind ORDER BY ka DESC, sku_id DESC) AS rn FROM (
                  SELECT st.city, 'surplus' AS kind, sig.overstock_pct AS ka, sig.* FROM gold_m3 sig
                  JOIN fx_dim_store st ON st.store_id = sig.location_id
                  WHERE sig.style_name IN {_in(ALLOC_STYLES)} AND sig.overstock_pct > 0
                  UNION ALL
                  SELECT st.city, 'shortage', -sig.stockout_est_days, sig.* FROM gold_m3 sig
                  JOIN fx_dim_store st ON st.store_id = sig.location_id
                  WHERE sig.style_name IN {_in(ALLOC_STYLES)} AND sig.stockout_est_days < 30))
              WHERE rn = 1""")
def q_m30(spark, sf_dir):
    """Worst surplus and shortage row per city (O7 max_by/min_by)."""
    fx = Fixture(spark, sf_dir)
    return an.city_extremes(gold(fx)["m3"], fx.dim_store, ALLOC_STYLES)


@register("m31_portfolio_rollup",
          f"""SELECT *, (on_hand - proj_demand) / NULLIF(proj_demand, 0) * 100 AS overstock_pct FROM an_portfolio
              WHERE style_name IN {_in(ALLOC_STYLES)}""",
          round_cols=("proj_demand", "overstock_pct"))
def q_m31(spark, sf_dir):
    """Portfolio surplus / shortage by region × style."""
    return an.portfolio_rollup(gold(Fixture(spark, sf_dir))["m3"], ALLOC_STYLES)


@register("m32_transfer_decisions",
          f"""SELECT style_id, from_region, to_region, {_options([
              ("A - Transfer", "tu", "tu * pr * 0.9", "tu * 26", "Medium"),
              ("B - Hold inventory", "0", "-(surplus_on_hand * pr * 0.35 * 0.5)", "0.0", "High - markdown exposure"),
              ("C - Increase digital allocation", "tu", "tu * pr * 0.85", "tu * 26 * 0.25", "Low")])}
              FROM (SELECT s.style_id, s.region_code AS from_region, d.region_code AS to_region,
                           s.on_hand AS surplus_on_hand, pr.avg_price AS pr,
                           FLOOR(LEAST(s.on_hand * 0.4, d.proj_demand * 1.2)) AS tu
                    FROM (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY style_id
                                  ORDER BY (on_hand - proj_demand) / NULLIF(proj_demand, 0) * 100 DESC, region_code DESC) AS rn
                                  FROM an_portfolio WHERE (on_hand - proj_demand) / NULLIF(proj_demand, 0) * 100 > 0) WHERE rn = 1) s
                    JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY style_id
                                  ORDER BY on_hand - proj_demand, region_code) AS rn
                                  FROM an_portfolio WHERE on_hand < proj_demand) WHERE rn = 1) d ON d.style_id = s.style_id
                    JOIN (SELECT style_id, CAST(SUM(CAST(current_retail_price AS DECIMAL(20,2))) AS DOUBLE) / COUNT(*)
                                 AS avg_price FROM fx_dim_sku GROUP BY 1) pr
                      ON pr.style_id = s.style_id)""",
          round_cols=("expected_revenue", "cost"))
def q_m32(spark, sf_dir):
    """Per-style transfer decision with costed options A/B/C."""
    fx = Fixture(spark, sf_dir)
    return an.transfer_decisions(an.portfolio_rollup(gold(fx)["m3"]), fx.dim_sku)


@register("m34_weighted_cohort_lift",
          f"""SELECT *, MAX(CASE WHEN is_cohort THEN avg_orders END) OVER ()
                        / NULLIF(MAX(CASE WHEN NOT is_cohort THEN avg_orders END) OVER (), 0) AS lift
              FROM (SELECT is_cohort, SUM(avg_orders * n) / SUM(n) AS avg_orders, CAST(SUM(n) AS BIGINT) AS n
                    FROM (SELECT is_cohort, loyalty_tier, COUNT(*) AS n, AVG(n_orders) AS avg_orders FROM gold_m6
                          WHERE home_region = {lit(SC.cohort_region)} AND loyalty_tier IN {_in(HIGH_TIERS)} GROUP BY 1, 2)
                    GROUP BY 1)""",
          round_cols=("avg_orders", "lift"))
def q_m34(spark, sf_dir):
    """Weighted cohort lift against the matched control (A12 + A13)."""
    return an.weighted_cohort_lift(cohort(Fixture(spark, sf_dir)), SC.cohort_region, HIGH_TIERS)


@register("m35_capsule_affinity",
          f"""SELECT is_cohort, AVG(capsule_units) AS avg_capsule_units FROM gold_m6
              WHERE home_region = {lit(SC.cohort_region)} GROUP BY 1""",
          round_cols=("avg_capsule_units",))
def q_m35(spark, sf_dir):
    """Capsule affinity by cohort."""
    return an.capsule_affinity(cohort(Fixture(spark, sf_dir)), SC.cohort_region)


@register("m37_executive_rollup",
          f"""SELECT *, overstock_cost + stockout_cost + supply_risk_cost + returns_cost AS total_exposure,
                     (overstock_cost + stockout_cost + supply_risk_cost + returns_cost) * 0.55 AS total_recovery
              FROM (SELECT
                CAST(ROUND(COALESCE((SELECT SUM(CAST(GREATEST(overstock_units, 0) * current_retail_price * 0.35 AS DECIMAL(20,9)))
                          FROM gold_m3 WHERE overstock_pct > 0.2), 0), 4) AS DOUBLE) AS overstock_cost,
                CAST(ROUND(COALESCE((SELECT SUM(CAST(trailing_avg_weekly_sales * 3 * current_retail_price AS DECIMAL(20,9)))
                          FROM gold_m3 WHERE stockout_est_days < 14), 0), 4) AS DOUBLE) AS stockout_cost,
                CAST(ROUND(COALESCE((SELECT SUM(CAST(trailing_avg_weekly_sales * 3 * current_retail_price AS DECIMAL(20,9)))
                          FROM gold_m5), 0), 4) AS DOUBLE) AS supply_risk_cost,
                CAST(ROUND(COALESCE((SELECT SUM(CAST(r.units_returned * 0.5 * k.current_retail_price AS DECIMAL(20,9)))
                          FROM fx_returns r JOIN fx_dim_sku k ON k.sku_id = r.sku_id WHERE r.week_id >= {AS_OF - 12}), 0), 4)
                  AS DOUBLE) AS returns_cost)""",
          round_cols=("total_exposure", "total_recovery"))
def q_m37(spark, sf_dir):
    """Executive exposure roll-up (four aggregates combined into one row)."""
    fx = Fixture(spark, sf_dir)
    g = gold(fx)
    return an.executive_rollup(g["m3"], g["exposed"], fx.returns, fx.dim_sku, fx.sc.as_of_week)


# ------------------------------------------------------------------ weather forecast snapshots
CTES["fx_forecast"] = f"""
SELECT region_code, as_of_week_id, target_week_id,
       CAST(CASE WHEN surprise THEN 0.0 ELSE actual_at_target END AS FLOAT) AS forecast_temp_vs_normal_c,
       surprise AS is_surprise,
       CAST(actual_at_target - CASE WHEN surprise THEN 0.0 ELSE actual_at_target END AS FLOAT) AS forecast_error
FROM (SELECT o.region_code, o.as_of_week_id, o.target_week_id, a.avg_temp_vs_normal_c AS actual_at_target,
             o.region_code IN {_in(WARM)} AND o.target_week_id >= {SHOCK_WEEK} AND o.as_of_week_id < {SHOCK_WEEK} AS surprise
      FROM (SELECT region_code, week_id AS as_of_week_id, week_id + UNNEST(range(1, 9)) AS target_week_id
            FROM fx_weather_actual) o
      JOIN fx_weather_actual a ON a.region_code = o.region_code AND a.week_id = o.target_week_id
      WHERE o.target_week_id <= {N_WEEKS})"""


@register("e20_forecast_snapshots", "SELECT * FROM fx_forecast")
def q_e20(spark, sf_dir):
    """E20 + E21: forecast snapshots with the actual at target and the pre-shock surprise."""
    fx = Fixture(spark, sf_dir)
    return supply.forecast_snapshots(fx.weather_actual, fx.sc.n_weeks, SHOCK_WEEK, WARM)


_base_rate = "CASE category " + " ".join(f"WHEN {lit(k)} THEN {v!r}" for k, v in RETURN_BASELINE_RATE.items()) + " ELSE 0.1 END"
_fit = f"style_id = {lit(FIT_STYLE)} AND size IN {_in(FIT_SIZES)} AND week_id >= {SHOCK_WEEK}"


@register("e25_expected_returns",
          f"""SELECT order_id, style_id, size, week_id, units, rate AS return_rate, units * rate AS expected_units_returned,
                     fit AS is_fit_problem
              FROM (SELECT *, CASE WHEN {_fit} THEN 0.3 ELSE {_base_rate} END AS rate, {_fit} AS fit FROM fx_sales)""",
          round_cols=("return_rate", "expected_units_returned"))
def q_e25(spark, sf_dir):
    """Expected returns by category baseline with the fit-problem override."""
    return supply.expected_returns(Fixture(spark, sf_dir).sales, FIT_STYLE, FIT_SIZES, SHOCK_WEEK, 0.3)
