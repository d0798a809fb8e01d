"""Registered decision-queue queries (M7-M14) with their SQL twins."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..oracle.fixture_sql import AS_OF, CTES, lit
from ..params import DEFAULT as SC
from ..params import FLOORS, FULL_SCALE_CUSTOMERS, HIGH_TIERS, SEVERITY_RANK
from ..sources.fixture import Fixture
from . import decisions as dq
from .q_marts import cohort, gold
from .registry import register

TH = SC.thresholds
FLAGSHIP_STYLES = ["Brand#11 Large", "Brand#12 Large", "Brand#13 Medium"]


def queue_rules(fx: Fixture):
    g = gold(fx)
    floors = dq.materiality_floors(fx.table("customer"))
    return [dq.overstock_stockout_rules(g["m3"], fx.sc, floors), dq.returns_rule(g["m4"], fx.sc, floors),
            dq.supply_risk_rule(g["exposed"], fx.sc), dq.cohort_rule(cohort(fx), fx.sc, HIGH_TIERS)]


def queue(fx: Fixture):
    if getattr(fx, "_queue", None) is None:
        fx._queue = fx.once("decision_queue", lambda: dq.decision_queue(queue_rules(fx)))
    return fx._queue


def _num(x: str) -> str:
    return f"CAST(CAST(ROUND_EVEN({x}, 0) AS BIGINT) AS VARCHAR)"


def _floor(name: str) -> str:
    full, least = FLOORS[name]
    return f"GREATEST({full!r} * (SELECT COUNT(*) FROM customer) / {float(FULL_SCALE_CUSTOMERS)!r}, {least!r})"


_tiers = ", ".join(lit(t) for t in HIGH_TIERS)

CTES["dq_roll"] = f"""
SELECT *, (on_hand_units - proj) / NULLIF(proj, 0) AS pct, on_hand_units / NULLIF(trail, 0) * 7 AS days
FROM (SELECT region_code, style_id, style_name, category, CAST(SUM(on_hand_units) AS BIGINT) AS on_hand_units,
             SUM(projected_remaining_demand) AS proj, SUM(trailing_avg_weekly_sales) AS trail,
             MAX(remaining_season_weeks) AS remaining
      FROM gold_m3
      WHERE location_type = 'Store' AND region_code IS NOT NULL AND style_id IS NOT NULL
        AND style_name IS NOT NULL AND category IS NOT NULL
      GROUP BY 1, 2, 3, 4)"""

CTES["dq_rules"] = f"""
SELECT 1 AS blk, region_code AS k1, style_id AS k2, style_name AS k3, category AS k4, 1 AS rule,
       'Overstock' AS decision_type, region_code, style_id, style_name, ROUND(pct * 100, 1) AS metric_value,
       '% over projected remaining-season demand' AS metric_label,
       style_name || ' -- ' || region_code || ' inventory is projected to exceed remaining-season demand by '
         || {_num('pct * 100')} || '%.' AS headline
FROM dq_roll
WHERE proj >= {_floor('min_remaining_demand')} AND trail >= {_floor('min_weekly_rate')}
  AND pct IS NOT NULL AND pct >= {TH['overstock_pct_min']!r} AND remaining >= 4
UNION ALL
SELECT 1, region_code, style_id, style_name, category, 2, 'Stockout', region_code, style_id, style_name,
       ROUND(days, 1), 'estimated days to stockout',
       style_name || ' -- ' || region_code || ' is expected to stock out within ' || {_num('days')} || ' days.'
FROM dq_roll
WHERE proj >= {_floor('min_remaining_demand')} AND trail >= {_floor('min_weekly_rate')}
  AND days IS NOT NULL AND days >= 0 AND days <= {TH['stockout_days_max']!r}
UNION ALL
SELECT 2, style_id, size, NULL, NULL, 3, 'Returns', NULL, style_id, style_name || ' (' || size || ')',
       ROUND((recent - baseline) * 100, 1), 'pt increase in return rate',
       style_name || ' (' || size || ') -- return rate increased from ' || {_num('baseline * 100')} || '% to '
         || {_num('recent * 100')} || '%.'
FROM (SELECT style_id, size,
             AVG(return_rate) FILTER (WHERE week_id < first_week + 8) AS baseline,
             AVG(return_rate) FILTER (WHERE week_id >= {AS_OF - 3}) AS recent,
             SUM(units_sold) FILTER (WHERE week_id >= {AS_OF - 3}) AS recent_units,
             arg_min(style_name, week_id) AS style_name
      FROM (SELECT *, MIN(week_id) OVER (PARTITION BY style_id, size) AS first_week FROM gold_m4
            WHERE style_id IS NOT NULL AND size IS NOT NULL)
      GROUP BY 1, 2)
WHERE COALESCE(recent_units, 0) >= {_floor('min_recent_units')} AND baseline IS NOT NULL AND recent IS NOT NULL
  AND recent - baseline >= {TH['return_rate_delta_min']!r}
UNION ALL
SELECT 3, NULL, NULL, NULL, NULL, 4, 'Supply Risk', NULL, NULL, dc_id || ' delayed supplier shipment',
       ROUND(total, 0), 'revenue at risk (USD, 3wk window)',
       dc_id || ' delay may expose $' || format('{{:,}}', CAST(ROUND_EVEN(total, 0) AS BIGINT))
         || ' of revenue over the next three weeks.'
FROM (SELECT CAST(SUM(CAST(trailing_avg_weekly_sales * 3 * current_retail_price AS DECIMAL(20,9))) AS DOUBLE)
             AS total, MIN(dc_id) AS dc_id FROM gold_m5)
WHERE total >= {TH['revenue_at_risk_min']!r}
UNION ALL
SELECT 4, NULL, NULL, NULL, NULL, 5, 'Cohort Opportunity', {lit(SC.cohort_region)}, NULL, 'Campaign cohort',
       ROUND(lift, 2), 'x avg orders per customer vs matched control',
       'Customers acquired through the campaign show ' || format('{{:.1f}}', ROUND_EVEN(lift, 1))
         || 'x higher repeat-purchase probability.'
FROM (SELECT CASE WHEN control_rate > 0 THEN cohort_rate / control_rate END AS lift
      FROM (SELECT AVG(n_orders) FILTER (WHERE home_region = {lit(SC.cohort_region)} AND NOT is_cohort
                                           AND loyalty_tier IN ({_tiers})) AS control_rate,
                   AVG(n_orders) FILTER (WHERE is_cohort) AS cohort_rate
            FROM gold_m6))
WHERE lift IS NOT NULL AND lift >= {TH['cohort_lift_min']!r}"""

CTES["gold_dq"] = """
SELECT printf('DEC-%04d', ROW_NUMBER() OVER (ORDER BY blk NULLS FIRST, k1 NULLS FIRST, k2 NULLS FIRST,
                                                   k3 NULLS FIRST, k4 NULLS FIRST, rule NULLS FIRST)) AS decision_id,
       decision_type, region_code, style_id, style_name, CAST(metric_value AS DOUBLE) AS metric_value,
       metric_label, headline
FROM dq_rules"""


@register("decision_queue", "SELECT * FROM gold_dq")
def q_queue(spark, sf_dir):
    """The rules-derived decision queue (flagship query)."""
    return queue(Fixture(spark, sf_dir))


@register("m7_region_style_rollup",
          f"""SELECT region_code, style_id, style_name, category, on_hand_units, proj AS projected_remaining_demand,
                     trail AS trailing_avg_weekly_sales, remaining AS remaining_season_weeks,
                     pct AS overstock_pct, days AS stockout_est_days FROM dq_roll""",
          round_cols=("projected_remaining_demand", "trailing_avg_weekly_sales", "overstock_pct", "stockout_est_days"))
def q_rollup(spark, sf_dir):
    """Region × style roll-up of store signals feeding M7/M8."""
    return dq.region_rollup(gold(Fixture(spark, sf_dir))["m3"])


@register("m9_return_rate_shift",
          f"""SELECT style_id, size, baseline, recent, recent_units, style_name FROM (
                SELECT style_id, size,
                       AVG(return_rate) FILTER (WHERE week_id < first_week + 8) AS baseline,
                       AVG(return_rate) FILTER (WHERE week_id >= {AS_OF - 3}) AS recent,
                       CAST(SUM(units_sold) FILTER (WHERE week_id >= {AS_OF - 3}) AS BIGINT) AS recent_units,
                       arg_min(style_name, week_id) AS style_name
                FROM (SELECT *, MIN(week_id) OVER (PARTITION BY style_id, size) AS first_week FROM gold_m4
                      WHERE style_id IS NOT NULL AND size IS NOT NULL)
                GROUP BY 1, 2)""",
          round_cols=("baseline", "recent"))
def q_return_shift(spark, sf_dir):
    """M9 inputs: baseline vs recent return rate per style × size (W4 + A11)."""
    return dq.return_rate_shift(gold(Fixture(spark, sf_dir))["m4"], SC.as_of_week)


@register("m11_cohort_lift",
          f"""SELECT control_rate, cohort_rate, CASE WHEN control_rate > 0 THEN cohort_rate / control_rate END AS lift
              FROM (SELECT AVG(n_orders) FILTER (WHERE home_region = {lit(SC.cohort_region)} AND NOT is_cohort
                                                   AND loyalty_tier IN ({_tiers})) AS control_rate,
                           AVG(n_orders) FILTER (WHERE is_cohort) AS cohort_rate FROM gold_m6)""",
          round_cols=("control_rate", "cohort_rate", "lift"))
def q_cohort_lift(spark, sf_dir):
    """Cohort lift against the matched control."""
    fx = Fixture(spark, sf_dir)
    return dq.cohort_lift(cohort(fx), fx.sc, HIGH_TIERS)


_flag_style = " OR ".join(f"COALESCE(style_name, '') LIKE {lit('%' + s + '%')}" for s in FLAGSHIP_STYLES)
_sev = "CASE decision_type " + " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in SEVERITY_RANK.items()) + " END"


@register("m13_decision_triage",
          f"""SELECT *, ({_flag_style}) OR decision_type IN ('Supply Risk', 'Cohort Opportunity') AS is_flagship,
                     {_sev} AS severity_rank
              FROM gold_dq
              ORDER BY is_flagship DESC, severity_rank ASC NULLS LAST, metric_value DESC NULLS LAST, decision_id
              LIMIT 5""")
def q_triage(spark, sf_dir):
    """Top-5 triage (P12 + P21 + O3)."""
    return dq.triage(queue(Fixture(spark, sf_dir)), FLAGSHIP_STYLES)


@register("m14_decision_drill_down",
          """SELECT * FROM (
                SELECT d.decision_id, d.region_code, d.style_id, s.location_id, s.sku_id, s.on_hand_units,
                       s.weeks_of_supply, s.trailing_avg_weekly_sales,
                       ROW_NUMBER() OVER (PARTITION BY d.decision_id
                                          ORDER BY s.on_hand_units DESC, s.location_id, s.sku_id) AS rank
                FROM gold_dq d JOIN gold_m3 s ON s.region_code = d.region_code AND s.style_id = d.style_id
                WHERE d.decision_type IN ('Overstock', 'Stockout') AND s.location_type = 'Store') WHERE rank <= 8""")
def q_drill(spark, sf_dir):
    """Store detail of every overstock / stockout decision, top 8 by on-hand."""
    fx = Fixture(spark, sf_dir)
    return dq.drill_down(queue(fx), gold(fx)["m3"]).select(
        "decision_id", "region_code", "style_id", "location_id", "sku_id", "on_hand_units", "weeks_of_supply",
        "trailing_avg_weekly_sales", F.col("rank").cast("long").alias("rank"))


@register("m8_stockout_rule",
          """SELECT decision_type, region_code, style_id, style_name, CAST(metric_value AS DOUBLE) AS metric_value,
                    metric_label, headline
             FROM dq_rules WHERE rule = 2""")
def q_stockout_rule(spark, sf_dir):
    """M8: region × style rows expected to stock out within the day threshold, over the materiality floors."""
    fx = Fixture(spark, sf_dir)
    rules = dq.overstock_stockout_rules(gold(fx)["m3"], fx.sc, dq.materiality_floors(fx.table("customer")))
    return rules.where(F.col("rule") == 2).select(
        "decision_type", "region_code", "style_id", "style_name", "metric_value", "metric_label", "headline")


@register("m10_revenue_at_risk",
          f"""SELECT CAST(ROUND(total, 2) AS DOUBLE) AS revenue_at_risk, dc_id, CAST(n AS BIGINT) AS n_exposed_rows,
                     COALESCE(total >= {TH['revenue_at_risk_min']!r}, FALSE) AS over_threshold
              FROM (SELECT SUM(CAST(trailing_avg_weekly_sales * 3 * current_retail_price AS DECIMAL(20,9))) AS total,
                           MIN(dc_id) AS dc_id, COUNT(*) AS n FROM gold_m5)""")
def q_revenue_at_risk(spark, sf_dir):
    """M10 input: three-week revenue at risk over all delayed-PO exposure (A17 + A19) and whether it
    reaches the rule threshold; always one row (the rule itself adds a queue row only when it does)."""
    fx = Fixture(spark, sf_dir)
    t = gold(fx)["exposed"].agg(dq.revenue_at_risk().alias("total"), F.min("dc_id").alias("dc_id"),
                                F.coalesce(F.sum("n_terms"), F.lit(0)).alias("n_exposed_rows"))
    return t.select(F.round("total", 2).cast("double").alias("revenue_at_risk"), "dc_id", "n_exposed_rows",
                    F.coalesce(F.col("total") >= TH["revenue_at_risk_min"], F.lit(False)).alias("over_threshold"))
