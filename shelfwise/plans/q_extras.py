"""Registered engine-side operators (E1, E4, E11, E13-E16, E22, S16) with SQL twins."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.expr import case_map, money
from ..oracle.fixture_sql import CTES, case, lit, week_of
from ..operators import attribution as attr
from ..operators import sampling
from ..operators.supply import location_weight
from ..params import DEFAULT as SC
from ..params import LOYALTY_WEIGHT, STORE_TIER_COVERAGE, TIER_WEIGHT
from ..sources.fixture import Fixture
from .registry import register

REPEAT_LIFT = 2.0
CAPSULE_LIFT = 1.5


@register("e1_fiscal_calendar",
          f"""SELECT w.* FROM fx_dim_week w
              WHERE w.week_id IN (SELECT DISTINCT {week_of('l_shipdate')} FROM lineitem)""")
def q_e1(spark, sf_dir):
    """E1 + F1-F7: the fiscal calendar of every week the ship dates touch."""
    fx = Fixture(spark, sf_dir)
    weeks = fx.table("lineitem").select(cal.week_of("l_shipdate", fx.sc).alias("week_id")).distinct()
    return cal.with_calendar(weeks, fx.sc)


@register("e22_dim_style", "SELECT * FROM fx_dim_style")
def q_dim_style(spark, sf_dir):
    """Styles with launch / planned exit and the uncapped exit week."""
    return Fixture(spark, sf_dir).dim_style


@register("e23_dim_sku", "SELECT * FROM fx_dim_sku")
def q_dim_sku(spark, sf_dir):
    """E22/E23 + F13/F14: SKUs with size type, colour family and the active flag (exit + 6 weeks >= as-of)."""
    return Fixture(spark, sf_dir).dim_sku


@register("e11_engine_sales",
          """SELECT location_id || '-' || e.sku_id || '-' || CAST(week_id AS VARCHAR) AS order_id, location_id, e.sku_id,
                    week_id, realized_sales AS units, md AS markdown_pct,
                    CAST(up AS DOUBLE) AS unit_price,
                    CAST(CAST(ROUND(CAST(up * realized_sales AS DECIMAL(20,4)), 2) AS DECIMAL(18,2)) AS DOUBLE) AS gross_revenue
             FROM (SELECT e.*, k.current_retail_price,
                          CASE WHEN week_id - launch_week < 17 THEN 0.0 WHEN week_id - launch_week < 31 THEN 0.2 ELSE 0.4 END AS md,
                          CAST(ROUND(CAST(CAST(ROUND(CAST(k.current_retail_price AS DECIMAL(20,4)), 2) AS DECIMAL(18,2))
                               * (1 - CAST(CASE WHEN week_id - launch_week < 17 THEN 0.0 WHEN week_id - launch_week < 31
                                               THEN 0.2 ELSE 0.4 END AS DECIMAL(3,2))) AS DECIMAL(20,4)), 2)
                               AS DECIMAL(18,2)) AS up
                   FROM fx_engine e JOIN fx_dim_sku k ON k.sku_id = e.sku_id WHERE e.realized_sales > 0) e""")
def q_e11(spark, sf_dir):
    """Realised (constrained) sales with markdown by weeks since launch, net price and revenue."""
    from ..operators.engine import markdown
    fx = Fixture(spark, sf_dir)
    e = fx.engine.where(F.col("realized_sales") > 0).join(fx.dim_sku.select("sku_id", "current_retail_price"), "sku_id")
    md = markdown(F.col("week_id") - F.col("launch_week"))
    up = money(money("current_retail_price") * (F.lit(1) - md.cast("decimal(3,2)")))
    return e.select(F.concat_ws("-", "location_id", "sku_id", F.col("week_id").cast("string")).alias("order_id"),
                    "location_id", "sku_id", "week_id", F.col("realized_sales").alias("units"),
                    md.alias("markdown_pct"), up.cast("double").alias("unit_price"),
                    money(up * F.col("realized_sales")).cast("double").alias("gross_revenue"))


@register("e4_location_weight",
          f"""SELECT a.*, CASE WHEN a.location_type = 'Store' THEN {case('st.store_tier', TIER_WEIGHT, 0.6)}
                              ELSE COALESCE(pr.ecom_weight, 1.0) END AS location_weight
              FROM fx_assortment a
              LEFT JOIN fx_dim_store st ON st.store_id = a.location_id
              LEFT JOIN (SELECT region_code, COUNT(*) * 0.5 AS ecom_weight FROM fx_dim_store GROUP BY 1) pr
                ON pr.region_code = a.region_code""")
def q_e4(spark, sf_dir):
    """Listing weight by store tier (virtual locations: 0.5 per store in the region)."""
    fx = Fixture(spark, sf_dir)
    return location_weight(fx.assortment, fx.dim_store).select(*fx.assortment.columns, "location_weight")


@register("e14_stratified_assortment",
          f"""SELECT location_id, sku_id, is_core_flag FROM (
                SELECT a.*, ROW_NUMBER() OVER (PARTITION BY a.location_id
                                               ORDER BY md5(CAST(a.sku_id AS VARCHAR) || '|42'), a.sku_id) AS rk,
                       GREATEST(FLOOR(COUNT(*) OVER (PARTITION BY a.location_id)
                                      * {case('st.store_tier', STORE_TIER_COVERAGE, 0.015)}), 1) AS n
                FROM fx_assortment a JOIN fx_dim_store st ON st.store_id = a.location_id WHERE NOT a.is_core_flag)
              WHERE rk <= n
              UNION ALL
              SELECT location_id, sku_id, is_core_flag FROM fx_assortment WHERE is_core_flag""")
def q_e14(spark, sf_dir):
    """Per location, a tier share of the bulk SKUs in hash order, plus every core (forced) SKU."""
    fx = Fixture(spark, sf_dir)
    a = fx.assortment.join(fx.dim_store.select(F.col("store_id").alias("location_id"), "store_tier"), "location_id")
    cov = case_map("store_tier", STORE_TIER_COVERAGE, 0.015)
    picked = sampling.stratified_pick(a.where(~F.col("is_core_flag")), "location_id", ["sku_id"], cov)
    cols = ["location_id", "sku_id", "is_core_flag"]
    return picked.select(*cols).unionByName(fx.assortment.where("is_core_flag").select(*cols))


@register("e15_disjoint_style_slices",
          """SELECT style_id, CASE WHEN rk <= 5 THEN 'disrupted' ELSE 'allocation' END AS slice FROM (
                SELECT style_id, ROW_NUMBER() OVER (ORDER BY md5(CAST(style_id AS VARCHAR) || '|42'), style_id) AS rk
                FROM fx_dim_style WHERE category = 'Outerwear') WHERE rk <= 8""")
def q_e15(spark, sf_dir):
    """Disjoint hash-ordered slices of the outerwear styles (first 5, next 3)."""
    st = Fixture(spark, sf_dir).dim_style.where(F.col("category") == "Outerwear").select("style_id")
    return sampling.disjoint_slices(st, ["style_id"], {"disrupted": 5, "allocation": 3})


@register("e16_campaign_audience",
          """SELECT customer_id FROM (
                SELECT * FROM fx_dim_customer WHERE loyalty_tier = 'Private Client'
                  AND (SELECT COUNT(*) FROM fx_dim_customer WHERE loyalty_tier = 'Private Client') >= 100
                UNION ALL
                SELECT * FROM fx_dim_customer
                WHERE (SELECT COUNT(*) FROM fx_dim_customer WHERE loyalty_tier = 'Private Client') < 100)
             ORDER BY md5(CAST(customer_id AS VARCHAR) || '|42') LIMIT 50""")
def q_e16(spark, sf_dir):
    """Campaign audience by segment with fallback to everyone, first 50 in hash order."""
    c = Fixture(spark, sf_dir).dim_customer
    return sampling.audience(c, "loyalty_tier", "Private Client", 50).select("customer_id")


@register("s16_sku_sample",
          """SELECT sku_id, style_id FROM fx_dim_sku
             WHERE style_id NOT LIKE '%-LARGE' ORDER BY md5(CAST(sku_id AS VARCHAR) || '|42') LIMIT 5""")
def q_s16(spark, sf_dir):
    """Deterministic 5-row sample of non-outerwear SKUs (sampled after the filter, N7)."""
    s = Fixture(spark, sf_dir).dim_sku.where(~F.col("style_id").endswith("-LARGE")).select("sku_id", "style_id")
    return sampling.hash_sample(s, 5, ["sku_id"])


_w = case("c.loyalty_tier", LOYALTY_WEIGHT, 1.0)
_w1 = f"CASE WHEN p.region_code = {lit(SC.cohort_region)} AND c.is_cohort THEN c.w0 * {REPEAT_LIFT!r} ELSE c.w0 END"
CTES["attr_members"] = f"""
SELECT p.region_code, p.is_capsule, c.customer_id,
       CAST(CASE WHEN p.is_capsule AND c.is_cohort THEN ({_w1}) * {CAPSULE_LIFT!r} ELSE {_w1} END AS DOUBLE) AS weight
FROM (SELECT DISTINCT region_code, starts_with(style_id, {lit(SC.capsule_prefix)}) AS is_capsule FROM fx_sales) p
JOIN (SELECT c.customer_id, c.home_region, COALESCE(c.acquisition_campaign_id = {lit(SC.cohort_campaign_id)}, FALSE) AS is_cohort,
             {_w} AS w0 FROM fx_dim_customer c) c
  ON c.home_region = p.region_code
  OR NOT EXISTS (SELECT 1 FROM fx_dim_customer x WHERE x.home_region = p.region_code)"""

CTES["attr_intervals"] = """
SELECT *, COALESCE(SUM(weight) OVER (PARTITION BY region_code, is_capsule ORDER BY customer_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS lo,
       SUM(weight) OVER (PARTITION BY region_code, is_capsule) AS pool_total
FROM attr_members"""


@register("e13_customer_attribution",
          f"""SELECT s.order_id, s.l_orderkey, s.l_linenumber, s.region_code, s.is_capsule, i.customer_id
              FROM (SELECT order_id, l_orderkey, l_linenumber, region_code,
                           CAST(CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)), 1, 13)
                                     AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS draw,
                           starts_with(style_id, {lit(SC.capsule_prefix)}) AS is_capsule FROM fx_sales) s
              JOIN attr_intervals i ON i.region_code = s.region_code AND i.is_capsule = s.is_capsule
               AND i.lo <= s.draw * i.pool_total
               AND s.draw * i.pool_total
                   < i.lo + i.weight""")
def q_e13(spark, sf_dir):
    """Weighted attribution of every sales line to a customer of its region (bucketed range join)."""
    fx = Fixture(spark, sf_dir)
    cust = fx.dim_customer.select(
        "customer_id", "home_region", "loyalty_tier",
        F.coalesce(F.col("acquisition_campaign_id") == fx.sc.cohort_campaign_id, F.lit(False)).alias("is_cohort"))
    lines = fx.sales.select("order_id", "l_orderkey", "l_linenumber", "region_code",
                            F.col("style_id").startswith(fx.sc.capsule_prefix).alias("is_capsule"))
    pools = lines.select("region_code", "is_capsule").distinct()
    members = attr.pool_members(cust, pools, fx.sc.cohort_region, REPEAT_LIFT, CAPSULE_LIFT)
    out = attr.attribute(lines, attr.cumulative_intervals(members))
    return out.select("order_id", "l_orderkey", "l_linenumber", "region_code", "is_capsule", "customer_id")


# ------------------------------------------------------------------ propensity
@register("l1_propensity_target",
          f"""SELECT customer_id, n_orders, CAST(n_orders >= (SELECT MEDIAN(n_orders) FROM gold_m6
                                                          WHERE home_region = {lit(SC.cohort_region)}) AS INTEGER)
                     AS is_high_frequency
              FROM gold_m6 WHERE home_region = {lit(SC.cohort_region)}""")
def q_l1(spark, sf_dir):
    """L1 + A16: binary frequency target against the exact median."""
    from . import propensity as pr
    from .q_marts import cohort
    return pr.with_target(cohort(Fixture(spark, sf_dir)), SC.cohort_region).select(
        "customer_id", "n_orders", "is_high_frequency")


@register("l4_top_propensity_clients")
def q_l4(spark, sf_dir):
    """L2-L4: logistic-regression propensity, top 37 clients (rows-only check: iterative fit)."""
    from . import propensity as pr
    from .q_marts import cohort
    data = pr.with_target(cohort(Fixture(spark, sf_dir)), SC.cohort_region)
    return pr.rank_clients(data, pr.fit_propensity(data))


@register("l3_fit_gradient",
          f"""SELECT CAST(unnest(range(-1, n_features)) AS INTEGER) AS weight, n_rows, TRUE AS at_optimum
               FROM (SELECT COUNT(*) AS n_rows, COUNT(DISTINCT loyalty_tier) - 1 + 4 AS n_features
                     FROM fx_dim_customer WHERE home_region = {lit(SC.cohort_region)}) s""")
def q_l3_gradient(spark, sf_dir):
    """L3: proof of the fit: every weight's gradient of the regularised loss is below 1e-6 of its feature's scale."""
    from . import propensity as pr
    from .q_marts import cohort
    data = pr.with_target(cohort(Fixture(spark, sf_dir)), SC.cohort_region)
    g = pr.fit_gradient(data, pr.fit_propensity(data))
    return g.select("weight", "n_rows", (F.abs("gradient") <= 1e-6 * F.greatest(F.lit(1.0), F.col("scale"))).alias("at_optimum"))


@register("m36_outreach_revenue",
          f"""SELECT n_clients, avg_order_value, n_clients * avg_order_value * 0.35 AS expected_revenue
              FROM (SELECT CAST(LEAST(37, (SELECT COUNT(*) FROM fx_dim_customer WHERE home_region = {lit(SC.cohort_region)})) AS DOUBLE) AS n_clients,
                           (SELECT AVG(revenue_cents) / 100.0 FROM fx_sales WHERE region_code = {lit(SC.cohort_region)}) AS avg_order_value)""",
          round_cols=("avg_order_value", "expected_revenue"))
def q_m36(spark, sf_dir):
    """Expected revenue of advisor outreach to the ranked clients; how many there are and what an order
    brings decide it, not their order, so no model is fitted."""
    from . import propensity as pr
    fx = Fixture(spark, sf_dir)
    clients = fx.dim_customer.where(F.col("home_region") == SC.cohort_region).select("customer_id").limit(37)
    return pr.outreach_revenue(clients, fx.sales, SC.cohort_region)
