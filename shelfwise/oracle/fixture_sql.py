"""DuckDB twins of the fixture views, as CTEs over the pre-registered test tables.

``with_fixture(body)`` prefixes a query with exactly the CTEs it (transitively)
references. Lookup tables are rendered from the same ``params`` values the
Spark side uses.
"""
from __future__ import annotations

import re

from ..params import (CATEGORY_OF_TYPE, COLOR_FAMILY, DEFAULT, GENDERS, INITIAL_ALLOC_FRACTION, LOYALTY_BANDS,
                      REGION_CLIMATE, RETURN_REASONS, SIZE_LABELS, STORE_TIERS)

SC = DEFAULT
START = f"DATE '{SC.fiscal_start.isoformat()}'"
AS_OF_DATE = f"DATE '{SC.as_of_date.isoformat()}'"
AS_OF = SC.as_of_week
N_WEEKS = SC.n_weeks


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def case(expr: str, mapping: dict, default=None) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {lit(default)} END"


def week_of(d: str, clip_upper: bool = True) -> str:
    w = f"GREATEST(CAST(FLOOR(date_diff('day', {START}, CAST({d} AS DATE)) / 7.0) AS INTEGER) + 1, 1)"
    return f"LEAST({w}, {N_WEEKS})" if clip_upper else w


def money(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(20,4)), 2) AS DECIMAL(18,2))"


def initcap(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


CATEGORY = case("p_type", CATEGORY_OF_TYPE, "Accessories")
_tier = "'Private Client'"
for _bound, _name in reversed(LOYALTY_BANDS):
    _tier = f"CASE WHEN c_acctbal < {_bound!r} THEN {lit(_name)} ELSE {_tier} END"
TIER = _tier

CTES: dict[str, str] = {}

CTES["fx_nation_region"] = """
SELECT n.n_nationkey, n.n_name, n.n_regionkey, r.r_name AS region_code
FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey"""

CTES["fx_dim_region"] = f"""
SELECT r.r_name AS region_code, {initcap('r.r_name')} AS region_name, fn.country,
       {case('r.r_regionkey', {k: v[1] for k, v in REGION_CLIMATE.items()})} AS currency_code,
       {case('r.r_regionkey', {k: v[0] for k, v in REGION_CLIMATE.items()})} AS climate_zone,
       'DC-' || replace(r.r_name, ' ', '') AS primary_dc_id, r.r_regionkey
FROM region r LEFT JOIN (SELECT n_regionkey, MIN(n_name) AS country FROM nation GROUP BY 1) fn
  ON fn.n_regionkey = r.r_regionkey"""

CTES["fx_dim_store"] = f"""
SELECT n.n_name AS store_id, {initcap('n.n_name')} || ' Store' AS store_name, r.region_code, {initcap('n.n_name')} AS city,
       r.climate_zone, {case('n.n_nationkey % 4', dict(enumerate(STORE_TIERS)))} AS store_tier, r.primary_dc_id, r.currency_code
FROM nation n JOIN fx_dim_region r ON r.r_regionkey = n.n_regionkey"""

CTES["fx_dim_week"] = f"""
SELECT week_id, week_start_date, week_start_date + 6 AS week_end_date,
       'FY' || CAST(year(week_start_date) - CASE WHEN month(week_start_date) < 2 THEN 1 ELSE 0 END AS VARCHAR) AS fiscal_year,
       CASE WHEN month(week_start_date) BETWEEN 2 AND 7 THEN 'SS' ELSE 'FW' END AS fiscal_season,
       month(week_start_date) AS fiscal_month,
       (xmas BETWEEN week_start_date AND week_start_date + 6)
         OR (make_date(year(week_start_date), 11, 29) BETWEEN week_start_date AND week_start_date + 6) AS is_holiday_week,
       CAST(date_diff('day', week_start_date, xmas) AS INTEGER) AS days_to_christmas,
       {AS_OF_DATE} BETWEEN week_start_date AND week_start_date + 6 AS is_as_of_week
FROM (SELECT week_id, week_start_date,
             make_date(year(week_start_date) - CASE WHEN month(week_start_date) = 1 THEN 1 ELSE 0 END, 12, 25) AS xmas
      FROM (SELECT CAST(w AS INTEGER) AS week_id, {START} + CAST((w - 1) * 7 AS INTEGER) AS week_start_date
            FROM range(1, {N_WEEKS + 1}) t(w)))"""

CTES["fx_part_sku"] = f"""
SELECT p_partkey, p_brand || '-' || p_type AS style_id,
       p_brand || '-' || p_type || '-' || CAST(p_size % 5 AS VARCHAR) AS sku_id,
       {CATEGORY} AS category,
       CASE WHEN {CATEGORY} = 'Footwear' THEN CAST(38 + p_size % 5 AS VARCHAR)
            ELSE {case('p_size % 5', dict(enumerate(SIZE_LABELS)))} END AS size,
       p_retailprice, p_name
FROM part"""

CTES["fx_style_life"] = """
SELECT style_id, CAST(MIN(l_shipdate) AS DATE) AS launch_date, CAST(MAX(l_shipdate) AS DATE) AS planned_exit_date
FROM fx_sales_base GROUP BY 1"""

_brand_no = "CAST(substr(s.p_brand, 7, 10) AS INTEGER)"
CTES["fx_dim_style"] = f"""
SELECT s.style_id, s.p_brand || ' ' || {initcap('s.p_type')} AS style_name,
       {CATEGORY.replace('p_type', 's.p_type')} AS category,
       split_part(s.min_name, ' ', 2) AS silhouette,
       {case(_brand_no + ' % 3', dict(enumerate(GENDERS)))} AS gender,
       split_part(s.max_name, ' ', 2) AS material,
       CAST(1 + {_brand_no} % 5 AS INTEGER) AS warmth_rating,
       l.launch_date, l.planned_exit_date,
       CAST({money(money('s.min_price') + ' * CAST(0.4 AS DECIMAL(2,1))')} AS DOUBLE) AS base_wholesale_cost,
       s.min_price AS base_retail_price_usd,
       {week_of('l.launch_date')} AS launch_week,
       {week_of('l.planned_exit_date', clip_upper=False)} AS exit_week_uncapped
FROM (SELECT p_brand || '-' || p_type AS style_id, p_brand, p_type, MIN(p_name) AS min_name, MAX(p_name) AS max_name,
             MIN(p_retailprice) AS min_price
      FROM part GROUP BY 1, 2, 3) s
LEFT JOIN fx_style_life l ON l.style_id = s.style_id"""

_color = initcap("split_part(k.min_name, ' ', 1)")
CTES["fx_dim_sku"] = f"""
SELECT k.sku_id, k.style_id, {_color} AS color_name,
       {case(_color, COLOR_FAMILY, 'Neutral')} AS color_family,
       k.size, CASE WHEN regexp_matches(k.size, '^[0-9]+$') THEN 'Numeric' ELSE 'Alpha' END AS size_type,
       k.current_retail_price,
       COALESCE(st.exit_week_uncapped + 6 >= {AS_OF}, FALSE) AS active_flag
FROM (SELECT sku_id, style_id, size, MIN(p_retailprice) AS current_retail_price, MIN(p_name) AS min_name
      FROM fx_part_sku GROUP BY 1, 2, 3) k
LEFT JOIN fx_dim_style st ON st.style_id = k.style_id"""

CTES["fx_dim_customer"] = f"""
SELECT c.c_custkey AS customer_id,
       CASE WHEN c.c_custkey % 2 = 0 THEN 'Store' ELSE 'Ecommerce' END AS acquisition_channel,
       CASE WHEN c.c_mktsegment = {lit(SC.cohort_segment)} THEN {lit(SC.cohort_campaign_id)} END AS acquisition_campaign_id,
       nr.n_name AS home_country, nr.region_code AS home_region,
       {TIER} AS loyalty_tier, ({TIER}) IN ('Platinum', 'Private Client') AS is_vip_flag
FROM customer c JOIN fx_nation_region nr ON nr.n_nationkey = c.c_nationkey"""

CTES["fx_supplier_region"] = """
SELECT s.s_suppkey, nr.n_name, nr.region_code FROM supplier s JOIN fx_nation_region nr ON nr.n_nationkey = s.s_nationkey"""

CTES["fx_sales_base"] = f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_returnflag, l.l_shipdate, ps.p_retailprice,
       CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS order_id,
       CASE WHEN l.l_linestatus = 'F' THEN sr.n_name ELSE 'ECOM-' || sr.region_code END AS location_id,
       CASE WHEN l.l_linestatus = 'F' THEN 'Store' ELSE 'Ecommerce' END AS location_type,
       CASE WHEN l.l_linestatus = 'F' THEN 'Store' ELSE 'Ecommerce' END AS channel,
       sr.region_code, ps.sku_id, ps.style_id, ps.category, ps.size,
       {week_of('l.l_shipdate')} AS week_id,
       CAST(l.l_quantity AS INTEGER) AS units,
       l.l_discount AS markdown_pct,
       (CAST(ROUND(ps.p_retailprice * 100) AS BIGINT) * (100 - CAST(ROUND(l.l_discount * 100) AS BIGINT)) + 50) // 100
         AS unit_price_cents,
       (CAST(ROUND(l.l_extendedprice * 100) AS BIGINT) * (100 - CAST(ROUND(l.l_discount * 100) AS BIGINT)) + 50) // 100
         AS revenue_cents
FROM lineitem l
JOIN fx_part_sku ps ON l.l_partkey = ps.p_partkey
JOIN fx_supplier_region sr ON l.l_suppkey = sr.s_suppkey"""

CTES["fx_sales"] = """
SELECT *, unit_price_cents / 100.0 AS unit_price, revenue_cents / 100.0 AS gross_revenue
FROM fx_sales_base WHERE units > 0"""

CTES["fx_sales_cust"] = """
SELECT s.*, o.o_custkey AS customer_id FROM fx_sales s JOIN orders o ON o.o_orderkey = s.l_orderkey"""

CTES["fx_returns"] = f"""
SELECT 'RET-' || order_id AS return_line_id, l_orderkey, l_linenumber, l_partkey, location_id, location_type,
       region_code, channel, sku_id, style_id, size, category, week_id, l_shipdate + INTERVAL 7 DAY AS return_date, units AS units_returned,
       {case('(l_orderkey + l_linenumber) % 8', dict(enumerate(RETURN_REASONS)))} AS reason_code, revenue_cents
FROM fx_sales WHERE l_returnflag = 'R'"""

CTES["fx_return_reviews"] = """
SELECT r.*, d.text AS review_text FROM fx_returns r LEFT JOIN documents d ON d.doc_id = r.l_partkey"""

CTES["fx_po_lines"] = f"""
SELECT 'PO-' || CAST(li.l_orderkey AS VARCHAR) AS po_id,
       'PO-' || CAST(li.l_orderkey AS VARCHAR) || '-L' || CAST(li.l_linenumber AS VARCHAR) AS po_line_id,
       li.l_suppkey AS supplier_id, 'DC-' || replace(li.region_code, ' ', '') AS dc_id, li.style_id, o.order_date,
       o.order_date + 30 AS original_expected_receipt_date,
       CASE WHEN li.ship_date > o.order_date + 30 THEN li.ship_date ELSE o.order_date + 30 END AS revised_expected_receipt_date,
       CASE WHEN NOT (li.ship_date > o.order_date + 30) AND li.ship_date <= {AS_OF_DATE} THEN li.ship_date END AS actual_receipt_date,
       li.units AS units_ordered,
       CAST({money(money('li.p_retailprice') + ' * CAST(0.4 AS DECIMAL(2,1))')} AS DOUBLE) AS unit_cost,
       li.ship_date > o.order_date + 30 AS is_delayed
FROM (SELECT *, CAST(l_shipdate AS DATE) AS ship_date FROM fx_sales_base) li
JOIN (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders) o ON li.l_orderkey = o.o_orderkey"""

CTES["fx_weather_actual"] = """
SELECT r.region_code, w.week_id, CAST(((w.week_id * 7 + r.r_regionkey * 3) % 11) - 5 AS FLOAT) AS avg_temp_vs_normal_c
FROM fx_dim_region r CROSS JOIN fx_dim_week w"""

# ---------------------------------------------------------------- demand engine
CTES["fx_weekly"] = """
SELECT location_id, location_type, region_code, sku_id, style_id, week_id, SUM(units) AS units, SUM(revenue_cents) AS revenue_cents
FROM fx_sales GROUP BY ALL"""

CTES["fx_assortment"] = f"""
SELECT location_id, location_type, region_code, sku_id, style_id,
       MIN(week_id) AS assortment_start_week, MAX(week_id) AS assortment_end_week, SUM(units) AS total_units,
       starts_with(style_id, {lit(SC.capsule_prefix)}) AS is_core_flag
FROM fx_weekly GROUP BY 1, 2, 3, 4, 5"""

ENGINE_PLAN = f"""            SELECT a.location_id, a.location_type, a.region_code, a.sku_id, a.style_id, a.assortment_start_week, a.assortment_end_week,
                   a.total_units, CAST(a.total_units AS DOUBLE) AS supply_cap,
                   {INITIAL_ALLOC_FRACTION!r} * CAST(a.total_units AS DOUBLE) AS initial_alloc,
                   (CAST(a.total_units AS DOUBLE) - {INITIAL_ALLOC_FRACTION!r} * CAST(a.total_units AS DOUBLE))
                     / GREATEST(a.assortment_end_week - a.assortment_start_week + 1, 1) AS replenish_rate,
                   st.launch_week, 1000000 AS freeze_week
            FROM fx_assortment a LEFT JOIN fx_dim_style st ON st.style_id = a.style_id"""

_ENGINE_TEMPLATE = """
SELECT *, CAST(ROUND(on_hand) AS INTEGER) AS on_hand_units,
       LEAST(COALESCE(on_hand / NULLIF(trailing4, 0), 52.0), 52.0) AS weeks_of_supply,
       cum_demand - realized_cum_sales AS unmet_cum_demand
FROM (
  SELECT *, GREATEST(s_t - realized_cum_sales, 0.0) AS on_hand,
         AVG(realized_sales) OVER (PARTITION BY location_id, sku_id ORDER BY week_id
                                   ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS trailing4
  FROM (
    SELECT *, CAST(ROUND(GREATEST(realized_cum_sales - LAG(realized_cum_sales, 1, 0.0) OVER
                 (PARTITION BY location_id, sku_id ORDER BY week_id), 0.0)) AS INTEGER) AS realized_sales
    FROM (
      SELECT *, LEAST(CAST(cum_demand AS DOUBLE), s_t) AS realized_cum_sales
      FROM (
        SELECT d.*, COALESCE(w.units, 0) AS demand_units, COALESCE(w.revenue_cents, 0) AS revenue_cents,
               LEAST(d.initial_alloc + d.replenish_rate * GREATEST(LEAST(d.week_id, d.freeze_week - 1) - d.launch_week, 0),
                     d.supply_cap) AS s_t,
               SUM(COALESCE(w.units, 0)) OVER (PARTITION BY d.location_id, d.sku_id ORDER BY d.week_id
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_demand
        FROM (
          SELECT p.*, UNNEST(generate_series(p.assortment_start_week, p.assortment_end_week)) AS week_id
          FROM (
{plan}) p
        ) d
        LEFT JOIN fx_weekly w ON w.location_id = d.location_id AND w.sku_id = d.sku_id AND w.week_id = d.week_id
      )
    )
  )
)"""



def engine_sql(plan: str | None = None) -> str:
    """The dense engine as SQL over a supply-plan subquery (default: the fixture plan)."""
    return _ENGINE_TEMPLATE.replace("{plan}", plan or ENGINE_PLAN)


CTES["fx_engine"] = engine_sql()

CTES["fx_inventory"] = """
SELECT location_id, location_type, region_code, sku_id, week_id, on_hand_units, weeks_of_supply
FROM fx_engine"""


def _refs(text: str) -> set[str]:
    return {name for name in CTES if re.search(rf"\b{name}\b", text)}


def with_fixture(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the fixture CTEs it needs (and ``extra`` CTEs, in the given order)."""
    extra = extra or {}
    needed: set[str] = set()
    frontier = _refs(body) | set().union(*[_refs(v) for v in extra.values()]) if extra else _refs(body)
    while frontier:
        name = frontier.pop()
        if name in needed:
            continue
        needed.add(name)
        frontier |= _refs(CTES[name]) - needed
    ordered: list[str] = []

    def place(name: str) -> None:
        """A CTE after those it reads."""
        for other in sorted(_refs(CTES[name]) - {name}):
            if other not in ordered:
                place(other)
        if name not in ordered:
            ordered.append(name)

    for name in CTES:
        if name in needed:
            place(name)
    parts = [f"{n} AS ({CTES[n]}\n)" for n in ordered]
    parts += [f"{n} AS ({sql}\n)" for n, sql in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
