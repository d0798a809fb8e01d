"""Registered catalog, availability and cart queries (C1-C10) with SQL twins."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..oracle.fixture_sql import CTES, lit
from ..params import COMPLEMENTARY_CATEGORIES, SIZE_ORDER
from ..sources.fixture import Fixture
from . import catalog as cat
from .q_analysis import VIRAL_STYLE
from .q_marts import gold
from .registry import register

SEARCH = dict(category="Outerwear", gender="Mens", min_warmth=2, max_price=990.0, color_family="Neutral", keyword="o")

SIZE_RANK_SQL = ("COALESCE(CASE size " + " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in SIZE_ORDER.items())
                 + " END, 100 + TRY_CAST(size AS INTEGER))")

# active SKUs with their style; styles with stock; then one summary per style
CTES["cat_offer"] = """
SELECT y.* EXCLUDE (launch_date, planned_exit_date, launch_week, exit_week_uncapped, base_wholesale_cost), k.color_name,
       k.color_family, k.current_retail_price AS price
FROM fx_dim_style y, (FROM fx_dim_sku WHERE active_flag) k, (SELECT DISTINCT style_id FROM gold_m3 WHERE on_hand_units > 0) stock
WHERE k.style_id = y.style_id AND stock.style_id = y.style_id"""


def _offer_sql(limit: int, *conditions: str) -> str:
    keep = " AND ".join(conditions) or "TRUE"
    return f"""
SELECT style_id, style_name, category, silhouette, material, gender, warmth_rating, min_price, max_price,
       array_to_string(list_sort(palette), ', ') AS colors
FROM (SELECT style_id, style_name, category, silhouette, material, gender, warmth_rating, MIN(price) AS min_price,
             MAX(price) AS max_price, list_distinct(list(color_name)) AS palette
      FROM cat_offer WHERE {keep} GROUP BY ALL)
ORDER BY warmth_rating DESC, min_price, style_id LIMIT {limit}"""


_facets = [f"category = {lit(SEARCH['category'])}", f"gender IN ({lit(SEARCH['gender'])}, 'Unisex')", f"warmth_rating >= {SEARCH['min_warmth']}",
           f"price <= {SEARCH['max_price']!r}", f"color_family = {lit(SEARCH['color_family'])}",
           f"contains(lower(concat_ws(chr(10), silhouette, material, style_name)), {lit(SEARCH['keyword'].lower())})"]


def _fx(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return fx, gold(fx)["m3"]


@register("c1_search_products", _offer_sql(5, *_facets))
def q_c1(spark, sf_dir):
    """Catalog search with every optional filter given."""
    fx, sig = _fx(spark, sf_dir)
    return cat.search_products(fx.dim_sku, fx.dim_style, sig, **SEARCH)


@register("c10_storefront", _offer_sql(24))
def q_c10(spark, sf_dir):
    """Storefront listing, 24 styles, no facets."""
    fx, sig = _fx(spark, sf_dir)
    return cat.storefront(fx.dim_sku, fx.dim_style, sig)


CTES["cat_variants"] = f"""
SELECT v.*, ROW_NUMBER() OVER (PARTITION BY v.style_id ORDER BY v.color_name, {SIZE_RANK_SQL.replace('size', 'v.size')} NULLS LAST,
                                 v.sku_id) AS variant_no
FROM (SELECT k.sku_id, k.style_id, k.color_name, k.size, k.current_retail_price,
             CAST(COALESCE(oh.oh, 0) AS BIGINT) AS on_hand_units
      FROM fx_dim_sku k LEFT JOIN (SELECT sku_id, SUM(on_hand_units) AS oh FROM gold_m3 GROUP BY 1) oh
        ON oh.sku_id = k.sku_id
      WHERE k.active_flag) v"""


@register("c2_style_variants",
          """SELECT v.*, sty.style_name, sty.category, sty.silhouette, sty.material, sty.gender, sty.warmth_rating
             FROM cat_variants v JOIN fx_dim_style sty ON sty.style_id = v.style_id""")
def q_c2(spark, sf_dir):
    """Variants per style with on-hand, business size order (batch over all styles; O5, P14)."""
    fx, sig = _fx(spark, sf_dir)
    return cat.style_variants(fx.dim_sku, fx.dim_style, sig)


@register("c3_availability",
          """SELECT k.sku_id, CAST(NULL AS VARCHAR) AS region_code, CAST(COALESCE(a.t, 0) AS BIGINT) AS total_on_hand,
                    COALESCE(a.n, 0) AS n_locations, COALESCE(a.t, 0) > 0 AS in_stock
             FROM fx_dim_sku k LEFT JOIN (SELECT sku_id, SUM(on_hand_units) AS t, COUNT(DISTINCT location_id) AS n
                                          FROM gold_m3 GROUP BY 1) a ON a.sku_id = k.sku_id""")
def q_c3(spark, sf_dir):
    """Availability of every SKU across the network, zero rows kept."""
    fx, sig = _fx(spark, sf_dir)
    return cat.availability(fx.dim_sku, sig)


@register("c3_availability_by_region",
          """SELECT sku_id, region_code, CAST(SUM(on_hand_units) AS BIGINT) AS total_on_hand,
                    COUNT(DISTINCT location_id) AS n_locations, SUM(on_hand_units) > 0 AS in_stock
             FROM gold_m3 GROUP BY 1, 2""")
def q_c3r(spark, sf_dir):
    """Availability per SKU × region."""
    _, sig = _fx(spark, sf_dir)
    return cat.availability_by_region(sig)


_pairs = ", ".join(f"({lit(k)}, {lit(v)})" for k, vs in COMPLEMENTARY_CATEGORIES.items() for v in vs)


@register("c4_complementary_items",
          f"""SELECT style_id, style_name, category, silhouette, low AS min_price, array_to_string(list_sort(palette), ', ') AS colors
              FROM (SELECT o.style_id, o.style_name, o.category, o.silhouette, wanted.target, MIN(o.price) AS low,
                           list_distinct(list(o.color_name)) AS palette
                    FROM cat_offer o, (SELECT gender, base_retail_price_usd AS target, paired
                                       FROM fx_dim_style, (VALUES {_pairs}) p(own, paired)
                                       WHERE style_id = {lit(VIRAL_STYLE)} AND category = own) wanted
                    WHERE o.category = wanted.paired AND o.gender IN (wanted.gender, 'Unisex') GROUP BY ALL)
              ORDER BY ABS(low - target), style_id LIMIT 2""")
def q_c4(spark, sf_dir):
    """C4: complementary items for one style, nearest in minimum price."""
    fx, sig = _fx(spark, sf_dir)
    return cat.complementary_items(fx.dim_sku, fx.dim_style, sig, VIRAL_STYLE)


@register("c9_default_colour_sizes",
          """SELECT v.style_id, v.color_name, v.size, v.sku_id, v.variant_no FROM cat_variants v
             JOIN (SELECT style_id, MIN(color_name) AS color_name FROM cat_variants GROUP BY 1) f
               ON f.style_id = v.style_id AND f.color_name = v.color_name""")
def q_c9(spark, sf_dir):
    """Default colour of each style and its sizes."""
    fx, sig = _fx(spark, sf_dir)
    return cat.colour_and_sizes(cat.style_variants(fx.dim_sku, fx.dim_style, sig))


# ------------------------------------------------------------------ carts from the event log
CTES["cart_events"] = """
SELECT e.cart_id, e.event_id, e.ts, e.action, n.sku_id, e.quantity
FROM (SELECT user_id AS cart_id, event_id, CAST(ts AS TIMESTAMP) AS ts,
             CASE WHEN event_type = 'purchase' THEN 'add' ELSE 'remove' END AS action,
             TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(1 + event_id % 3 AS INTEGER) AS quantity
      FROM events WHERE event_type IN ('purchase', 'error')) e
JOIN (SELECT sku_id, ROW_NUMBER() OVER (ORDER BY sku_id) - 1 AS sku_no FROM fx_dim_sku) n
  ON n.sku_no = ((e.k % (SELECT COUNT(*) FROM fx_dim_sku)) + (SELECT COUNT(*) FROM fx_dim_sku)) % (SELECT COUNT(*) FROM fx_dim_sku)
WHERE e.k IS NOT NULL"""

CTES["cart_lines"] = """
SELECT cart_id, event_id, ts, sku_id, quantity FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY cart_id, sku_id, action ORDER BY event_id) AS n FROM cart_events) a
WHERE action = 'add' AND NOT EXISTS (
  SELECT 1 FROM (SELECT cart_id, sku_id, ROW_NUMBER() OVER (PARTITION BY cart_id, sku_id ORDER BY event_id) AS n
                 FROM cart_events WHERE action = 'remove') r
  WHERE r.cart_id = a.cart_id AND r.sku_id = a.sku_id AND r.n = a.n)"""

CTES["cart_priced"] = f"""
SELECT l.cart_id, l.event_id, l.sku_id, k.style_id, sty.style_name, k.color_name, k.size, k.current_retail_price,
       l.quantity,
       CAST(ROUND(CAST(CAST(ROUND(CAST(k.current_retail_price AS DECIMAL(20,4)), 2) AS DECIMAL(18,2)) * l.quantity
                       AS DECIMAL(20,4)), 2) AS DECIMAL(18,2)) AS line_total,
       CASE WHEN COALESCE(a.t, 0) < l.quantity
            THEN 'Only ' || CAST(CAST(COALESCE(a.t, 0) AS BIGINT) AS VARCHAR) || ' units currently on hand across the network.'
       END AS warning
FROM cart_lines l JOIN fx_dim_sku k ON k.sku_id = l.sku_id JOIN fx_dim_style sty ON sty.style_id = k.style_id
LEFT JOIN (SELECT sku_id, SUM(on_hand_units) AS t FROM gold_m3 GROUP BY 1) a ON a.sku_id = l.sku_id"""


def _carts(spark, sf_dir):
    fx, sig = _fx(spark, sf_dir)
    lines = cat.cart_lines(cat.cart_events(fx.table("events"), fx.dim_sku))
    return cat.price_lines(lines, fx.dim_sku, fx.dim_style, cat.availability(fx.dim_sku, sig))


@register("c5_priced_cart_lines",
          "SELECT * REPLACE (CAST(line_total AS DOUBLE) AS line_total) FROM cart_priced")
def q_c5(spark, sf_dir):
    """C5 + C8: event-sourced cart lines (removes cancel the first matching add), priced, with stock warnings."""
    return _carts(spark, sf_dir).withColumn("line_total", F.col("line_total").cast("double"))


@register("c7_cart_totals",
          """SELECT cart_id, n_items, n_units, CAST(subtotal AS DOUBLE) AS subtotal, CAST(tax AS DOUBLE) AS tax,
                    CAST(subtotal + tax AS DOUBLE) AS total
             FROM (SELECT cart_id, COUNT(*) AS n_items, CAST(SUM(quantity) AS BIGINT) AS n_units,
                          SUM(line_total) AS subtotal,
                          CAST(ROUND(CAST(SUM(line_total) * CAST(0.08 AS DECIMAL(4,2)) AS DECIMAL(20,4)), 2)
                               AS DECIMAL(18,2)) AS tax
                   FROM cart_priced GROUP BY 1)""")
def q_c7(spark, sf_dir):
    """C6 + C7: cart subtotal, 8 % tax and total per cart."""
    return cat.cart_totals(_carts(spark, sf_dir))


@register("f16_style_hero_colour")
def q_f16(spark, sf_dir):
    """A5 + F16: every style's colours (sorted, distinct, ', '-joined) and the colour that represents it in
    the storefront grid, picked by CRC32 of the style id (stable per style, spread across the palette).
    Rows-only: the SQL engine of the check has no CRC32; tested against zlib on a small fixture."""
    skus = Fixture(spark, sf_dir).dim_sku
    colours = skus.groupBy("style_id").agg(
        F.array_join(F.array_sort(F.collect_set("color_name")), ", ").alias("colors"))
    return colours.select("style_id", "colors", cat.pick_colour(F.col("colors"), F.col("style_id")).alias("hero_colour"))


@register("s12_order_documents",
          """SELECT cart_id, 'ORD-' || upper(substr(sha256(CAST(cart_id AS VARCHAR)), 1, 8)) AS order_id, COUNT(*) AS n_items,
                    CAST(SUM(quantity) AS BIGINT) AS n_units, CAST(SUM(line_total) AS DOUBLE) AS subtotal
             FROM cart_priced GROUP BY 1""", round_cols=("subtotal",))
def q_s12(spark, sf_dir):
    """S12 + A21 + F26: one nested order document per cart; its figures read back from the JSON."""
    priced = _carts(spark, sf_dir)
    docs = cat.order_documents(priced, cat.cart_totals(priced))
    read = F.from_json("document", "order_id string, items array<struct<quantity: int, line_total: double>>, subtotal double")
    return docs.withColumn("doc", read).select(
        "cart_id", "doc.order_id", F.size("doc.items").cast("long").alias("n_items"),
        F.aggregate("doc.items", F.lit(0).cast("long"), lambda a, x: a + x["quantity"]).alias("n_units"), "doc.subtotal")
