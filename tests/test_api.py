"""X1 function surface, F16 colour pick, W6 cumulative product and E24 conversion."""
import json
import math

from pyspark.sql import functions as F

from shelfwise.operators import fx as fxo
from shelfwise.plans import api, catalog as cat
from shelfwise.sources.fixture import Fixture

from conftest import SF_SMALL


def test_function_surface(spark):
    t = api.Tables.from_fixture(Fixture(spark, SF_SMALL))
    found = api.search_products(t, category="Outerwear", limit=3).collect()
    assert 0 < len(found) <= 3
    style = found[0].style_id
    d = api.get_style_details(t, style).collect()
    assert len(d) == 1 and d[0].variants
    sku = d[0].variants[0].sku_id
    a = api.check_availability(t, sku).collect()[0]
    assert a.sku_id == sku and a.in_stock == (a.total_on_hand > 0)
    none = api.check_availability(t, "no-such-sku").collect()[0]
    assert none.total_on_hand == 0 and none.n_locations == 0 and not none.in_stock
    assert api.get_style_details(t, "no-such-style").count() == 0
    assert api.get_complementary_items(t, style).count() <= 2
    cart = t.cart_events.select("cart_id").first().cart_id
    lines = api.cart_contents(t, cart).count()
    more = api.add_to_cart(t, cart, sku, 3)
    v = api.view_cart(more, cart).collect()[0]
    assert v.n_items == lines + 1 and api.cart_contents(t, cart).count() == lines
    assert api.cart_contents(more, cart).where(F.col("sku_id") == sku).agg(F.max("quantity")).first()[0] == 3
    t = more
    doc = json.loads(api.checkout(t, cart).first().document)
    assert math.isclose(doc["total"], round(doc["subtotal"] + doc["tax"], 2), abs_tol=1e-9)


def test_pick_colour_is_stable(spark):
    df = spark.createDataFrame([("a, b, c", 1), ("a, b, c", 1), ("x", 7)], "colors string, k long")
    got = [r.c for r in df.select(cat.pick_colour(F.col("colors"), F.col("k")).alias("c")).collect()]
    assert got[0] == got[1] and got[0] in {"a", "b", "c"} and got[2] == "x"


def test_cumulative_product_rates_and_conversion(spark):
    changes = spark.createDataFrame([("EUR", w, c) for w, c in [(1, 0.0), (2, 0.1), (3, -0.5)]],
                                    "currency_code string, week_id int, change double")
    base = spark.createDataFrame([("EUR", 2.0)], "currency_code string, base_rate double")
    rates = {r.week_id: r.rate_to_usd for r in fxo.rates_from_changes(changes, base).collect()}
    assert math.isclose(rates[1], 2.0) and math.isclose(rates[2], 2.2) and math.isclose(rates[3], 1.1)
    sales = spark.createDataFrame([("EUR", 2, 10.0), ("JPY", 2, 5.0)], "currency_code string, week_id int, amount double")
    out = {r.currency_code: r.amount_usd for r in fxo.to_usd(sales, "amount", fxo.rates_from_changes(changes, base)).collect()}
    assert math.isclose(out["EUR"], 22.0) and out["JPY"] is None


def test_rate_walk_clips_to_band_and_keeps_base_currency_flat(spark):
    weeks = spark.range(1, 201).select(F.col("id").cast("int").alias("week_id"))
    # a constant +5 % weekly shock must hit the +15 % ceiling after three weeks and stay there
    rates = fxo.rate_walk(weeks, {"USD": 1.0, "EUR": 2.0}, 0.15, shock=lambda w, c: F.lit(0.05))
    got = {(r.currency_code, r.week_id): r.rate_to_usd for r in rates.collect()}
    assert len(got) == 400
    assert all(got[("USD", w)] == 1.0 for w in range(1, 201))
    assert math.isclose(got[("EUR", 1)], 2.0 * 1.05) and math.isclose(got[("EUR", 2)], 2.0 * 1.05 ** 2)
    assert math.isclose(got[("EUR", 3)], 2.3) and math.isclose(got[("EUR", 200)], 2.3)
    # the fixture shock stays within ±4 per mille
    s = weeks.select(fxo.weekly_shock(F.col("week_id"), F.lit(3)).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert s[0] == -0.004 and s[1] == 0.004


def test_hero_colour_query_matches_crc32_pick(spark):
    import zlib
    from shelfwise.plans import all_queries
    q, o = all_queries()
    assert "f16_style_hero_colour" not in o
    rows = q["f16_style_hero_colour"](spark, SF_SMALL).collect()
    assert len(rows) == Fixture(spark, SF_SMALL).dim_style.count()
    for r in rows:
        options = [c for c in r.colors.split(", ") if c]
        assert options == sorted(set(options))
        assert r.hero_colour == options[zlib.crc32(r.style_id.encode()) % len(options)]
