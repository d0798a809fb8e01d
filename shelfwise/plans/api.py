"""The catalog function surface: seven plain functions over a table set.

Each takes a ``Tables`` (the retail views: dim_sku, dim_style, signals, and the
cart event log) plus typed parameters and returns a DataFrame; nothing is
collected. These are the operations a shopping assistant calls: search,
style details, availability, complementary items, add to cart (price a line),
view cart and checkout.
"""
from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import catalog as cat


@dataclass
class Tables:
    dim_sku: DataFrame
    dim_style: DataFrame
    signals: DataFrame          # inventory imbalance signals (on-hand per location × SKU)
    cart_events: DataFrame | None = None

    @classmethod
    def from_fixture(cls, fx) -> "Tables":
        from .q_marts import gold
        return cls(fx.dim_sku, fx.dim_style, gold(fx)["m3"], cat.cart_events(fx.table("events"), fx.dim_sku))


def search_products(t: Tables, category: str | None = None, gender: str | None = None,
                    min_warmth: int | None = None, max_price: float | None = None, color_family: str | None = None,
                    keyword: str | None = None, in_stock_only: bool = True, limit: int = 5) -> DataFrame:
    """Styles matching the filters, warmest then cheapest, with price range and colours."""
    return cat.search_products(t.dim_sku, t.dim_style, t.signals, category, gender, min_warmth, max_price,
                               color_family, keyword, in_stock_only, limit)


def get_style_details(t: Tables, style_id: str) -> DataFrame:
    """One style with its active variants (colour, size, price, on-hand) as a nested array; empty if unknown."""
    return cat.style_details(t.dim_sku.where(F.col("style_id") == style_id),
                             t.dim_style.where(F.col("style_id") == style_id), t.signals)


def check_availability(t: Tables, sku_id: str, region_code: str | None = None) -> DataFrame:
    """Total on-hand and distinct locations for one SKU (optionally one region); a zero row when none."""
    s = t.signals.where(F.col("sku_id") == sku_id)
    if region_code:
        s = s.where(F.col("region_code") == region_code)
    agg = s.agg(F.coalesce(F.sum("on_hand_units"), F.lit(0)).cast("long").alias("total_on_hand"),
                F.countDistinct("location_id").alias("n_locations"))
    return agg.select(F.lit(sku_id).alias("sku_id"), F.lit(region_code).cast("string").alias("region_code"),
                      "total_on_hand", "n_locations", (F.col("total_on_hand") > 0).alias("in_stock"))


def get_complementary_items(t: Tables, style_id: str, limit: int = 2) -> DataFrame:
    """Paired-category styles of the same gender (or unisex), in stock, nearest in price."""
    return cat.complementary_items(t.dim_sku, t.dim_style, t.signals, style_id, limit)


def add_to_cart(t: Tables, cart_id: int, sku_id: str, quantity: int = 1) -> Tables:
    """The tables with ``quantity`` units of a SKU added to a cart; see ``cart_contents`` for its priced lines.

    An unknown SKU gives a line that no catalog row prices, so it does not appear; quantities below 1 are refused.
    """
    if quantity < 1:
        raise ValueError("quantity must be at least 1")
    return replace(t, cart_events=cat.add_event(t.cart_events, cart_id, sku_id, quantity))


def cart_contents(t: Tables, cart_id: int) -> DataFrame:
    """Priced lines of one cart (removes cancel earlier adds), with a warning when quantity exceeds stock."""
    lines = cat.cart_lines(t.cart_events.where(F.col("cart_id") == cart_id))
    return cat.price_lines(lines, t.dim_sku, t.dim_style, cat.availability(t.dim_sku, t.signals))


def view_cart(t: Tables, cart_id: int) -> DataFrame:
    """Item count, units and subtotal of one cart."""
    return cat.cart_totals(cart_contents(t, cart_id)).select("cart_id", "n_items", "n_units", "subtotal")


def checkout(t: Tables, cart_id: int) -> DataFrame:
    """Subtotal, 8 % tax and total of one cart, as one JSON order document."""
    priced = cart_contents(t, cart_id)
    return cat.order_documents(priced, cat.cart_totals(priced))
