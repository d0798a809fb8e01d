"""Catalog, availability and cart/order queries.

The reference answers these one request at a time for a chat tool; here they
are DataFrame functions. Per-style detail and availability run as batches
over the whole catalog (group-bys, no pairs); the complementary-item search
keeps the reference's one-base-style form, which is a 1 × candidates join.
Cart operations are re-aimed at a table of cart events derived from the
``events`` table (event-sourced cart: adds, removes, checkouts).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import all_of, money, size_rank
from ..operators.numbering import number_rows
from ..params import COMPLEMENTARY_CATEGORIES, TAX_RATE


def in_stock_styles(signals: DataFrame) -> DataFrame:
    """Styles with on-hand anywhere (the EXISTS of the reference, as a semi-join key set)."""
    return signals.where(F.col("on_hand_units") > 0).select("style_id").distinct()


def search_products(dim_sku: DataFrame, dim_style: DataFrame, signals: DataFrame, category: str | None = None,
                    gender: str | None = None, min_warmth: int | None = None, max_price: float | None = None,
                    color_family: str | None = None, keyword: str | None = None, in_stock_only: bool = True,
                    limit: int | None = 5) -> DataFrame:
    """Optional filters on SKUs and styles, then price range and colours of the matching SKUs.

    Filters apply to SKUs before the aggregate, so min/max price and colours
    cover matching SKUs only; in-stock is by style over any location (J9).
    """
    sty = dim_style.select("style_id", "style_name", "category", "silhouette", "material", "gender", "warmth_rating")
    j = dim_sku.select("sku_id", "style_id", "color_name", "color_family", "current_retail_price", "active_flag").join(sty, "style_id")
    kw = None
    if keyword:
        pat = f"%{keyword}%"
        kw = F.col("silhouette").ilike(pat) | F.col("material").ilike(pat) | F.col("style_name").ilike(pat)
    pred = all_of([
        F.col("active_flag"),
        F.col("category") == category if category else None,
        ((F.col("gender") == gender) | (F.col("gender") == "Unisex")) if gender else None,
        F.col("warmth_rating") >= min_warmth if min_warmth is not None else None,
        F.col("current_retail_price") <= max_price if max_price is not None else None,
        F.col("color_family") == color_family if color_family else None,
        kw,
    ])
    j = j.where(pred)
    if in_stock_only:
        j = j.join(in_stock_styles(signals), "style_id", "left_semi")
    g = (j.groupBy("style_id", "style_name", "category", "silhouette", "material", "gender", "warmth_rating")
         .agg(F.min("current_retail_price").alias("min_price"), F.max("current_retail_price").alias("max_price"),
              F.array_join(F.array_sort(F.collect_set("color_name")), ", ").alias("colors")))
    g = g.orderBy(F.col("warmth_rating").desc(), F.col("min_price").asc(), F.col("style_id"))
    return g.limit(limit) if limit else g


def variant_on_hand(dim_sku: DataFrame, signals: DataFrame) -> DataFrame:
    """Active SKUs with their on-hand summed over the signals, 0 when none."""
    oh = signals.groupBy("sku_id").agg(F.sum("on_hand_units").alias("oh"))
    return (dim_sku.where(F.col("active_flag")).join(oh, "sku_id", "left")
            .select("sku_id", "style_id", "color_name", "size", "current_retail_price",
                    F.coalesce(F.col("oh"), F.lit(0)).cast("long").alias("on_hand_units")))


def style_variants(dim_sku: DataFrame, dim_style: DataFrame, signals: DataFrame) -> DataFrame:
    """C2 flat: one row per active variant, numbered in colour then business-size order."""
    v = variant_on_hand(dim_sku, signals)
    w = Window.partitionBy("style_id").orderBy("color_name", size_rank("size").asc_nulls_last(), "sku_id")
    sty = dim_style.select("style_id", "style_name", "category", "silhouette", "material", "gender", "warmth_rating")
    return v.withColumn("variant_no", F.row_number().over(w)).join(sty, "style_id")


def style_details(dim_sku: DataFrame, dim_style: DataFrame, signals: DataFrame) -> DataFrame:
    """C2 nested: one row per style with an ordered array of variant structs.

    A style's variants are its colours × sizes, a catalog-bounded group.
    """
    v = style_variants(dim_sku, dim_style, signals)
    item = F.struct("variant_no", "sku_id", "color_name", "size", "current_retail_price", "on_hand_units")
    g = v.groupBy("style_id", "style_name", "category", "silhouette", "material", "gender", "warmth_rating") \
         .agg(F.array_sort(F.collect_list(item)).alias("variants"))
    return g.withColumn("variants", F.transform("variants", lambda x: x.dropFields("variant_no")))


def availability(dim_sku: DataFrame, signals: DataFrame) -> DataFrame:
    """C3 batch, network-wide: every SKU with total on-hand, distinct locations and in-stock flag (zero row if none)."""
    a = signals.groupBy("sku_id").agg(F.sum("on_hand_units").alias("t"), F.countDistinct("location_id").alias("n"))
    total = F.coalesce(F.col("t"), F.lit(0)).cast("long")
    return dim_sku.select("sku_id").join(a, "sku_id", "left").select(
        "sku_id", F.lit(None).cast("string").alias("region_code"), total.alias("total_on_hand"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n_locations"), (total > 0).alias("in_stock"))


def availability_by_region(signals: DataFrame) -> DataFrame:
    """C3 batch, region-scoped: one row per (sku, region) present in the signals."""
    a = signals.groupBy("sku_id", "region_code").agg(F.sum("on_hand_units").cast("long").alias("total_on_hand"),
                                                     F.countDistinct("location_id").alias("n_locations"))
    return a.withColumn("in_stock", F.col("total_on_hand") > 0)


def complementary_items(dim_sku: DataFrame, dim_style: DataFrame, signals: DataFrame, style_id: str,
                        limit: int = 2) -> DataFrame:
    """C4: styles in the paired categories, same gender or unisex, active, in stock, nearest in minimum price.

    One base style against the candidate catalog (1 × candidates), as in the
    reference; the pairing map is a literal map column.
    """
    pairs = F.create_map(*[x for k, v in COMPLEMENTARY_CATEGORIES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    base = dim_style.where(F.col("style_id") == style_id).select(
        F.explode(F.coalesce(pairs[F.col("category")], F.array().cast("array<string>"))).alias("category"),
        F.col("gender").alias("base_gender"), F.col("base_retail_price_usd").alias("base_price"))
    sty = dim_style.select("style_id", "style_name", "category", "silhouette", "gender")
    cand = (sty.join(F.broadcast(base), "category")
            .where((F.col("gender") == F.col("base_gender")) | (F.col("gender") == "Unisex")))
    cand = cand.join(in_stock_styles(signals), "style_id", "left_semi")
    skus = dim_sku.where(F.col("active_flag")).select("style_id", "current_retail_price", "color_name")
    g = (cand.join(skus, "style_id")
         .groupBy("style_id", "style_name", "category", "silhouette", "base_price")
         .agg(F.min("current_retail_price").alias("min_price"),
              F.array_join(F.array_sort(F.collect_set("color_name")), ", ").alias("colors")))
    return (g.orderBy(F.abs(F.col("min_price") - F.col("base_price")), F.col("style_id")).limit(limit)
            .drop("base_price"))


def storefront(dim_sku, dim_style, signals, **facets) -> DataFrame:
    """The storefront grid (24 styles, optional facets)."""
    return search_products(dim_sku, dim_style, signals, limit=24, **facets)


def colour_and_sizes(variants: DataFrame) -> DataFrame:
    """Per style, the default (first) colour and its sizes in business order."""
    first = variants.groupBy("style_id").agg(F.min("color_name").alias("color_name"))
    return (variants.join(first, ["style_id", "color_name"])
            .select("style_id", "color_name", "size", "sku_id", "variant_no"))


def pick_colour(colors: Column, key: Column) -> Column:
    """F16: deterministic colour pick from a ', '-joined list by a CRC32 hash of a key."""
    arr = F.split(colors, ", ")
    return F.element_at(arr, (F.pmod(F.crc32(key.cast("string")), F.size(arr).cast("long")) + 1).cast("int"))


# ------------------------------------------------------------------ event-sourced carts
def numbered_skus(dim_sku: DataFrame) -> DataFrame:
    """SKUs numbered 0..n-1 by sku_id, over range partitions."""
    return number_rows(dim_sku.select("sku_id"), [F.col("sku_id")]).select("sku_id", (F.col("n") - 1).alias("sku_no"))


def cart_events(events: DataFrame, dim_sku: DataFrame) -> DataFrame:
    """Cart events from the raw event log: 'purchase' = add, 'error' = remove; the SKU is the
    JSON property k modulo the catalog size (F26: malformed JSON -> no SKU, row dropped)."""
    k = F.get_json_object(F.col("props"), "$.k").cast("long")
    e = events.where(F.col("event_type").isin("purchase", "error")).select(
        F.col("user_id").alias("cart_id"), "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "purchase", F.lit("add")).otherwise(F.lit("remove")).alias("action"),
        k.alias("k"), (F.lit(1) + F.col("event_id") % 3).cast("int").alias("quantity"))
    n = numbered_skus(dim_sku)
    n_skus = dim_sku.select(F.count(F.lit(1))).scalar()  # uncorrelated scalar subquery (J8)
    e = e.where(F.col("k").isNotNull())
    return (e.withColumn("sku_no", F.pmod(F.col("k"), n_skus))
            .join(n, "sku_no")
            .select("cart_id", "event_id", "ts", "action", "sku_id", "quantity"))


def cart_lines(cart_ev: DataFrame) -> DataFrame:
    """The n-th remove of a SKU cancels the n-th add of that SKU in the cart (first match first)."""
    w = Window.partitionBy("cart_id", "sku_id", "action").orderBy("event_id")
    e = cart_ev.withColumn("n", F.row_number().over(w))
    adds = e.where(F.col("action") == "add")
    removes = e.where(F.col("action") == "remove").select("cart_id", "sku_id", "n")
    return adds.join(removes, ["cart_id", "sku_id", "n"], "left_anti").drop("n", "action")


def add_event(cart_ev: DataFrame, cart_id: int, sku_id: str, quantity: int) -> DataFrame:
    """The cart log with one more 'add' of ``quantity`` units, after all events so far."""
    last = cart_ev.agg(F.coalesce(F.max("event_id"), F.lit(0)).alias("last"))
    added = last.select(F.lit(cart_id).cast("long").alias("cart_id"), (F.col("last") + 1).alias("event_id"), F.current_timestamp().alias("ts"),
                        F.lit("add").alias("action"), F.lit(sku_id).alias("sku_id"), F.lit(quantity).cast("int").alias("quantity"))
    return cart_ev.unionByName(added)


def price_lines(lines: DataFrame, dim_sku: DataFrame, dim_style: DataFrame, avail: DataFrame) -> DataFrame:
    """Price each cart line (line_total = round(price × qty, 2)) and warn when qty exceeds network on-hand."""
    sku = dim_sku.select("sku_id", "style_id", "color_name", "size", "current_retail_price")
    sty = dim_style.select("style_id", "style_name")
    a = avail.select("sku_id", "total_on_hand")
    j = lines.join(sku, "sku_id").join(sty, "style_id").join(a, "sku_id", "left")
    oh = F.coalesce(F.col("total_on_hand"), F.lit(0))
    return j.select("cart_id", "event_id", "sku_id", "style_id", "style_name", "color_name", "size",
                    "current_retail_price", "quantity",
                    money(money("current_retail_price") * F.col("quantity")).alias("line_total"),
                    F.when(oh < F.col("quantity"),
                           F.concat(F.lit("Only "), oh.cast("string"), F.lit(" units currently on hand across the network.")))
                    .alias("warning"))


def cart_totals(priced: DataFrame, tax_rate: float = TAX_RATE) -> DataFrame:
    """C6 + C7: per cart item count, subtotal, tax (rounded to cents) and total."""
    g = priced.groupBy("cart_id").agg(F.count(F.lit(1)).alias("n_items"), F.sum("quantity").alias("n_units"),
                                      F.sum("line_total").alias("subtotal_dec"))
    tax = money(F.col("subtotal_dec") * F.lit(tax_rate).cast("decimal(4,2)"))
    return g.select("cart_id", "n_items", "n_units", F.col("subtotal_dec").cast("double").alias("subtotal"),
                    tax.cast("double").alias("tax"), (F.col("subtotal_dec") + tax).cast("double").alias("total"))


def order_documents(priced: DataFrame, totals: DataFrame) -> DataFrame:
    """S12 + F26: one nested JSON document per checkout: its items in event order, subtotal, tax and total.

    A document holds the whole order of one cart, so its items are gathered per cart (partially aggregated
    before the shuffle); the document itself is what bounds that group.
    """
    item = F.struct("event_id", "sku_id", "style_name", "color_name", "size", "current_retail_price", "quantity",
                    F.col("line_total").cast("double").alias("line_total"))
    items = priced.groupBy("cart_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    j = items.join(totals.select("cart_id", "subtotal", "tax", "total"), "cart_id")
    order_id = F.concat(F.lit("ORD-"), F.upper(F.substring(F.sha2(F.col("cart_id").cast("string"), 256), 1, 8)))
    return j.select("cart_id", order_id.alias("order_id"), F.size("items").cast("long").alias("n_items"),
                    F.to_json(F.struct(order_id.alias("order_id"), "items", "subtotal", "tax", "total")).alias("document"))


def write_orders(docs: DataFrame, path: str) -> None:
    """Append the order documents as JSON lines."""
    docs.select("document").write.mode("append").text(path)
