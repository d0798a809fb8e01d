"""Retail star schema derived from the TPC-H-shaped test tables.

The mapping (FIXTURES.md §3) turns ``region``/``nation`` into regions and
locations, ``part`` into styles and SKUs, ``lineitem`` into sales and return
lines, ``customer`` into loyalty customers, and ``lineitem ⨝ orders`` into
purchase-order lines. Every view is a lazy DataFrame; Catalyst prunes the
columns a query does not use down to the parquet scan.

Each view here has a twin DuckDB CTE in ``shelfwise.oracle.fixture_sql``.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.expr import case_map, initcap_word, money, whole
from ..operators.broadcast import bounded_broadcast, checked_broadcast
from ..params import (CATEGORY_OF_TYPE, COLOR_FAMILY, DEFAULT, GENDERS, LOYALTY_BANDS, REGION_CLIMATE,
                      RETURN_REASONS, SIZE_LABELS, STORE_TIERS, Scenario)
from .staging import once, source_files
from .tables import read_table


def cents_half_up(hundredths_of_cents: Column) -> Column:
    """Round a non-negative amount in 1/100 cent to whole cents, half up (integer arithmetic)."""
    return F.floor((hundredths_of_cents + 50) / 100).cast("long")


def category_of(p_type: Column) -> Column:
    return case_map(p_type, CATEGORY_OF_TYPE, "Accessories")


def size_label(category: Column, size_code: Column) -> Column:
    alpha = case_map(size_code, dict(enumerate(SIZE_LABELS)), None)
    return F.when(category == "Footwear", (F.lit(38) + size_code).cast("string")).otherwise(alpha)


def sku_code(style_id: Column, size_code: Column) -> Column:
    return F.concat(style_id, F.lit("-"), size_code.cast("string"))


# Fixture scenario keys (which style plays the viral product, and when it spikes).
VIRAL_STYLE = "Brand#12-LARGE"
VIRAL_TRIGGER_WEEK = DEFAULT.as_of_week - 10


class Fixture:
    """Lazy views of the retail schema over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, sc: Scenario = DEFAULT):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.sc = sc
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    @cached_property
    def _files(self) -> tuple:
        return source_files(self.spark, self.sf_dir, ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"])

    def once(self, name: str, build, bucket_by: list[str] | None = None, sort_by: list[str] | None = None) -> DataFrame:
        """A derived table, written to the shared folder on first use and read back."""
        return once(self.spark, (self.sf_dir, repr(self.sc), self._files[0]), name, build, bucket_by, sort_by)

    def bytes_of(self, table: str) -> int:
        return self._files[1].get(table, 1 << 62)

    # ------------------------------------------------------------------ geography
    @cached_property
    def nation_region(self) -> DataFrame:
        """nation ⨝ region: 25 rows by the TPC-H definition."""
        n = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.table("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region_code"))
        return bounded_broadcast(n.join(F.broadcast(r), "n_regionkey"))

    @cached_property
    def dim_region(self) -> DataFrame:
        r = self.table("region")
        first_nation = (self.table("nation").groupBy("n_regionkey")
                        .agg(F.min("n_name").alias("country"))
                        .withColumnRenamed("n_regionkey", "r_regionkey"))
        climate = case_map(F.col("r_regionkey"), {k: v[0] for k, v in REGION_CLIMATE.items()}, None)
        currency = case_map(F.col("r_regionkey"), {k: v[1] for k, v in REGION_CLIMATE.items()}, None)
        return bounded_broadcast(r.join(first_nation, "r_regionkey", "left").select(
            F.col("r_name").alias("region_code"),
            initcap_word(F.col("r_name")).alias("region_name"),
            "country",
            currency.alias("currency_code"),
            climate.alias("climate_zone"),
            F.concat(F.lit("DC-"), F.regexp_replace("r_name", " ", "")).alias("primary_dc_id"),
            F.col("r_regionkey"),
        ))

    @cached_property
    def dim_store(self) -> DataFrame:
        """One store per nation (25 by the TPC-H definition); a region's Ecommerce location is no store."""
        n = self.table("nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
        return bounded_broadcast(n.join(self.dim_region, "r_regionkey").select(
            F.col("n_name").alias("store_id"),
            F.concat(initcap_word(F.col("n_name")), F.lit(" Store")).alias("store_name"),
            "region_code",
            initcap_word(F.col("n_name")).alias("city"),
            "climate_zone",
            case_map(F.col("n_nationkey") % 4, dict(enumerate(STORE_TIERS)), None).alias("store_tier"),
            "primary_dc_id",
            "currency_code",
        ))

    @cached_property
    def dim_week(self) -> DataFrame:
        return bounded_broadcast(cal.dim_week(self.spark, self.sc))

    # ------------------------------------------------------------------ products
    @cached_property
    def part_sku(self) -> DataFrame:
        """Projection of ``part`` to its SKU keys (no aggregation, scales with part)."""
        p = self.table("part")
        category = category_of(F.col("p_type"))
        size_code = (F.col("p_size") % 5).cast("int")
        style_id = F.concat(F.col("p_brand"), F.lit("-"), F.col("p_type"))
        return p.select(
            "p_partkey",
            style_id.alias("style_id"),
            sku_code(style_id, size_code).alias("sku_id"),
            category.alias("category"),
            size_code.alias("size_code"),
            size_label(category, size_code).alias("size"),
            F.col("p_retailprice"),
            F.col("p_name"),
        )

    @cached_property
    def style_life(self) -> DataFrame:
        """First and last ship date per style."""
        return (self.sales_base.groupBy("style_id")
                .agg(F.min("l_shipdate").cast("date").alias("launch_date"),
                     F.max("l_shipdate").cast("date").alias("planned_exit_date")))

    @cached_property
    def dim_style(self) -> DataFrame:
        p = self.table("part")
        brand_no = F.substring("p_brand", 7, 10).cast("int")
        styles = (p.groupBy(F.concat("p_brand", F.lit("-"), "p_type").alias("style_id"), "p_brand", "p_type")
                  .agg(F.min("p_name").alias("min_name"), F.max("p_name").alias("max_name"),
                       F.min("p_retailprice").alias("min_price")))
        s = styles.join(self.style_life, "style_id", "left")
        return self.once("dim_style", lambda: s.select(
            "style_id",
            F.concat(F.col("p_brand"), F.lit(" "), initcap_word(F.col("p_type"))).alias("style_name"),
            category_of(F.col("p_type")).alias("category"),
            F.split_part(F.col("min_name"), F.lit(" "), F.lit(2)).alias("silhouette"),
            case_map(brand_no % 3, dict(enumerate(GENDERS)), None).alias("gender"),
            F.split_part(F.col("max_name"), F.lit(" "), F.lit(2)).alias("material"),
            (F.lit(1) + brand_no % 5).cast("int").alias("warmth_rating"),
            "launch_date", "planned_exit_date",
            money(money(F.col("min_price")) * F.lit(0.4).cast("decimal(2,1)")).cast("double").alias("base_wholesale_cost"),
            F.col("min_price").alias("base_retail_price_usd"),
            cal.week_of(F.col("launch_date"), self.sc).alias("launch_week"),
            cal.week_of(F.col("planned_exit_date"), self.sc, clip_upper=False).alias("exit_week_uncapped"),
        ))

    @cached_property
    def dim_sku(self) -> DataFrame:
        skus = (self.part_sku
                .groupBy("sku_id", "style_id", "size")
                .agg(F.min("p_retailprice").alias("current_retail_price"), F.min("p_name").alias("min_name")))
        color = initcap_word(F.split_part(F.col("min_name"), F.lit(" "), F.lit(1)))
        st = self.dim_style.select("style_id", "exit_week_uncapped")
        return self.once("dim_sku", lambda: skus.join(st, "style_id", "left").select(
            "sku_id", "style_id",
            color.alias("color_name"),
            case_map(color, COLOR_FAMILY, "Neutral").alias("color_family"),
            "size",
            F.when(F.col("size").rlike("^[0-9]+$"), F.lit("Numeric")).otherwise(F.lit("Alpha")).alias("size_type"),
            "current_retail_price",
            F.coalesce(F.col("exit_week_uncapped") + 6 >= F.lit(self.sc.as_of_week), F.lit(False)).alias("active_flag"),
        ))

    @cached_property
    def dim_supplier(self) -> DataFrame:
        s = self.table("supplier").select("s_suppkey", "s_name", "s_nationkey")
        nr = self.nation_region.select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "region_code")
        return s.join(nr, "s_nationkey").select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name"),
                                                F.col("n_name").alias("country"), "region_code")

    @cached_property
    def dim_dc(self) -> DataFrame:
        return self.dim_region.select(F.col("primary_dc_id").alias("dc_id"), "region_code", "country", "currency_code")

    @cached_property
    def dim_return_reason(self) -> DataFrame:
        """The fixed reason codes, numbered."""
        codes = F.array(*map(F.lit, RETURN_REASONS))
        return self.spark.range(1).select(F.posexplode(codes).alias("reason_no", "reason_code"))

    # ------------------------------------------------------------------ customers
    @cached_property
    def dim_customer(self) -> DataFrame:
        """Customers scale with the data: never broadcast."""
        c = self.table("customer")
        nr = self.nation_region.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "region_code")
        tier = F.lit("Private Client")
        for bound, name in reversed(LOYALTY_BANDS):
            tier = F.when(F.col("c_acctbal") < bound, F.lit(name)).otherwise(tier)
        return c.join(nr, "c_nationkey").select(
            F.col("c_custkey").alias("customer_id"),
            F.when((F.col("c_custkey") % 2) == 0, F.lit("Store")).otherwise(F.lit("Ecommerce")).alias("acquisition_channel"),
            F.when(F.col("c_mktsegment") == self.sc.cohort_segment, F.lit(self.sc.cohort_campaign_id))
             .alias("acquisition_campaign_id"),
            F.col("n_name").alias("home_country"),
            F.col("region_code").alias("home_region"),
            tier.alias("loyalty_tier"),
            tier.isin("Platinum", "Private Client").alias("is_vip_flag"),
        )

    # ------------------------------------------------------------------ sales
    @cached_property
    def supplier_region(self) -> DataFrame:
        s = self.table("supplier").select("s_suppkey", "s_nationkey")
        nr = self.nation_region.select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "region_code")
        # broadcast while supplier is small; past the bound it is joined by shuffle on l_suppkey
        # at most one nation per supplier: the supplier table bounds the row count
        return checked_broadcast(s.join(nr, "s_nationkey").select("s_suppkey", "n_name", "region_code"), self.bytes_of("supplier"))

    @cached_property
    def sales_base(self) -> DataFrame:
        """lineitem ⨝ part (SKU keys) ⨝ supplier (nation, region): the one scan of the fact. It is written once;
        sales, returns, purchase orders, style dates and weekly demand all read the written table. The order id
        follows from the line keys and is not stored."""
        return base_from_stored(self.stored_base)

    @cached_property
    def stored_base(self) -> DataFrame:
        return self.once("sales_base", self._sales_base)

    def _sales_base(self) -> DataFrame:
        li = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
        # part is broadcast while it is small; past the bound it is joined by shuffle on l_partkey
        ps = checked_broadcast(self.part_sku.drop("p_name", "sku_id", "size"), self.bytes_of("part"))
        j = (li.join(ps, li.l_partkey == ps.p_partkey)
             .join(self.supplier_region, li.l_suppkey == F.col("s_suppkey")))
        # money in integer cents: (cents × (100 − discount %) + 50) div 100 is exact half-up rounding,
        # identical on every engine and far cheaper per line than decimal casts
        disc_pct = whole(F.col("l_discount") * 100)
        ext_cents = whole(F.col("l_extendedprice") * 100)
        store = F.coalesce(F.col("l_linestatus") == "F", F.lit(False))
        return j.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate", "p_retailprice",
            # the store of the supplier's nation, or its region's Ecommerce location
            F.when(store, F.col("n_name")).otherwise(F.concat(F.lit("ECOM-"), F.col("region_code"))).alias("location_id"),
            store.alias("is_store"),
            "region_code", "style_id", "category", "size_code",
            cal.week_of("l_shipdate", self.sc).alias("week_id"),
            F.col("l_quantity").cast("int").alias("units"),
            F.col("l_discount").alias("markdown_pct"),
            cents_half_up(ext_cents * (100 - disc_pct)).alias("revenue_cents"),
        )

    @cached_property
    def sales(self) -> DataFrame:
        """Silver fact_sales_line (P1: projection + ``units > 0``), without the customer."""
        return sales_from_lines(self.sales_base)

    @cached_property
    def sales_by_week(self) -> DataFrame:
        """``sales`` with the rows of a week dealt together: only what is stored crosses the network, what follows
        from it is added afterwards."""
        lines = self.stored_base.where(F.col("units") > 0).drop("l_suppkey").hint("rebalance", "week_id")
        lines = base_from_stored(lines).drop("p_retailprice", "location_type")
        return sales_from_lines(lines.withColumn("location_type", F.col("channel")))

    @cached_property
    def order_customers(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey"), F.col("o_custkey").alias("customer_id"))

    @cached_property
    def sales_with_customer(self) -> DataFrame:
        """Sales lines with the ordering customer (one more shuffle join, on l_orderkey)."""
        o = self.order_customers
        return self.sales.join(o, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")

    @cached_property
    def returns(self) -> DataFrame:
        """fact_returns_line: sales lines flagged R; reason by a fixed rule on the line key."""
        return returns_from_sales(self.sales)

    @cached_property
    def return_reviews(self) -> DataFrame:
        """Review text of returned lines: documents.text where doc_id = the part key."""
        docs = self.table("documents").select(F.col("doc_id"), F.col("text").alias("review_text"))
        return (self.returns.join(docs, F.col("l_partkey") == F.col("doc_id"), "left")
                .drop("doc_id"))

    # ------------------------------------------------------------------ supply chain
    @cached_property
    def po_lines(self) -> DataFrame:
        """A purchase-order line for every line of every order; late (delayed) when shipped after order date + 30."""
        return self._po_lines(self.sales_base)

    @cached_property
    def po_lines_ahead(self) -> DataFrame:
        """The purchase-order lines that ship on the as-of date or later: every open delayed one is among them, as a
        delayed line is received when it ships. Lines are left out before the join with the orders."""
        return self._po_lines(self.sales_base.where(F.col("l_shipdate").cast("date") >= F.lit(self.sc.as_of_date)))

    def _po_lines(self, lines: DataFrame) -> DataFrame:
        o = self.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
        li = lines.select("l_orderkey", "l_linenumber", "l_suppkey", "style_id", "p_retailprice", "region_code",
                          F.col("units").alias("l_quantity"), F.col("l_shipdate").cast("date").alias("ship_date"))
        j = li.join(o, li.l_orderkey == o.o_orderkey)
        expected = F.date_add("order_date", 30)
        delayed = F.col("ship_date") > expected
        return j.select(
            F.concat(F.lit("PO-"), F.col("l_orderkey").cast("string")).alias("po_id"),
            F.concat(F.lit("PO-"), F.col("l_orderkey").cast("string"), F.lit("-L"), F.col("l_linenumber").cast("string"))
             .alias("po_line_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.concat(F.lit("DC-"), F.regexp_replace("region_code", " ", "")).alias("dc_id"),
            "style_id", "order_date",
            expected.alias("original_expected_receipt_date"),
            F.when(delayed, F.col("ship_date")).otherwise(expected).alias("revised_expected_receipt_date"),
            F.when(~delayed & (F.col("ship_date") <= F.lit(self.sc.as_of_date)), F.col("ship_date"))
             .alias("actual_receipt_date"),
            F.col("l_quantity").cast("int").alias("units_ordered"),
            money(money(F.col("p_retailprice")) * F.lit(0.4).cast("decimal(2,1)")).cast("double").alias("unit_cost"),
            delayed.alias("is_delayed"),
        )

    # ------------------------------------------------------------------ weather
    @cached_property
    def weather_actual(self) -> DataFrame:
        """Region × week grid (J16): deterministic deviation (week·7 + regionkey·3) % 11 − 5."""
        r = self.dim_region.select("region_code", "r_regionkey",
                                   F.explode(F.sequence(F.lit(1), F.lit(self.sc.n_weeks))).alias("week_id"))
        return r.select(
            "region_code", "week_id",
            (((F.col("week_id") * 7 + F.col("r_regionkey") * 3) % 11) - 5).cast("float").alias("avg_temp_vs_normal_c"))


def base_from_stored(stored: DataFrame) -> DataFrame:
    """Base lines with the columns that follow from the stored ones: writing a text column costs a line more than all
    joins do, so SKU, size, channel and unit price are put together when read."""
    place = F.when(F.col("is_store"), F.lit("Store")).otherwise(F.lit("Ecommerce"))
    price_cents, disc_pct = whole(F.col("p_retailprice") * 100), whole(F.col("markdown_pct") * 100)
    keys = [c for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate", "p_retailprice")
            if c in stored.columns]
    return stored.select(
        *keys, "location_id",
        place.alias("location_type"), place.alias("channel"), "region_code",
        sku_code(F.col("style_id"), F.col("size_code")).alias("sku_id"), "style_id", "category",
        size_label(F.col("category"), F.col("size_code")).alias("size"), "week_id", "units", "markdown_pct",
        cents_half_up(price_cents * (100 - disc_pct)).alias("unit_price_cents"), "revenue_cents")


def sales_from_lines(lines: DataFrame) -> DataFrame:
    """Sales lines from stored base lines: positive units, with the columns that follow from the stored ones."""
    return (lines.where(F.col("units") > 0)
            .withColumn("order_id", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
            .withColumn("unit_price", F.col("unit_price_cents") / 100.0)
            .withColumn("gross_revenue", F.col("revenue_cents") / 100.0))


def returns_from_sales(sales: DataFrame) -> DataFrame:
    """fact_returns_line from any sales frame with the line keys, return flag and ship date (the fixture's
    view, or the written silver sales table): lines flagged R, reason by a fixed rule on the line key."""
    reason = case_map((F.col("l_orderkey") + F.col("l_linenumber")) % 8, dict(enumerate(RETURN_REASONS)), None)
    return sales.where(F.col("l_returnflag") == "R").select(
        F.concat(F.lit("RET-"), F.col("order_id")).alias("return_line_id"),
        "l_orderkey", "l_linenumber", "l_partkey",
        "location_id", "location_type", "region_code", "channel", "sku_id", "style_id", "size", "category", "week_id",
        (F.col("l_shipdate") + F.expr("INTERVAL 7 DAYS")).alias("return_date"),
        F.col("units").alias("units_returned"),
        reason.alias("reason_code"),
        "revenue_cents",
    )


def fixture(spark: SparkSession, sf_dir: str, sc: Scenario = DEFAULT) -> Fixture:
    return Fixture(spark, sf_dir, sc)


def _attach_engine_views():
    """Engine-backed views (kept apart so fixture.py reads top-down)."""
    from ..operators import engine as eng

    def weekly(self) -> DataFrame:
        # bucketed by listing: the engine and everything after it run where the rows lie
        return self.once("weekly", lambda: eng.weekly_demand(self.sales), eng.LISTING_KEYS, ["week_id"])

    def assortment_of(self, weekly: DataFrame) -> DataFrame:
        return eng.listing_windows(weekly).select(
            "location_id", "location_type", "region_code", "sku_id", "style_id",
            "assortment_start_week", "assortment_end_week", "total_units",
            F.col("style_id").startswith(self.sc.capsule_prefix).alias("is_core_flag"))

    Fixture.assortment_of = assortment_of

    def assortment(self) -> DataFrame:
        return self.assortment_of(self.weekly)

    def engine(self) -> DataFrame:
        return self.once("engine", lambda: eng.run_engine(self.weekly, self.dim_style), eng.LISTING_KEYS, ["week_id"])

    def inventory(self) -> DataFrame:
        return self.engine.select(
            "location_id", "location_type", "region_code", "sku_id", "week_id",
            "on_hand_units", "weeks_of_supply")

    def engagement(self) -> DataFrame:
        from ..operators.supply import digital_engagement
        return digital_engagement(self.sales, VIRAL_STYLE, VIRAL_TRIGGER_WEEK)

    def shipment_events(self) -> DataFrame:
        from ..operators.supply import shipment_events
        return shipment_events(self.po_lines)

    for fn in (weekly, assortment, engine, inventory, engagement, shipment_events):
        prop = cached_property(fn)
        prop.__set_name__(Fixture, fn.__name__)
        setattr(Fixture, fn.__name__, prop)


_attach_engine_views()
