"""Bronze / silver / gold layers on a shared folder.

* bronze: the landed tables, discovered by name and copied as parquet folders;
* silver: the retail schema derived from bronze (fixture views), with the
  silver sales override (positive units); facts partitioned by ``week_id``
  so as-of filters prune folders;
* gold: marts in dependency order (M2 before M3, M3 before M5), each read back
  from its written folder, which also cuts the lineage between stages;
  then the decision queue and the empty approvals table.

Layer databases are registered in the session catalog over the folders.
"""
from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import HIGH_TIERS
from ..operators import engine as eng
from ..operators.broadcast import bounded_broadcast
from .fixture import Fixture, returns_from_sales
from .tables import GIVEN_TABLES, read_table, table_path, write_table

TIMINGS: dict[str, float] = {}
RETAIL_INPUTS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


def discover_tables(spark: SparkSession, root: str) -> list[str]:
    """Table names present under a landing folder (``name.parquet`` files or ``name/`` folders), on any
    storage that Spark reads."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(root).select(F.col("path")))
    base = root.rstrip("/").split("://")[-1]
    rest = F.element_at(F.split("path", _literal(base) + "/"), -1)
    return sorted(r.name for r in files.select(F.regexp_replace(F.split_part(rest, F.lit("/"), F.lit(1)), r"\.parquet$", "").alias("name"))
                  .distinct().collect() if not r.name.startswith(("_", ".")))


def _literal(text: str) -> str:
    return "".join("\\" + c if c in "|.*+?()[]{}^$\\" else c for c in text)


def create_layer(spark: SparkSession, name: str, location: str) -> None:
    """Create the layer database if absent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def register_table(spark: SparkSession, layer: str, name: str, path: str, partitioned: bool = False) -> None:
    """Create a catalog table over a written folder, or point the existing one to it.

    An existing table of the same columns is switched by one change of its location, so readers always see
    the old or the new version; a changed schema needs a new table.
    """
    full = f"{layer}.{name}"
    fields = lambda schema: sorted((f.name, f.dataType.simpleString()) for f in schema.fields)
    if spark.catalog.tableExists(full) and fields(spark.table(full).schema) == fields(spark.read.parquet(path).schema):
        spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{path}'")
    if partitioned:
        spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
    spark.catalog.refreshTable(full)


def publish(spark: SparkSession, df: DataFrame, root: str, layer: str, name: str,
            partition_by: list[str] | None = None, dealt: bool = False) -> DataFrame:
    """S1 + S7 + S11: write ``df`` as ``root/layer/name``, register it, and return the re-read table."""
    path = f"{root}/{layer}/{name}/v-{uuid.uuid4().hex[:12]}"  # a new folder per version
    t = time.perf_counter()
    write_table(df, path, partition_by, dealt=dealt)
    register_table(spark, layer, name, path, bool(partition_by))
    TIMINGS[f"{layer}.{name}"] = round(time.perf_counter() - t, 3)
    return spark.read.parquet(path)


def load_bronze(spark: SparkSession, landing: str, root: str, names: list[str] | None = None) -> list[str]:
    """Land each discovered table in bronze unchanged."""
    create_layer(spark, "bronze", f"{root}/bronze")
    names = names or [n for n in discover_tables(spark, landing) if n in GIVEN_TABLES]
    for n in names:
        # the bronze folder itself holds the landed files: it is the input of the silver build
        write_table(read_table(spark, landing, n), f"{root}/bronze/{n}")
        register_table(spark, "bronze", n, f"{root}/bronze/{n}")
    return names


SILVER_OVERRIDES = {
    # Silver passes every table through unless an override exists by name
    "fact_sales_line": lambda fx: fx.sales_by_week.select(
        "order_id", "location_id", "location_type", "channel", "region_code", "sku_id", "style_id", "category", "week_id", "units",
        "markdown_pct", "unit_price", "gross_revenue", "revenue_cents", "l_orderkey", "l_linenumber", "l_partkey",
        "l_returnflag", "size", "l_shipdate"),
}


def build_silver(spark: SparkSession, bronze_root: str, root: str, fx: Fixture | None = None) -> dict[str, DataFrame]:
    """Silver: the retail schema from bronze; returns the re-read silver tables."""
    create_layer(spark, "silver", f"{root}/silver")
    fx = fx or Fixture(spark, bronze_root)
    out = {
        "dim_week": publish(spark, fx.dim_week, root, "silver", "dim_week"),
        "dim_region": publish(spark, fx.dim_region, root, "silver", "dim_region"),
        "dim_store": publish(spark, fx.dim_store, root, "silver", "dim_store"),
        "dim_style": publish(spark, fx.dim_style, root, "silver", "dim_style"),
        "dim_sku": publish(spark, fx.dim_sku, root, "silver", "dim_sku"),
        "dim_customer": publish(spark, fx.dim_customer, root, "silver", "dim_customer"),
        "fact_sales_line": publish(spark, SILVER_OVERRIDES["fact_sales_line"](fx), root, "silver",
                                   "fact_sales_line", ["week_id"], dealt=True),
        "fact_purchase_order_line": publish(spark, fx.po_lines, root, "silver", "fact_purchase_order_line"),
        "fact_weather_actual": publish(spark, fx.weather_actual, root, "silver", "fact_weather_actual"),
    }
    # returns are a filter of the sales just written: read the silver table (partitioned, many files)
    # instead of re-running the line-item joins from bronze; its weeks lie together already
    out["fact_returns_line"] = publish(spark, returns_from_sales(out["fact_sales_line"]), root, "silver",
                                       "fact_returns_line", ["week_id"], dealt=True)
    out["dim_supplier"] = publish(spark, fx.dim_supplier, root, "silver", "dim_supplier")
    out["dim_dc"] = publish(spark, fx.dim_dc, root, "silver", "dim_dc")
    out["dim_return_reason"] = publish(spark, fx.dim_return_reason, root, "silver", "dim_return_reason")
    weekly = eng.weekly_demand(out["fact_sales_line"])
    out["store_sku_assortment"] = publish(spark, fx.assortment_of(weekly), root, "silver", "store_sku_assortment")
    # the stored inventory fact keeps the week's demand, so weekly marts read it instead of the engine
    engine = eng.run_engine(weekly, out["dim_style"])
    out["fact_inventory_position"] = publish(
        spark, engine.select("location_id", "location_type", "region_code", "sku_id", "week_id", "on_hand_units",
                             "weeks_of_supply", "demand_units", "revenue_cents"),
        root, "silver", "fact_inventory_position", ["week_id"])
    return out


SILVER_TABLES = ["dim_customer", "dim_dc", "dim_region", "dim_return_reason", "dim_sku", "dim_store", "dim_style", "dim_supplier",
                 "dim_week", "fact_inventory_position", "fact_purchase_order_line", "fact_returns_line", "fact_sales_line",
                 "fact_weather_actual", "store_sku_assortment"]


def build_gold(spark: SparkSession, silver: dict[str, DataFrame], root: str, fx: Fixture) -> dict[str, DataFrame]:
    """Marts in dependency order, each materialised and re-read before the next reads it."""
    from ..plans import decisions as dq
    from ..plans import marts

    create_layer(spark, "gold", f"{root}/gold")
    sc = fx.sc
    sales = silver["fact_sales_line"]
    # the calendar has n_weeks rows by construction; Catalyst decides on styles and SKUs by their file size
    dim_sku = silver["dim_sku"]
    dim_style = silver["dim_style"]
    dim_week = bounded_broadcast(silver["dim_week"])
    g: dict[str, DataFrame] = {}
    g["weekly_demand_style_region"] = publish(spark, marts.weekly_demand_style_region(sales, dim_week), root, "gold",
                                              "weekly_demand_style_region")
    g["weekly_demand_store_sku"] = publish(spark, marts.weekly_demand_store_sku(silver["fact_inventory_position"]), root, "gold",
                                           "weekly_demand_store_sku", ["week_id"], dealt=True)
    g["inventory_imbalance_signals"] = publish(
        spark, marts.inventory_imbalance_signals(g["weekly_demand_store_sku"], dim_sku, dim_style, sc.as_of_week),
        root, "gold", "inventory_imbalance_signals")
    g["returns_scorecard"] = publish(
        spark, marts.returns_scorecard(sales, silver["fact_returns_line"], dim_sku, dim_style, dim_week),
        root, "gold", "returns_scorecard")
    delays = marts.open_delays(silver["fact_purchase_order_line"], sc.as_of_date)
    g["supply_risk_exposure"] = publish(
        spark, marts.supply_risk_exposure(g["inventory_imbalance_signals"], delays),
        root, "gold", "supply_risk_exposure")
    # the silver sales lines in the order they landed, an order's lines together: its sums leave the scan as one row
    g["customer_cohort_scorecard"] = publish(
        spark, marts.customer_cohort_scorecard(fx.sales, fx.order_customers, silver["dim_customer"], sc.cohort_campaign_id,
                                               sc.capsule_prefix),
        root, "gold", "customer_cohort_scorecard")
    floors = dq.materiality_floors(silver["dim_customer"])
    rules = [dq.overstock_stockout_rules(g["inventory_imbalance_signals"], sc, floors),
             dq.returns_rule(g["returns_scorecard"], sc, floors),
             dq.supply_risk_rule(marts.exposed_signals(g["inventory_imbalance_signals"], delays), sc),
             dq.cohort_rule(g["customer_cohort_scorecard"], sc, HIGH_TIERS)]
    g["decision_queue"] = publish(spark, dq.decision_queue(rules), root, "gold", "decision_queue")
    g["approved_actions"] = publish(spark, dq.empty_approvals(spark), root, "gold", "approved_actions")
    return g


def build_all(spark: SparkSession, landing: str, root: str) -> dict[str, DataFrame]:
    """Bronze -> silver -> gold, every layer written under ``root`` (a shared folder)."""
    root = root.rstrip("/")
    load_bronze(spark, landing, root, RETAIL_INPUTS)
    fx = Fixture(spark, f"{root}/bronze")
    silver = build_silver(spark, f"{root}/bronze", root, fx)
    return build_gold(spark, silver, root, fx)


def layer_row_counts(spark: SparkSession, layer: str) -> DataFrame:
    """Every table of a layer database with its row count."""
    from ..plans.quality import table_counts
    names = [t.name for t in spark.catalog.listTables(layer)]
    return table_counts({n: spark.table(f"{layer}.{n}") for n in names})


__all__ = ["build_all", "load_bronze", "build_silver", "build_gold", "discover_tables", "layer_row_counts",
           "table_path"]
