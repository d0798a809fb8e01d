"""Registered data-quality checks (V2-V6, S14) with SQL twins."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..oracle.fixture_sql import lit
from ..params import DEFAULT as SC
from ..params import HIGH_TIERS, ROW_COUNT_BANDS_FULL
from ..session import ensure_checkpoint_dir
from ..sources import layers
from ..sources.fixture import Fixture
from ..sources.tables import read_glob
from . import decisions as dq
from . import quality as qa
from .q_analysis import FIT_SIZES, FIT_STYLE, WARM, _in
from .q_decisions import queue
from .q_marts import cohort, gold
from .registry import register

FK_RULES = [
    ("sales.sku_id -> dim_sku", "fx_sales", "sku_id", "fx_dim_sku", "sku_id", None),
    ("sales.location_id -> dim_store", "fx_sales", "location_id", "fx_dim_store", "store_id", "channel = 'Store'"),
    ("inventory.sku_id -> dim_sku", "fx_inventory", "sku_id", "fx_dim_sku", "sku_id", None),
    ("returns.sku_id -> dim_sku", "fx_returns", "sku_id", "fx_dim_sku", "sku_id", None),
]


def _row(name, level, observed_sql, bound, ok_sql, from_sql) -> str:
    return (f"SELECT {lit(name)} AS \"check\", {lit(level)} AS level, CAST({observed_sql} AS DOUBLE) AS observed, "
            f"CAST({float(bound)!r} AS DOUBLE) AS bound, COALESCE({ok_sql}, FALSE) AS ok FROM ({from_sql})")


def _fk_sql() -> list[str]:
    out = []
    for name, child, ccol, parent, pcol, where in FK_RULES:
        w = f" AND c.{where}" if where else ""
        src = (f"SELECT COUNT(*) AS n FROM {child} c WHERE c.{ccol} IS NOT NULL{w} "
               f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{ccol})")
        out.append(_row(name, "fail", "n", 0, "n = 0", src))
    return out


def _fk_rules(fx: Fixture):
    views = {"fx_sales": fx.sales, "fx_inventory": fx.inventory, "fx_returns": fx.returns,
             "fx_dim_sku": fx.dim_sku, "fx_dim_store": fx.dim_store}
    return [(name, views[c], cc, views[p], pc, F.expr(w) if w else None) for name, c, cc, p, pc, w in FK_RULES]


@register("v3_referential_integrity", "\nUNION ALL\n".join(_fk_sql()))
def q_v3(spark, sf_dir):
    """V3: foreign keys of the facts resolve (J10 anti joins), one row per rule."""
    return qa.referential_integrity(_fk_rules(Fixture(spark, sf_dir)))


_V4_SQL = _row("inventory.on_hand_units >= 0", "fail", "n", 0, "n = 0",
               "SELECT COUNT(*) AS n FROM fx_inventory WHERE on_hand_units < 0")


@register("v4_negative_inventory", _V4_SQL)
def q_v4(spark, sf_dir):
    """V4: no negative on-hand in the inventory fact."""
    return qa.no_negative(Fixture(spark, sf_dir).inventory, "on_hand_units", "inventory.on_hand_units >= 0")


_tiers = ", ".join(lit(t) for t in HIGH_TIERS)
_V5_SQL = [
    _row("weather shock: warm-region max deviation", "fail", "v", 3.0, "v >= 3.0",
         f"SELECT MAX(avg_temp_vs_normal_c) AS v FROM fx_weather_actual WHERE region_code IN {_in(WARM)}"),
    _row("fit problem: peak return rate", "fail", "v", 0.18, "v >= 0.18",
         f"SELECT MAX(return_rate) AS v FROM gold_m4 WHERE style_id = {lit(FIT_STYLE)} AND size IN {_in(FIT_SIZES)}"),
    _row("supply disruption: mean delay of open delayed POs (days)", "fail", "v", 14.0, "v >= 14.0",
         "SELECT AVG(date_diff('day', original_expected_receipt_date, revised_expected_receipt_date)) AS v FROM gold_delays"),
    _row("cohort: repeat-purchase lift", "fail", "v", SC.thresholds["cohort_lift_min"],
         f"v >= {SC.thresholds['cohort_lift_min']!r}",
         f"""SELECT (SELECT AVG(n_orders) FROM gold_m6 WHERE is_cohort)
                   / NULLIF((SELECT AVG(n_orders) FROM gold_m6 WHERE home_region = {lit(SC.cohort_region)}
                             AND NOT is_cohort AND loyalty_tier IN ({_tiers})), 0) AS v"""),
    _row("decision queue not empty", "fail", "v", 1.0, "v >= 1.0", "SELECT COUNT(*) AS v FROM gold_dq"),
]


def _v5(fx: Fixture):
    g = gold(fx)
    lift = dq.cohort_lift(cohort(fx), fx.sc, HIGH_TIERS)
    return [
        qa.at_least(fx.weather_actual.where(F.col("region_code").isin(WARM)), F.max("avg_temp_vs_normal_c"),
                    "weather shock: warm-region max deviation", 3.0),
        qa.at_least(g["m4"].where((F.col("style_id") == FIT_STYLE) & F.col("size").isin(FIT_SIZES)),
                    F.max("return_rate"), "fit problem: peak return rate", 0.18),
        qa.at_least(g["delays"], F.avg(F.datediff("revised_expected_receipt_date", "original_expected_receipt_date")),
                    "supply disruption: mean delay of open delayed POs (days)", 14.0),
        qa.at_least(lift, F.max("lift"), "cohort: repeat-purchase lift", fx.sc.thresholds["cohort_lift_min"]),
        qa.at_least(queue(fx), F.count(F.lit(1)), "decision queue not empty", 1.0),
    ]


@register("v5_signal_checks", "\nUNION ALL\n".join(_V5_SQL), round_cols=("observed",))
def q_v5(spark, sf_dir):
    """V5: planted-signal assertions (A7 max of a filtered set, E19 delay, J12 lift, queue size)."""
    return qa.report(_v5(Fixture(spark, sf_dir)))


@register("v6_quality_report", "\nUNION ALL\n".join(_fk_sql() + [_V4_SQL] + _V5_SQL), round_cols=("observed",))
def q_v6(spark, sf_dir):
    """V6: the full report, hard failures and soft warnings in one frame."""
    fx = Fixture(spark, sf_dir)
    return qa.report([qa.referential_integrity(_fk_rules(fx)),
                      qa.no_negative(fx.inventory, "on_hand_units", "inventory.on_hand_units >= 0"), *_v5(fx)])


_COUNTED = ["fx_dim_week", "fx_dim_region", "fx_dim_store", "fx_dim_style", "fx_dim_sku", "fx_dim_customer",
            "fx_sales", "fx_returns", "fx_assortment", "fx_po_lines", "fx_weather_actual"]


@register("s14_table_row_counts",
          "\nUNION ALL\n".join(f"SELECT {lit(t[3:])} AS table_name, COUNT(*) AS n_rows FROM {t}" for t in _COUNTED))
def q_s14(spark, sf_dir):
    """Row count per fixture table (one distributed count each, unioned)."""
    fx = Fixture(spark, sf_dir)
    return qa.table_counts({t[3:]: getattr(fx, t[3:]) for t in _COUNTED})


# fact table of the reference -> fixture view that stands for it (the campaign exposure fact has no
# fixture view: its band is not checked)
_BANDED = {"fact_sales_line": "fx_sales", "fact_inventory_position": "fx_inventory", "fact_returns_line": "fx_returns",
           "fact_purchase_order_line": "fx_po_lines", "fact_shipment_event": "fx_shipment_events",
           "fact_digital_engagement": "fx_engagement"}


def _band_sql(table: str, view: str) -> str:
    lo, hi = ROW_COUNT_BANDS_FULL[table]
    return (f"SELECT {lit(table + ' rows in full-scale band')} AS \"check\", 'warn' AS level, CAST(n AS DOUBLE) AS observed, "
            f"CAST({float(lo)!r} AS DOUBLE) AS bound, COALESCE(n BETWEEN {lo} AND {hi}, FALSE) AS ok, "
            f"CAST({float(hi)!r} AS DOUBLE) AS upper_bound FROM (SELECT COUNT(*) AS n FROM {view})")


@register("v2_row_count_bands", "\nUNION ALL\n".join(_band_sql(t, v) for t, v in _BANDED.items()))
def q_v2(spark, sf_dir):
    """V2: soft warnings when a fact's row count leaves the band the full-scale build should land in
    (one distributed count per fact; ``ok`` is false for every fact at the small test scales)."""
    fx = Fixture(spark, sf_dir)
    rows = [qa.row_count_band(getattr(fx, v[3:]), f"{t} rows in full-scale band", *ROW_COUNT_BANDS_FULL[t])
            .withColumn("upper_bound", F.lit(float(ROW_COUNT_BANDS_FULL[t][1])))
            for t, v in _BANDED.items()]
    return qa.report(rows)


# ------------------------------------------------------------------ the written layers
_SILVER_SQL = {
    "dim_customer": "fx_dim_customer", "dim_dc": "region", "dim_region": "fx_dim_region", "dim_sku": "fx_dim_sku",
    "dim_return_reason": "(SELECT UNNEST(range(8)))", "dim_store": "fx_dim_store", "dim_style": "fx_dim_style",
    "dim_supplier": "fx_supplier_region", "dim_week": "fx_dim_week", "fact_inventory_position": "fx_inventory",
    "fact_purchase_order_line": "fx_po_lines", "fact_returns_line": "fx_returns", "fact_sales_line": "fx_sales",
    "fact_weather_actual": "fx_weather_actual", "store_sku_assortment": "fx_assortment",
}
_GOLD_SQL = {
    "weekly_demand_style_region": "gold_m1", "weekly_demand_store_sku": "gold_m2", "inventory_imbalance_signals": "gold_m3",
    "returns_scorecard": "gold_m4", "supply_risk_exposure": "gold_m5", "customer_cohort_scorecard": "gold_m6",
    "decision_queue": "gold_dq", "approved_actions": "(SELECT 1 WHERE FALSE)",
}


def _layers(spark, sf_dir):
    """The layers of one source, built once per application (again if the source files change)."""
    fx = Fixture(spark, sf_dir)

    def build():
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/layers-{uuid.uuid4().hex}"
        layers.build_all(spark, sf_dir, root)
        counts = [layers.layer_row_counts(spark, layer).withColumn("layer", F.lit(layer)) for layer in ("silver", "gold")]
        return counts[0].unionByName(counts[1])
    return fx.once("layer_row_counts", build)


@register("m38_layer_row_counts", "\nUNION ALL\n".join(
    f"SELECT {lit(layer)} AS layer, {lit(t)} AS table_name, COUNT(*) AS n_rows FROM {v}"
    for layer, tables in (("silver", _SILVER_SQL), ("gold", _GOLD_SQL)) for t, v in tables.items()))
def q_m38(spark, sf_dir):
    """M38 + S14: row count of every table of the written silver and gold layers."""
    return _layers(spark, sf_dir).select("layer", "table_name", "n_rows")


@register("v1_missing_tables", "\nUNION ALL\n".join(
    f"SELECT {lit(layer)} AS layer, {lit(t)} AS table_name, TRUE AS present"
    for layer, tables in (("silver", _SILVER_SQL), ("gold", _GOLD_SQL)) for t in tables))
def q_v1(spark, sf_dir):
    """V1 + U2: every expected table of the layers and whether the build published it."""
    have = _layers(spark, sf_dir).select("layer", "table_name", F.lit(True).alias("present"))
    expected = [(layer, t) for layer, tables in (("silver", layers.SILVER_TABLES), ("gold", list(_GOLD_SQL))) for t in tables]
    names = spark.createDataFrame(expected, "layer string, table_name string")
    return names.join(have, ["layer", "table_name"], "left").withColumn("present", F.coalesce("present", F.lit(False)))


@register("s15_glob_scan", "SELECT s_nationkey, COUNT(*) AS n_suppliers FROM supplier GROUP BY 1")
def q_s15(spark, sf_dir):
    """A scan by glob inside a query."""
    return read_glob(spark, f"{sf_dir.rstrip('/')}/supplie*").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_suppliers"))


@register("u3_watched_styles", f"""
SELECT style_id FROM fx_dim_style WHERE starts_with(style_id, {lit(SC.capsule_prefix)})
UNION SELECT style_id FROM gold_delays
UNION SELECT style_id FROM gold_dq WHERE style_id IS NOT NULL""")
def q_u3(spark, sf_dir):
    """Distinct union of ids: capsule styles, styles with an open delayed PO, styles with a decision."""
    fx = Fixture(spark, sf_dir)
    capsule = fx.dim_style.where(F.col("style_id").startswith(fx.sc.capsule_prefix)).select("style_id")
    decided = queue(fx).where(F.col("style_id").isNotNull()).select("style_id")
    return capsule.union(gold(fx)["delays"].select("style_id")).union(decided).distinct()
