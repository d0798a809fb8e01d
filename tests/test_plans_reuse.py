"""Plan-shape regressions: one scan of the fact, size-checked broadcasts, no global windows, and money totals
that do not depend on partitioning."""
import hashlib
import shutil

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.expr import exact_sum
from shelfwise.operators import engine as eng
from shelfwise.operators import sampling
from shelfwise.operators.broadcast import checked_broadcast
from shelfwise.operators.numbering import number_rows
from shelfwise.plans import all_queries, marts
from shelfwise.plans.q_marts import gold
from shelfwise.session import ensure_checkpoint_dir
from shelfwise.sources.fixture import Fixture
from shelfwise.sources.tables import write_table

from conftest import SF_SMALL


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(df, table):
    return _executed(df).split("== Initial Plan ==")[0].count(f"/{table}.parquet")


def test_queries_read_the_written_fact(spark):
    # lineitem is scanned once, for the written sales lines; the marts and rules read derived tables
    q, _ = all_queries()
    for name in ("m2_weekly_demand_store_sku", "m3_inventory_imbalance_signals", "m37_executive_rollup", "decision_queue", "c2_style_variants"):
        assert _scans(q[name](spark, SF_SMALL), "lineitem") == 0, name
    fx = Fixture(spark, SF_SMALL)
    assert _scans(fx._sales_base(), "lineitem") == 1


def test_stored_facts_are_read_without_an_exchange(spark):
    """The engine and weekly demand are bucketed by listing: m2 is a scan, and so are the engine's joins and windows."""
    q, _ = all_queries()
    assert "Exchange hashpartitioning" not in _executed(q["m2_weekly_demand_store_sku"](spark, SF_SMALL))
    fx = Fixture(spark, SF_SMALL)
    plan = fx.once("listing_plan", lambda: eng.listing_plan(fx.weekly, fx.dim_style), eng.LISTING_KEYS)
    assert "hashpartitioning(location_id" not in _executed(eng.resume(plan, fx.weekly, 100, 140))
    assert "hashpartitioning(location_id" not in _executed(eng.run_engine(fx.weekly, fx.dim_style))


def test_engine_is_written_without_an_exchange_in_any_session(spark):
    """A session with Spark's own default for co-partitioning: the dense rows still stay where the listing lies."""
    name, plans = "spark.sql.requireAllClusterKeysForCoPartition", []
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        fx = Fixture(spark, SF_SMALL)

        def build():
            df = eng.run_engine(fx.weekly, fx.dim_style)
            plans.append(_executed(df))
            return df
        fx.once("engine_in_any_session", build, eng.LISTING_KEYS, ["week_id"])
        assert "hashpartitioning(location_id" not in plans[0]
        assert spark.conf.get(name) == "true"
    finally:
        spark.conf.set(name, before)


def test_base_lines_store_no_text_that_follows_from_other_columns(spark):
    fx = Fixture(spark, SF_SMALL)
    stored = fx._sales_base()
    assert {f.name for f in stored.schema if f.dataType.simpleString() == "string"} \
        == {"l_returnflag", "location_id", "region_code", "style_id", "category"}
    part = fx.part_sku.select("p_partkey", "sku_id", "size", F.col("style_id").alias("s"), F.col("category").alias("c"))
    both = fx.sales_base.select("l_partkey", "sku_id", "size", "style_id", "category").exceptAll(
        fx.table("lineitem").select("l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_partkey", "sku_id", "size", "s", "c"))
    assert both.count() == 0 < fx.sales_base.count()


def test_roll_ups_do_not_read_the_fanned_out_exposure(spark):
    g = gold(Fixture(spark, SF_SMALL))
    fan, folded = g.m5, g.exposed
    assert folded.agg(F.sum("n_terms")).first()[0] == fan.count() > folded.count()


def test_open_delays_join_only_lines_that_ship_later(spark):
    """Lines shipped before the as-of date are left out before the join with the orders, and no open delay is lost."""
    fx = Fixture(spark, SF_SMALL)
    assert sorted(gold(fx).delays.collect(), key=str) == sorted(marts.open_delays(fx.po_lines, fx.sc.as_of_date).collect(), key=str)
    joined = fx.po_lines_ahead._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)[1]
    assert "cast(l_shipdate" in joined


def test_cohort_sums_orders_before_the_join(spark):
    rows = [(1, 2, 100, "C-1"), (1, 3, 50, "D-1"), (2, 4, None, None), (3, 9, 10, "C-2")]
    sales = spark.createDataFrame(rows, "l_orderkey long, units int, revenue_cents long, style_id string")
    orders = spark.createDataFrame([(1, 7), (1, 7), (2, 8), (3, None)], "o_orderkey long, customer_id long")
    customers = spark.createDataFrame([(7, "R", "Gold", "X"), (8, "R", "Gold", None), (9, "R", "None", None)],
                                      "customer_id long, home_region string, loyalty_tier string, acquisition_campaign_id string")
    card = marts.customer_cohort_scorecard(sales, orders, customers, "X", "C-")
    got = {r.customer_id: (r.is_cohort, r.n_orders, r.total_units, r.total_revenue, r.capsule_units, r.is_repeat_purchaser)
           for r in card.collect()}
    assert got == {7: (True, 4, 10, 3.0, 4, True), 8: (False, 1, 4, 0.0, 0, False), 9: (False, 0, 0, 0.0, 0, False)}
    assert "Aggregate [l_orderkey" in card._jdf.queryExecution().optimizedPlan().toString().split("Join Inner", 1)[1]


def test_layers_shuffle_stored_columns_only(spark, tmp_path):
    fx = Fixture(spark, SF_SMALL)
    names = sorted(fx.sales.columns)
    assert sorted(fx.sales_by_week.columns) == sorted(set(names) - {"l_suppkey", "p_retailprice"})
    assert sorted(fx.sales_by_week.select(*sorted(fx.sales_by_week.columns)).collect(), key=str) \
        == sorted(fx.sales.select(*sorted(fx.sales_by_week.columns)).collect(), key=str)
    below = fx.sales_by_week._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions", 1)[1]
    assert not any(c in below for c in ("order_id", "gross_revenue", "unit_price AS", "location_type AS"))
    plain = spark.range(8).selectExpr("id", "id % 2 AS week_id").repartition(3)
    write_table(plain, str(tmp_path / "dealt"), ["week_id"], dealt=True)
    assert spark.read.parquet(str(tmp_path / "dealt")).count() == 8


def test_changed_sources_are_derived_anew(spark, tmp_path):
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        shutil.copyfile(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")  # not its read-only mode
    new = F.col("style_id").startswith("Brand#99")
    assert Fixture(spark, str(tmp_path)).dim_style.where(new).count() == 0
    part = Fixture(spark, str(tmp_path)).table("part").toPandas()
    part.loc[0, "p_brand"] = "Brand#99"
    part.to_parquet(tmp_path / "part.parquet", index=False)
    assert Fixture(spark, str(tmp_path)).dim_style.where(new).count() == 1


def test_no_folder_no_cluster_run(monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(type("S", (), {"sparkContext": Context()})())


def test_checked_broadcast_asks_for_the_size(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    facts = spark.range(1000).select((F.col("id") % 10).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in _executed(facts.join(checked_broadcast(small, 1000, max_bytes=2000), "k"))
        assert "BroadcastHashJoin" not in _executed(facts.join(checked_broadcast(small, 3000, max_bytes=2000), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbering_is_consecutive_without_a_global_window(spark):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k"))
    got = number_rows(df, [F.col("k")])
    rows = got.orderBy("n").collect()
    assert [r.n for r in rows] == list(range(1, 5001)) and [r.k for r in rows] == sorted(r.k for r in rows)
    assert number_rows(df.limit(0), [F.col("k")]).count() == 0


def test_stratified_pick_by_slices_equals_a_plain_rank(spark):
    rows = spark.range(3000).select(F.concat(F.lit("g"), F.col("id") % 3).alias("g"), F.col("id").cast("string").alias("k"))
    got = sampling.stratified_pick(rows, "g", ["k"], F.lit(0.1))
    want = set()
    for g in range(3):
        keys = sorted((hashlib.md5(f"{i}|42".encode()).hexdigest(), str(i)) for i in range(g, 3000, 3))
        want |= {(f"g{g}", k) for _, k in keys[:100]}
    assert {(r.g, r.k) for r in got.collect()} == want


def test_exact_sum_does_not_depend_on_partitioning(spark):
    # 0.1 + 0.2 + ... in different orders gives different doubles; the fixed-point sum is one value
    vals = spark.createDataFrame([(i, (i % 97) * 0.1 + 0.005) for i in range(5000)], "id long, x double")
    a = vals.repartition(1).agg(exact_sum("x").alias("s")).first().s
    b = vals.repartition(13, "id").agg(exact_sum("x").alias("s")).first().s
    c = vals.orderBy(F.desc("id")).coalesce(1).agg(exact_sum("x").alias("s")).first().s
    assert a == b == c
