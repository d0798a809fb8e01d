"""Planted truth for the decision rules (M7-M13) on literal marts."""
import datetime as dt

from pyspark.sql import functions as F

from shelfwise.params import DEFAULT as SC
from shelfwise.params import HIGH_TIERS
from shelfwise.plans import decisions as dq
from shelfwise.plans import quality as qa

SIG = ("location_id string, location_type string, region_code string, sku_id string, style_id string, "
       "style_name string, category string, on_hand_units int, projected_remaining_demand double, "
       "trailing_avg_weekly_sales double, remaining_season_weeks int")


def floors(spark, customers=1500):
    return dq.materiality_floors(spark.range(customers))


def test_floors_follow_the_number_of_customers(spark):
    few, many = (spark.range(1).select(*[c.alias(k) for k, c in floors(spark, n).items()]).first() for n in (1500, 2_000_000))
    assert tuple(few) == (3.0, 3.0, 0.5) and tuple(many) == (60.0, 60.0, 8.0)


def test_cohort_rule_needs_its_full_lift(spark):
    """A planted cohort of 1.4 times the control gives no decision, one of 1.5 times does."""
    def cohort(n):
        rows = [(i, SC.cohort_region, "Gold", False, 10) for i in range(5)] + [(9, SC.cohort_region, "Gold", True, n)]
        return spark.createDataFrame(rows, "customer_id long, home_region string, loyalty_tier string, is_cohort boolean, n_orders long")
    assert SC.thresholds["cohort_lift_min"] == 1.5
    assert dq.cohort_rule(cohort(14), SC, HIGH_TIERS).count() == 0
    assert dq.cohort_rule(cohort(15), SC, HIGH_TIERS).first().metric_value == 1.5


def test_quality_checks_can_fail(spark):
    bad = spark.createDataFrame([(1, -5, "x"), (2, 3, "y")], "id int, on_hand int, sku string")
    parent = spark.createDataFrame([("x",)], "sku string")
    rows = qa.report([qa.no_negative(bad, "on_hand", "negative"), qa.at_least(bad, F.max("on_hand"), "peak", 4.0),
                      qa.referential_integrity([("fk", bad, "sku", parent, "sku", None)]), qa.row_count_band(bad, "band", 5, 9)]).collect()
    assert [(r.check, r.observed, r.ok) for r in rows] == [("negative", 1.0, False), ("peak", 3.0, False), ("fk", 1.0, False), ("band", 2.0, False)]


def signals(spark):
    rows = [
        # surplus of style P in region X: on-hand 100 vs projected 40 -> +150 %
        ("X", "Store", "X", "P-1", "P", "Parka", "Outerwear", 100, 40.0, 2.0, 20),
        # shortage of the same style in region Y: 6 units at 7 a week -> 6 days
        ("Y", "Store", "Y", "P-1", "P", "Parka", "Outerwear", 6, 140.0, 7.0, 20),
        # balanced style: no decision
        ("X", "Store", "X", "B-1", "B", "Basic", "Knitwear", 50, 50.0, 2.5, 20),
        # thin business below the floors: no decision
        ("Y", "Store", "Y", "T-1", "T", "Thin", "Knitwear", 50, 1.0, 0.05, 20),
        # null region: dropped before the roll-up
        ("Z", "Store", None, "P-1", "P", "Parka", "Outerwear", 500, 40.0, 2.0, 20),
        # ecommerce row: not a store, ignored by the queue
        ("E", "Ecommerce", "X", "P-1", "P", "Parka", "Outerwear", 900, 1.0, 1.0, 20),
    ]
    return spark.createDataFrame(rows, SIG)


def test_overstock_and_stockout_name_the_pair(spark):
    got = {(r.decision_type, r.region_code, r.style_id): r
           for r in dq.overstock_stockout_rules(signals(spark), SC, floors(spark)).collect()}
    assert set(got) == {("Overstock", "X", "P"), ("Stockout", "Y", "P")}
    assert got[("Overstock", "X", "P")].metric_value == 150.0
    assert got[("Stockout", "Y", "P")].metric_value == 6.0
    assert got[("Stockout", "Y", "P")].headline == "Parka -- Y is expected to stock out within 6 days."


def test_returns_rule_fires_only_on_the_shift(spark):
    rows = []
    for w in range(300, 340):
        rows.append(("S1", "Shifty", "M", w, 20, 0.05 if w < 320 else 0.25))
        rows.append(("S2", "Flat", "M", w, 20, 0.10))
    sc = spark.createDataFrame(rows, "style_id string, style_name string, size string, week_id int, "
                                     "units_sold long, return_rate double")
    out = dq.returns_rule(sc, SC, floors(spark)).collect()
    assert [(r.style_id, r.style_name) for r in out] == [("S1", "Shifty (M)")]
    assert out[0].metric_value == 20.0


def test_queue_numbering_and_triage(spark):
    rules = dq.overstock_stockout_rules(signals(spark), SC, floors(spark))
    coh = spark.createDataFrame(
        [(i, SC.cohort_region, t, c, n) for i, (t, c, n) in enumerate(
            [("Gold", False, 2), ("Gold", False, 2), ("Gold", True, 5), ("Silver", True, 5)])],
        "customer_id long, home_region string, loyalty_tier string, is_cohort boolean, n_orders long")
    q = dq.decision_queue([rules, dq.cohort_rule(coh, SC, HIGH_TIERS)])
    rows = q.orderBy("decision_id").collect()
    assert [r.decision_id for r in rows] == ["DEC-0001", "DEC-0002", "DEC-0003"]
    assert [r.decision_type for r in rows] == ["Overstock", "Stockout", "Cohort Opportunity"]
    assert rows[2].metric_value == 2.5
    top = dq.triage(q, ["Parka"], n=2).collect()
    assert [r.decision_type for r in top] == ["Cohort Opportunity", "Overstock"]


def test_empty_queue_keeps_its_schema(spark):
    empty = spark.createDataFrame([], dq.QUEUE_SCHEMA)
    assert empty.schema == dq.QUEUE_SCHEMA
    assert dq.empty_approvals(spark).columns == ["action_id", "decision_id", "option_chosen", "approved_by",
                                                 "approved_at", "notes"]


def test_record_approval_appends_and_reads_latest(spark, scratch_dir):
    path = f"{scratch_dir}/approvals-test"
    dq.empty_approvals(spark).write.mode("overwrite").parquet(path)
    for opt in ("A", "B", "C", "A"):
        latest = dq.record_approval(spark, path, "DEC-0001", opt, "planner", "note").collect()
    assert len(latest) == 3
    assert spark.read.parquet(path).count() == 4
    assert all(r.action_id.startswith("ACT-") for r in latest)
