"""Weighted attribution of sales lines to customers (E13, W10) as a bucketed range join.

Per pool (region × capsule flag) each customer owns the interval
``[lo, hi)`` of the pool's cumulative weight; a line draws
``u = frac(line key) × pool total`` and goes to the customer whose interval
holds ``u``. Two distributed steps replace the reference's per-group
``rng.choice``:

* cumulative weights: a prefix sum per pool over customer-id buckets, then
  within each bucket (no window holds a whole pool);
* the range join: intervals are exploded into the value buckets they overlap
  and equi-joined to the line's value bucket, then filtered to the one
  interval that holds ``u`` (no nested loop, no pair enumeration).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import case_map
from ..params import LOYALTY_WEIGHT

ID_BUCKET = 1024          # customers per id bucket of the prefix sum
MEMBERS_PER_VALUE_BUCKET = 8


def unit_draw(orderkey: Column, linenumber: Column) -> Column:
    """Deterministic draw in [0, 1) from the line key: 52 bits of its MD5, exact in a double on every engine."""
    digest = F.md5(F.concat_ws("-", orderkey.cast("string"), linenumber.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / float(1 << 52)


def pool_members(customers: DataFrame, pools: DataFrame, cohort_region: str, repeat_lift: float,
                 capsule_lift: float) -> DataFrame:
    """Customers of each pool with their weight; a pool whose region has no customer draws from everyone."""
    base = case_map("loyalty_tier", LOYALTY_WEIGHT, 1.0)
    c = customers.select("customer_id", "home_region", "is_cohort", base.alias("w0"))
    regional = pools.join(c.select(F.col("home_region").alias("region_code")).distinct(), "region_code", "left_semi")
    fallback = pools.join(c.select(F.col("home_region").alias("region_code")).distinct(), "region_code", "left_anti")
    own = c.join(regional, c.home_region == regional.region_code).drop("home_region")
    fallback_list = fallback.agg(F.collect_list(F.struct("region_code", "is_capsule")).alias("p")).scalar()
    everyone = (c.select("*", F.explode(fallback_list).alias("pool")).select(
        "customer_id", "is_cohort", "w0", F.col("pool.region_code").alias("region_code"),
        F.col("pool.is_capsule").alias("is_capsule")))
    m = own.select("customer_id", "is_cohort", "w0", "region_code", "is_capsule").unionByName(everyone)
    w = F.col("w0")
    w = F.when((F.col("region_code") == cohort_region) & F.col("is_cohort"), w * repeat_lift).otherwise(w)
    w = F.when(F.col("is_capsule") & F.col("is_cohort"), w * capsule_lift).otherwise(w)
    return m.withColumn("weight", w).drop("w0")


def cumulative_intervals(members: DataFrame) -> DataFrame:
    """[lo, hi) per member in customer-id order, via bucket totals + in-bucket prefix sums."""
    pool = ["region_code", "is_capsule"]
    m = members.withColumn("id_bucket", F.floor(F.col("customer_id") / ID_BUCKET))
    totals = m.groupBy(*pool, "id_bucket").agg(F.sum("weight").alias("bucket_weight"),
                                               F.count(F.lit(1)).alias("bucket_members"))
    over_buckets = Window.partitionBy(*pool).orderBy("id_bucket")
    offsets = (totals
               .withColumn("bucket_lo", F.coalesce(F.sum("bucket_weight").over(
                   over_buckets.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
               .withColumn("pool_total", F.sum("bucket_weight").over(Window.partitionBy(*pool)))
               .withColumn("pool_members", F.sum("bucket_members").over(Window.partitionBy(*pool))))
    in_bucket = Window.partitionBy(*pool, "id_bucket").orderBy("customer_id")
    before = F.coalesce(F.sum("weight").over(in_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return (m.join(offsets, [*pool, "id_bucket"])
            .withColumn("lo", F.col("bucket_lo") + before)
            .withColumn("hi", F.col("lo") + F.col("weight")))


def attribute(lines: DataFrame, intervals: DataFrame) -> DataFrame:
    """Bucketed range join: each line gets the customer whose interval holds its draw.

    ``lines`` needs region_code, is_capsule, l_orderkey, l_linenumber.
    """
    pool = ["region_code", "is_capsule"]
    width = F.col("pool_total") / F.greatest(F.ceil(F.col("pool_members") / MEMBERS_PER_VALUE_BUCKET), F.lit(1))
    iv = (intervals.withColumn("vb_width", width)
          .withColumn("vb", F.explode(F.sequence(F.floor(F.col("lo") / F.col("vb_width")),
                                                 F.floor(F.col("hi") / F.col("vb_width")))))
          .select(*pool, "vb", "customer_id", "lo", "hi", "pool_total", "vb_width"))
    totals = iv.select(*pool, "pool_total", "vb_width").distinct()
    l = (lines.join(F.broadcast(totals), pool)
         .withColumn("u", unit_draw(F.col("l_orderkey"), F.col("l_linenumber")) * F.col("pool_total"))
         .withColumn("vb", F.floor(F.col("u") / F.col("vb_width")))
         .drop("pool_total", "vb_width"))
    j = l.join(iv.drop("pool_total", "vb_width"), [*pool, "vb"])
    return j.where((F.col("lo") <= F.col("u")) & (F.col("u") < F.col("hi"))).drop("vb", "lo", "hi")
