"""Weighted attribution (E13): bucketed range join equals a brute-force interval lookup."""
import bisect
import hashlib
import random

from pyspark.sql import functions as F

from shelfwise.operators import attribution as attr


def test_bucketed_range_join_matches_brute_force(spark):
    random.seed(7)
    tiers = ["None", "Silver", "Gold", "Platinum", "Private Client"]
    cust = [(i, random.choice(["A", "B"]), random.choice(tiers), random.random() < 0.2) for i in range(3000)]
    cdf = spark.createDataFrame(cust, "customer_id long, home_region string, loyalty_tier string, is_cohort boolean")
    lines = [(k, ln, random.choice(["A", "B", "C"]), random.random() < 0.3) for k in range(800) for ln in (1, 2)]
    ldf = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, region_code string, is_capsule boolean")
    pools = ldf.select("region_code", "is_capsule").distinct()
    members = attr.pool_members(cdf, pools, "A", 2.0, 1.5)
    got = {(r.l_orderkey, r.l_linenumber): r.customer_id
           for r in attr.attribute(ldf, attr.cumulative_intervals(members)).collect()}
    assert len(got) == len(lines)  # every line gets exactly one customer

    lw = {"None": 1.0, "Silver": 1.5, "Gold": 2.0, "Platinum": 3.0, "Private Client": 3.5}

    def pool_of(region, cap):
        m = [c for c in cust if c[1] == region] or cust   # empty region -> everyone
        out = []
        for cid, home, tier, coh in sorted(m):
            w = lw[tier]
            if region == "A" and coh:
                w *= 2.0
            if cap and coh:
                w *= 1.5
            out.append((cid, w))
        return out

    for (k, ln, region, cap) in lines:
        pool = pool_of(region, cap)
        cum, acc = [], 0.0
        for _, w in pool:
            cum.append(acc)
            acc += w
        u = int(hashlib.md5(f"{k}-{ln}".encode()).hexdigest()[:13], 16) / 2 ** 52 * acc
        i = bisect.bisect_right(cum, u) - 1
        assert got[(k, ln)] == pool[i][0]


def test_draws_of_large_keys_reach_a_large_pool(spark):
    """Three million order keys beyond 4e9 neither overflow nor repeat their draw, and reach two million members
    as evenly as independent draws would (1 - exp(-1.5) = 77.7 % of them)."""
    lines = spark.range(4_000_000_000, 4_003_000_000).selectExpr("id AS l_orderkey", "1 AS l_linenumber")
    u = attr.unit_draw(F.col("l_orderkey"), F.col("l_linenumber"))
    got = lines.select(u.alias("u"), F.floor(u * 2_000_000).alias("member")).agg(
        F.countDistinct("u").alias("draws"), F.countDistinct("member").alias("members"), F.min("u").alias("low"), F.max("u").alias("high")).first()
    assert got.draws > 2_999_900 and 1_550_000 < got.members < 1_557_500 and 0 <= got.low and got.high < 1
