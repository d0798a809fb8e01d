"""Connected components by alternating large-star and small-star rounds, each written to the shared folder."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the smallest node in reach of u."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Smaller neighbours of u, and u itself, are linked to the smallest of them (edges run from larger to smaller)."""
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of ``edges`` (u long, v long); root is the smallest node of its component."""
    e = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    state = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            break
        state = now
        e = staged(_small_star(_large_star(e)), "cc")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v")).distinct()
