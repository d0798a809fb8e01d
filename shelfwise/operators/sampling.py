"""Deterministic hash-ordered picks.

The reference draws from a seeded random generator; here the draw is an
ordering by ``md5(key || seed)``, which is reproducible on every engine and
needs no driver-side state. Picks are top-n sorts or ranks by slice of a group,
so the work stays distributed.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_key(cols: list[str], seed: int) -> Column:
    """md5 of the key columns and a seed: a stable pseudo-random sort key."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed))))


def hash_sample(df: DataFrame, n: int, key_cols: list[str], seed: int = 42) -> DataFrame:
    """N rows in hash order (sampled after any filter, N7). A top-n sort, not a driver loop."""
    return df.withColumn("_h", hash_key(key_cols, seed)).orderBy("_h").limit(n).drop("_h")


def stratified_pick(listings: DataFrame, group_col: str, key_cols: list[str], coverage: Column,
                    forced: Column | None = None, seed: int = 42) -> DataFrame:
    """Per group, the first floor(count × coverage) rows in hash order (at least 1), plus forced rows.

    ``coverage`` is a column (e.g. a tier lookup) evaluated per row of the group.
    """
    candidates = listings if forced is None else listings.where(~forced)
    # a group is ranked in slices by the first hex digits of the hash, so no task holds a whole group: a row's
    # rank is the size of the slices before its own (at most 256 per group) plus its rank inside its slice
    sliced = candidates.withColumn("_h", hash_key(key_cols, seed)).withColumn("_slice", F.substring("_h", 1, 2))
    sizes = sliced.groupBy(group_col, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    per_group = Window.partitionBy(group_col)
    offsets = sizes.select(
        group_col, "_slice", F.sum("_size").over(per_group).alias("_total"),
        F.coalesce(F.sum("_size").over(per_group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group_col, "_slice").orderBy("_h", *key_cols)
    picked = (sliced.withColumn("_place", F.row_number().over(inside)).join(offsets, [group_col, "_slice"])
              .where(F.col("_before") + F.col("_place") <= F.greatest(F.floor(F.col("_total") * coverage), F.lit(1)))
              .select(*listings.columns))
    if forced is None:
        return picked
    return picked.unionByName(listings.where(forced))


def disjoint_slices(df: DataFrame, key_cols: list[str], sizes: dict[str, int], seed: int = 42) -> DataFrame:
    """Label consecutive hash-ordered slices (first n, next m, ...); rows past the last slice are dropped.

    A top-n in hash order leaves as many rows as the slices hold; only those are ranked.
    """
    first = df.orderBy(hash_key(key_cols, seed), *key_cols).limit(sum(sizes.values()))
    ranked = first.withColumn("_rank", F.row_number().over(Window.orderBy(hash_key(key_cols, seed), *key_cols)))
    label, lo = None, 0
    for name, n in sizes.items():
        cond = F.col("_rank").between(lo + 1, lo + n)
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
        lo += n
    return ranked.withColumn("slice", label).where(F.col("slice").isNotNull()).drop("_rank")


def audience(customers: DataFrame, segment_col: str, segment: str | None, n: int, min_pool: int = 100,
             key: str = "customer_id", seed: int = 42) -> DataFrame:
    """Campaign audience: the segment's pool, or everyone when the pool is under ``min_pool``;
    then the first n customers in hash order.

    The pool size is a distributed count; the fallback is a two-branch union
    chosen by that count, not a driver-side branch.
    """
    if segment is None:
        pool = customers
    else:
        seg = customers.where(F.col(segment_col) == segment)
        size = seg.select(F.count(F.lit(1))).scalar()
        pool = seg.where(size >= min_pool).unionByName(customers.where(size < min_pool))
    return hash_sample(pool, n, [key], seed)
