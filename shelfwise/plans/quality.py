"""Data-quality checks as rows.

Every check is a small DataFrame ``(check, level, observed, bound, ok)``;
the report is their union. Counts are distributed aggregates (anti-joins and
filtered counts); nothing but the final handful of rows reaches the driver.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_COLS = ["check", "level", "observed", "bound", "ok"]


def check_row(agg: DataFrame, name: str, level: str, observed: Column, bound: float, ok: Column) -> DataFrame:
    """One report row from a one-row aggregate frame."""
    return agg.select(F.lit(name).alias("check"), F.lit(level).alias("level"),
                      observed.cast("double").alias("observed"), F.lit(float(bound)).alias("bound"),
                      F.coalesce(ok, F.lit(False)).alias("ok"))


def orphans(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
            where: Column | None = None) -> DataFrame:
    """V3: child rows whose non-null key has no parent (NOT EXISTS as a left-anti join)."""
    c = child.where(F.col(child_col).isNotNull())
    if where is not None:
        c = c.where(where)
    p = parent.select(F.col(parent_col).alias("_pk")).distinct()
    return c.join(p, F.col(child_col) == F.col("_pk"), "left_anti")


def referential_integrity(rules: list[tuple]) -> DataFrame:
    """V3: ``rules`` = [(name, child, child_col, parent, parent_col, where|None)] -> one row per rule."""
    out = None
    for name, child, ccol, parent, pcol, where in rules:
        agg = orphans(child, ccol, parent, pcol, where).agg(F.count(F.lit(1)).alias("n"))
        row = check_row(agg, name, "fail", F.col("n"), 0, F.col("n") == 0)
        out = row if out is None else out.unionByName(row)
    return out


def no_negative(df: DataFrame, column: str, name: str) -> DataFrame:
    """V4: count of rows with a negative value."""
    agg = df.where(F.col(column) < 0).agg(F.count(F.lit(1)).alias("n"))
    return check_row(agg, name, "fail", F.col("n"), 0, F.col("n") == 0)


def at_least(df: DataFrame, value: Column, name: str, bound: float, level: str = "fail") -> DataFrame:
    """V5: an aggregate (e.g. max of a filtered set, A7) must reach ``bound``."""
    agg = df.agg(value.alias("v"))
    return check_row(agg, name, level, F.col("v"), bound, F.col("v") >= bound)


def row_count_band(df: DataFrame, name: str, lo: float, hi: float) -> DataFrame:
    """V2: soft check that a table's row count lies in [lo, hi]; the bound column shows lo."""
    agg = df.agg(F.count(F.lit(1)).alias("n"))
    return check_row(agg, name, "warn", F.col("n"), lo, F.col("n").between(lo, hi))


def report(checks: list[DataFrame]) -> DataFrame:
    """V6: all check rows in one frame; ``level`` tells hard failures from soft warnings."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def missing_tables(spark: SparkSession, database: str, expected: list[str]) -> DataFrame:
    """V1 + S14 + U2: expected table names absent from a catalog database (expected − present)."""
    present = [t.name for t in spark.catalog.listTables(database)]
    exp = spark.createDataFrame([(t,) for t in expected], "table_name string")
    have = spark.createDataFrame([(t,) for t in present], "table_name string")
    return exp.join(have, "table_name", "left_anti")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, as one frame (one distributed count per table, unioned)."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out
