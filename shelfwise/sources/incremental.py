"""Incremental layers (S2, S5, S8): only the weeks whose lines changed are rebuilt.

A week's mark is the number of its lines and the sum of their 64-bit hashes, so it does not depend on order or
partitioning. The marks of the last refresh lie beside the tables (a row per week). A refresh compares them with
the marks of the lines as they are now, rebuilds the week partitions that differ by dynamic partition overwrite,
deletes those of weeks without lines, and writes the new marks last: a refresh that dies is repeated by the next
one, and lost marks only mean that every week is rebuilt. Each partition is replaced as a whole, so writing a part
again leaves the same table.

Tables that depend on one week's lines alone (sales lines, weekly demand, M1) follow from the changed weeks.
Inventory depends on all weeks before: it is rebuilt from the first changed week on, for a fixed supply plan, from
the closing state that its stored rows of the three weeks before hold.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import engine as eng
from .tables import write_table

MARKS = "week_id int, n_lines long, mark decimal(38,0)"


def week_marks(lines: DataFrame) -> DataFrame:
    """One row per week: its number of lines and a mark of their content."""
    return lines.groupBy(F.col("week_id").cast("int").alias("week_id")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.xxhash64(*sorted(lines.columns)).cast("decimal(38,0)")).cast("decimal(38,0)").alias("mark"))


def stored(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at ``path``; an empty one where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def changed_weeks(now: DataFrame, before: DataFrame) -> tuple[list[int], list[int]]:
    """Weeks to rebuild and weeks that lost all their lines; both arguments have a row per week of the calendar."""
    new, old = ({r.week_id: (r.n_lines, r.mark) for r in marks.collect()} for marks in (now, before))
    return sorted(w for w in new if new[w] != old.get(w)), sorted(old.keys() - new.keys())


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def rewrite_weeks(df: DataFrame, path: str, weeks: list[int], gone: list[int] = ()) -> None:
    """Replace the ``weeks`` of a table partitioned by week_id with the rows of ``df``, which holds these weeks;
    drop the partitions of ``gone`` and of weeks that ``df`` has no rows of."""
    spark, written = df.sparkSession, []
    if weeks and not df.isEmpty():
        seen = Observation()
        (df.observe(seen, F.collect_set("week_id").alias("weeks")).hint("rebalance", "week_id").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("week_id").parquet(path))
        written = seen.get["weeks"]
    for week in [*gone, *(w for w in weeks if w not in written)]:
        _delete(spark, f"{path}/week_id={week}")


def refresh(lines: DataFrame, root: str, tables: dict[str, Callable[[DataFrame], DataFrame]]) -> tuple[list[int], list[int]]:
    """Bring the week-partitioned ``tables`` below ``root`` up to date with ``lines``; returns the weeks rebuilt and
    the weeks dropped. A table's function gets the lines of the changed weeks and must use no others."""
    spark, root = lines.sparkSession, root.rstrip("/")
    now = spark.createDataFrame(week_marks(lines).collect(), MARKS)  # a row per week
    weeks, gone = changed_weeks(now, stored(spark, f"{root}/_marks", MARKS))
    if weeks or gone:
        part = lines.where(F.col("week_id").isin(weeks))
        for name, build in tables.items():
            rewrite_weeks(build(part), f"{root}/{name}", weeks, gone)
        write_table(now, f"{root}/_marks")
    return weeks, gone


def refresh_inventory(plan: DataFrame, weekly: DataFrame, path: str, first_week: int, last_week: int) -> None:
    """E9 + M2: rebuild the stored engine rows of the weeks from ``first_week`` on, for a fixed supply plan.

    A listing that is active in that week has a row in every week of its window before it, so the stored rows of the
    three weeks before hold its closing state."""
    spark = plan.sparkSession
    opening = None
    if first_week > 1:
        keys = "location_id string, sku_id string, week_id int, cum_demand long, realized_cum_sales double, realized_sales int"
        before = stored(spark, path, keys).where(F.col("week_id").between(first_week - 3, first_week - 1))
        opening = eng.closing_state(before)
    rows = eng.resume(plan, weekly, first_week, last_week, opening)
    staged = f"{path}/_staged-{first_week}"  # the opening reads the table that is rewritten
    rows.write.mode("overwrite").parquet(staged)
    rewrite_weeks(spark.read.parquet(staged), path, list(range(first_week, last_week + 1)))
    _delete(spark, staged)
