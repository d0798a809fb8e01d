"""Fiscal calendar as column expressions (F1-F9) and the week dimension."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import DEFAULT, Scenario


def _d(value: dt.date) -> Column:
    return F.lit(value).cast("date")


def week_of(date_col, sc: Scenario = DEFAULT, clip_upper: bool = True) -> Column:
    """date -> week id = floor(days since fiscal start / 7) + 1, clipped to 1..n_weeks.

    ``floor`` (not integer ``div``) so dates before the start land in week <= 0
    before the clip, as Python's ``//`` does.
    """
    days = F.datediff(F.col(date_col).cast("date") if isinstance(date_col, str) else date_col.cast("date"),
                      _d(sc.fiscal_start))
    w = (F.floor(days / F.lit(7.0)) + 1).cast("int")
    w = F.greatest(w, F.lit(1))
    if clip_upper:
        w = F.least(w, F.lit(sc.n_weeks))
    return w


def week_start(week_col, sc: Scenario = DEFAULT) -> Column:
    """week id -> Monday the week starts on."""
    w = F.col(week_col) if isinstance(week_col, str) else week_col
    return F.date_add(_d(sc.fiscal_start), ((w - 1) * 7).cast("int"))


def fiscal_year(d: Column) -> Column:
    """fiscal year label; a January week belongs to the year that began the previous February."""
    return F.concat(F.lit("FY"), (F.year(d) - F.when(F.month(d) < 2, 1).otherwise(0)).cast("string"))


def fiscal_season(d: Column) -> Column:
    """SS for February-July, FW otherwise."""
    return F.when(F.month(d).between(2, 7), F.lit("SS")).otherwise(F.lit("FW"))


def christmas_for(d: Column) -> Column:
    """Christmas the week counts down to; January weeks look back to the previous December."""
    return F.make_date(F.year(d) - F.when(F.month(d) == 1, 1).otherwise(0), F.lit(12), F.lit(25))


def days_to_christmas(d: Column) -> Column:
    """F5."""
    return F.datediff(christmas_for(d), d)


def is_holiday_week(ws: Column, we: Column) -> Column:
    """the week holds Christmas (as chosen by F5) or 29 November."""
    nov29 = F.make_date(F.year(ws), F.lit(11), F.lit(29))
    return christmas_for(ws).between(ws, we) | nov29.between(ws, we)


def with_calendar(weeks: DataFrame, sc: Scenario = DEFAULT) -> DataFrame:
    """Attach the calendar attributes (F2-F7) to a frame of ``week_id``."""
    ws = week_start("week_id", sc)
    return (weeks
            .withColumn("week_start_date", ws)
            .withColumn("week_end_date", F.date_add(F.col("week_start_date"), 6))
            .select(
                F.col("week_id").cast("int").alias("week_id"),
                "week_start_date", "week_end_date",
                fiscal_year(F.col("week_start_date")).alias("fiscal_year"),
                fiscal_season(F.col("week_start_date")).alias("fiscal_season"),
                F.month("week_start_date").alias("fiscal_month"),
                is_holiday_week(F.col("week_start_date"), F.col("week_end_date")).alias("is_holiday_week"),
                days_to_christmas(F.col("week_start_date")).alias("days_to_christmas"),
                _d(sc.as_of_date).between(F.col("week_start_date"), F.col("week_end_date")).alias("is_as_of_week"),
            ))


def dim_week(spark: SparkSession, sc: Scenario = DEFAULT) -> DataFrame:
    """The full week dimension 1..n_weeks (357 rows: a bounded dimension)."""
    return with_calendar(spark.range(1, sc.n_weeks + 1, numPartitions=1).withColumnRenamed("id", "week_id"), sc)
