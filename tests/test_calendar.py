"""Calendar edges (F1-F7, E1) against a plain-Python statement of the same rules."""
import datetime as dt

from pyspark.sql import functions as F

from shelfwise.functions import calendar as cal
from shelfwise.params import DEFAULT as SC


def py_week(d):
    w = (d - SC.fiscal_start).days // 7 + 1
    return min(max(w, 1), SC.n_weeks)


def test_week_of_clips_and_floors(spark):
    dates = [dt.date(1994, 12, 25), dt.date(1995, 1, 1), dt.date(1995, 1, 2), dt.date(1995, 1, 8),
             dt.date(1995, 1, 9), SC.as_of_date, dt.date(2001, 11, 4), dt.date(2010, 1, 1)]
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    got = [r.w for r in df.select(cal.week_of("d").alias("w")).collect()]
    assert got == [py_week(d) for d in dates]
    assert py_week(SC.as_of_date) == 336 == SC.as_of_week


def test_calendar_attributes(spark):
    wk = {r.week_id: r for r in cal.dim_week(spark).collect()}
    assert len(wk) == SC.n_weeks
    for w, r in wk.items():
        ws = SC.fiscal_start + dt.timedelta(weeks=w - 1)
        we = ws + dt.timedelta(days=6)
        xmas = dt.date(ws.year - (1 if ws.month == 1 else 0), 12, 25)
        assert r.week_start_date == ws and r.week_end_date == we
        assert r.fiscal_year == (f"FY{ws.year}" if ws.month >= 2 else f"FY{ws.year - 1}")
        assert r.fiscal_season == ("SS" if 2 <= ws.month <= 7 else "FW")
        assert r.days_to_christmas == (xmas - ws).days
        assert r.is_holiday_week == ((ws <= xmas <= we) or (ws <= dt.date(ws.year, 11, 29) <= we))
        assert r.is_as_of_week == (ws <= SC.as_of_date <= we)
    assert sum(r.is_as_of_week for r in wk.values()) == 1
    # January weeks look back to the previous Christmas and belong to the previous fiscal year
    jan = [r for r in wk.values() if r.week_start_date.month == 1]
    assert all(r.days_to_christmas < 0 for r in jan)
    assert any(r.is_holiday_week for r in wk.values() if r.week_start_date.month == 11)


def test_week_start_roundtrip(spark):
    df = spark.range(1, 30).withColumnRenamed("id", "w")
    rows = df.select("w", cal.week_of(cal.week_start("w")).alias("back")).collect()
    assert all(r.w == r.back for r in rows)
