"""Incremental refresh equals a full build and touches the changed weeks only."""
import os
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import engine as eng
from shelfwise.sources import incremental as inc

LINES = "location_id string, location_type string, region_code string, sku_id string, style_id string, week_id int, units int, revenue_cents long"


@pytest.fixture
def rows():
    rng = random.Random(8)
    return [(f"L{rng.randrange(3)}", "Store", "R", f"S{rng.randrange(6)}", "T", rng.randint(1, 12), rng.randint(1, 9), 100) for _ in range(400)]


def _files(path):
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")) for d in os.listdir(path) if d.startswith("week_id=")}


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


TABLES = {"sales": lambda part: part, "weekly": lambda part: eng.weekly_demand(part),
          "big": lambda part: part.where("units >= 8")}  # a table that may have no row of a changed week


def test_only_changed_weeks_are_rewritten(spark, tmp_path, rows):
    root, full = str(tmp_path / "layer"), str(tmp_path / "full")
    first = spark.createDataFrame([r for r in rows if r[5] not in (4, 9)], LINES)
    assert inc.refresh(first, root, TABLES) == ([w for w in range(1, 13) if w not in (4, 9)], [])
    before = {t: _files(f"{root}/{t}") for t in TABLES}
    more = spark.createDataFrame(rows, LINES)
    assert inc.refresh(more, root, TABLES) == ([4, 9], [])
    for t in TABLES:
        after = _files(f"{root}/{t}")
        assert {w: f for w, f in after.items() if w in before[t]} == before[t]
    inc.refresh(more, full, TABLES)
    for t in TABLES:
        assert _rows(spark.read.parquet(f"{root}/{t}")) == _rows(spark.read.parquet(f"{full}/{t}"))
    # the same lines in another order and partitioning change nothing
    assert inc.refresh(more.repartition(7).orderBy(F.rand(3)), root, TABLES) == ([], [])


def test_corrected_and_vanished_weeks(spark, tmp_path, rows):
    root, full = str(tmp_path / "layer"), str(tmp_path / "full")
    inc.refresh(spark.createDataFrame(rows, LINES), root, TABLES)
    fixed = [(*r[:6], 1, r[7]) if r[5] == 3 else r for r in rows if r[5] != 7]
    assert inc.refresh(spark.createDataFrame(fixed, LINES), root, TABLES) == ([3], [7])
    inc.refresh(spark.createDataFrame(fixed, LINES), full, TABLES)
    for t in TABLES:
        assert _rows(spark.read.parquet(f"{root}/{t}")) == _rows(spark.read.parquet(f"{full}/{t}"))
    assert not os.path.exists(f"{root}/big/week_id=3")


def test_a_refresh_that_died_is_repeated(spark, tmp_path, rows):
    root = str(tmp_path / "layer")
    lines = spark.createDataFrame(rows, LINES)

    def dies(part):
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        inc.refresh(lines, root, {"sales": TABLES["sales"], "m": dies})
    weeks, _ = inc.refresh(lines, root, TABLES)  # no marks were left, so every week is built again
    assert len(weeks) == 12 and _rows(spark.read.parquet(f"{root}/sales")) == _rows(lines)


def test_a_repeated_line_changes_its_week(spark, tmp_path, rows):
    root = str(tmp_path / "layer")
    inc.refresh(spark.createDataFrame(rows, LINES), root, {"sales": TABLES["sales"]})
    twice = rows + [next(r for r in rows if r[5] == 5)] * 2
    assert inc.refresh(spark.createDataFrame(twice, LINES), root, {"sales": TABLES["sales"]}) == ([5], [])
    assert spark.read.parquet(f"{root}/sales").count() == len(twice)


def test_inventory_goes_on_from_its_stored_weeks(spark, tmp_path, rows):
    path = str(tmp_path / "inventory")
    styles = spark.createDataFrame([("T", 1)], "style_id string, launch_week int")
    weekly = eng.weekly_demand(spark.createDataFrame(rows, LINES))
    plan = eng.listing_plan(weekly, styles)
    inc.refresh_inventory(plan, weekly, path, 1, 12)
    kept = {w: f for w, f in _files(path).items() if int(w.split("=")[1]) < 8}
    corrected = eng.weekly_demand(spark.createDataFrame([(*r[:6], r[6] + 3, r[7]) if r[5] == 8 else r for r in rows], LINES))
    inc.refresh_inventory(plan, corrected, path, 8, 12)
    assert {w: f for w, f in _files(path).items() if w in kept} == kept
    want = eng.resume(plan, corrected, 1, 12)
    got = spark.read.schema(want.schema).parquet(path)
    assert _rows(got) == _rows(want)
