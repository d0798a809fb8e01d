"""Stream = batch, whatever the order in which files come in."""
import itertools
import os
import uuid
from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.oracle.compare import compare, duck
from shelfwise.plans import all_queries
from shelfwise.plans.q_stream import _universe
from shelfwise.sources.tables import read_table
from shelfwise.streaming import jobs, pos

from conftest import SF_SMALL

QUERIES, ORACLE = all_queries()


@pytest.fixture(autouse=True)
def few_state_stores(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ticks_and_live_state_match_batch(spark):
    con = duck(SF_SMALL)
    for name in ("t2_units_per_tick", "t7_live_listing_state", "t9_stock_alerts"):
        res = compare(QUERIES[name](spark, SF_SMALL), ORACLE[name], con)
        assert res["match"], (name, res)


def test_interleaved_and_late_files_match_batch(spark, scratch_dir, tmp_path):
    """Twelve files: events dealt in turn over eleven, each spanning all ticks, the oldest sales in the last."""
    events = read_table(spark, SF_SMALL, "events")
    cut = events.agg(F.expr("percentile_approx(event_id, 0.1)")).first()[0]
    folder = tmp_path / "events"
    parts = [events.where((F.col("event_id") > cut) & (F.col("event_id") % 11 == k)) for k in range(11)] + [events.where(F.col("event_id") <= cut)]
    for k, part in enumerate(parts):
        part.toPandas().astype({"ts": "datetime64[us]"}).to_parquet(_made(folder) / f"events{k:02d}.parquet", index=False)
        os.utime(folder / f"events{k:02d}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    con = duck(SF_SMALL)
    raw = jobs.run_listing_state(spark, str(folder))
    state = jobs.live_state(spark, raw, _universe(spark, SF_SMALL, raw.select("listing_id")))
    rounded = lambda df, *cols: df.withColumns({c: F.round(c, 6) for c in cols})
    panel = pos.hot_item_panel(state)
    for name, df in (("t7_live_listing_state", rounded(state, "trailing_velocity", "ticks_to_stockout")),
                     ("t8_hot_item_panel", rounded(panel, "velocity")), ("t9_stock_alerts", pos.stock_alerts(panel))):
        res = compare(df, ORACLE[name], con)
        assert res["match"], (name, res)


def test_ticks_of_ordered_files_match_batch(spark, tmp_path):
    """Several files in order: ticks that span two files are published again with their new totals."""
    events = read_table(spark, SF_SMALL, "events").toPandas().sort_values("ts").astype({"ts": "datetime64[us]"})
    folder = _made(tmp_path / "events")
    n = len(events) // 4 + 1
    for k in range(4):
        events.iloc[k * n:(k + 1) * n].to_parquet(folder / f"events{k}.parquet", index=False)
        os.utime(folder / f"events{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    got = jobs.run_units_per_tick(spark, str(folder)).withColumn("revenue", F.round("revenue", 6))
    assert compare(got, ORACLE["t2_units_per_tick"], duck(SF_SMALL))["match"]


def test_publisher_replays_and_compacts(spark, scratch_dir):
    pub = pos.StatePublisher(f"{scratch_dir}/publisher-{uuid.uuid4().hex}", compact_every=2)
    assert pub.current(spark) is None
    row = lambda i, n: spark.createDataFrame([(i, 0, n, 1, [1], [n])], pos.OUT_SCHEMA)
    for batch, df in enumerate([row(1, 1), row(2, 2), row(1, 3)]):
        pub(df, batch)
        pub(df, batch)  # a replayed batch changes nothing
    assert sorted((r.listing_id, r.cum_units) for r in pub.current(spark).collect()) == [(1, 3), (2, 2)]
    assert [e[1] for e in pub.entries(spark)] == ["delta", "delta", "full", "delta"]


def test_control_flag_and_phase(spark, tmp_path):
    p = tmp_path / "control.json"
    ticks = spark.range(3, 16).select(F.col("id").alias("tick"))
    phases = lambda: {r.tick: r.phase for r in pos.with_phase(ticks, pos.control_flag(spark, str(p))).collect()}
    assert set(phases().values()) == {"baseline"}
    p.write_text("{not json")
    assert set(phases().values()) == {"baseline"}
    p.write_text('{"triggered": true, "triggered_at_tick": 5}')
    got = phases()
    assert (got[4], got[5], got[12], got[13]) == ("baseline", "SPIKING", "SPIKING", "SETTLED")


def _land(frame, folder, parts, stamp=1_700_000_000):
    """The parts (row selections) of ``frame`` as files that land one after the other."""
    for k, part in enumerate(parts):
        at = _made(folder) / f"events{stamp}-{k:02d}.parquet"
        frame.loc[part].to_parquet(at, index=False)
        os.utime(at, (stamp + k, stamp + k))


def _events(spark, n=400):
    frame = read_table(spark, SF_SMALL, "events").toPandas().sort_values(["ts", "event_id"]).astype({"ts": "datetime64[us]"})
    return frame.head(n).reset_index(drop=True)


def _sessions_by_hand(frame, minutes=30):
    out, gap = [], timedelta(minutes=minutes)
    for user, rows in frame.sort_values("ts").groupby("user_id"):
        group = []
        for r in [*rows.itertuples(), None]:
            if group and (r is None or r.ts > group[-1].ts + gap):
                bought = [x for x in group if x.event_type == "purchase"]
                out.append((user, group[0].ts.to_pydatetime(), (group[-1].ts + gap).to_pydatetime(), len(group),
                            sum(1 + x.event_id % 3 for x in bought), round(sum(x.value for x in bought), 6)))
                group = []
            group.append(r)
    return sorted(out)


def test_sessions_do_not_depend_on_the_order_of_files(spark, tmp_path):
    """Twelve orders of three files, each with sessions that span files."""
    frame = _events(spark)
    frame["user_id"] = frame["user_id"] % 5  # long visits
    want = _sessions_by_hand(frame)
    assert max(w[3] for w in want) > 2
    for n, order in enumerate(list(itertools.permutations(range(3))) * 2):
        folder = tmp_path / f"events{n}"
        repeat = [order[0]] if n >= 6 else []  # half of the orders deliver a file again
        _land(frame, folder, [frame.index % 3 == k for k in [*order, *repeat]])
        got = jobs.run_visitor_sessions(spark, str(folder), lateness="31 days").collect()
        assert sorted((r.user_id, r.session_start, r.session_end, r.n_events, r.units, round(r.revenue, 6)) for r in got) == want, order


def test_sessions_of_no_events(spark, tmp_path):
    frame = _events(spark, 3)
    _land(frame, tmp_path / "events", [frame.index < 0])
    assert jobs.run_visitor_sessions(spark, str(tmp_path / "events")).collect() == []


def test_files_delivered_twice_count_once(spark, tmp_path):
    """Four files in order, the two-hour watermark of the ticker, and everything again: once right behind its first
    delivery, once at the end. Rows without an event_id are known by their columns."""
    frame = _events(spark, 600).astype({"event_id": "Int64"})
    frame.loc[::50, "event_id"] = None
    frame["value"] = frame["value"] + frame.index / 1000  # no equal rows
    parts = [frame.index // 150 == k for k in range(4)]
    _land(frame, tmp_path / "once", parts)
    _land(frame, tmp_path / "twice", [p for part in parts for p in (part, part)])
    _land(frame, tmp_path / "twice", parts, stamp=1_700_001_000)
    for run in (lambda f: jobs.run_units_per_tick(spark, f), lambda f: jobs.run_listing_state(spark, f)):
        once, twice = [sorted(map(tuple, run(str(tmp_path / name)).withColumn("revenue", F.lit(0)).collect())) for name in ("once", "twice")]
        assert once and once == twice


def _line(listing, hour, n=1):
    return {"ts": pd.Timestamp("2024-01-01") + pd.Timedelta(hours=hour), "user_id": listing, "event_type": "purchase", "value": 1.0, "props": None, "n": n}


def _feed(folder, batches):
    rows = [dict(r, batch=k) for k, batch in enumerate(batches) for r in batch for _ in range(r["n"])]
    frame = pd.DataFrame(rows).astype({"ts": "datetime64[us]"})
    frame.insert(0, "event_id", [3 * i for i in range(len(frame))])  # one unit each
    frame["props"] = frame["props"].astype("string")
    batch = frame.pop("batch")
    frame = frame.drop(columns="n")
    _land(frame, folder, [batch == k for k in range(len(batches))])


def _listings_in_state(spark, root):
    with jobs.rocksdb_state(spark):
        reader = spark.read.format("statestore").option("path", f"{root}/_checkpoint").option("operatorId", 0)
        return {r.key.listing_id for r in reader.option("stateVarName", "life").load().collect()}


def test_an_idle_listing_leaves_the_state_and_returns(spark, tmp_path, monkeypatch):
    roots = []
    real = jobs.scratch
    monkeypatch.setattr(jobs, "scratch", lambda s, name: roots.append(real(s, name)) or roots[-1])
    batches = [[_line(1, 0, 4), _line(2, 0)], [_line(2, 40)], [_line(2, 41)]]
    _feed(tmp_path / "idle", batches)
    raw = jobs.run_listing_state(spark, str(tmp_path / "idle"), lateness="1 hour", idle_ticks=12)
    assert {r.listing_id: r.cum_units for r in raw.collect()} == {1: 4, 2: 3}  # published rows stay
    assert _listings_in_state(spark, roots[-1]) == {2}
    _feed(tmp_path / "back", batches + [[_line(1, 42, 2)], [_line(1, 43)]])
    raw = jobs.run_listing_state(spark, str(tmp_path / "back"), lateness="1 hour", idle_ticks=12)
    one = {r.listing_id: r for r in raw.collect()}[1]
    hour = one.hist_ticks[-1]
    assert (one.cum_units, one.older_units, one.hist_ticks, one.hist_units, one.first_tick) == (7, 4, [hour - 1, hour], [2, 1], hour - 43)
    assert _listings_in_state(spark, roots[-1]) == {1, 2}


def test_a_hot_listing_is_folded_before_its_state(spark, tmp_path):
    """A listing with nine tenths of the events: the state task gets a row per task and tick, not per event."""
    _feed(tmp_path / "hot", [[_line(7, h, 900) for h in range(3)] + [_line(i, 1, 3) for i in range(100, 200)]])
    lines = pos.pos_lines(spark.read.schema(pos.EVENT_SCHEMA).parquet(str(tmp_path / "hot")))
    folded = lines.repartition(4, "event_id").select("listing_id", "tick", "units").mapInPandas(pos._fold, "listing_id long, tick long, units long")
    hot = folded.where("listing_id = 7")
    assert hot.count() <= 4 * 3 and hot.agg(F.sum("units")).first()[0] == 2700
    raw = {r.listing_id: r.cum_units for r in jobs.run_listing_state(spark, str(tmp_path / "hot")).collect()}
    assert raw[7] == 2700 and all(raw[i] == 3 for i in range(100, 200))


def test_batches_are_joined_to_the_stores_as_they_are_then(spark, tmp_path):
    """The store table is overwritten while the stream runs; the next micro-batch sees it."""
    stores, seen = str(tmp_path / "stores"), []

    def attributes(ids):
        name = f"name {len(seen)}"
        spark.createDataFrame([("S1", name)], "store_id string, name string").write.mode("overwrite").parquet(stores)
        seen.append(name)
        s = spark.read.parquet(stores).select(F.col("store_id").alias("location_id"), F.col("name").alias("store_name"))
        return ids.crossJoin(F.broadcast(s)).withColumn("store_tier", F.lit("A")).withColumn("sku_id", F.lit("K"))
    _feed(tmp_path / "feed", [[_line(1, 0), _line(2, 0)], [_line(2, 1)]])
    raw = jobs.run_listing_state(spark, str(tmp_path / "feed"), attributes=attributes)
    first, second = seen[:2]
    assert {r.listing_id: r.store_name for r in raw.collect()} == {1: first, 2: second}
    panel = pos.hot_item_panel(jobs.live_state(spark, raw, last_ticks=True)).collect()  # one store, under its newest name
    assert [(r.location_id, r.store_name, r.on_hand) for r in panel] == [("S1", second, 16 - 1 + 17 - 2)]


def test_retention_keeps_two_full_versions(spark, scratch_dir):
    root = f"{scratch_dir}/retention-{uuid.uuid4().hex}"
    pub = pos.StatePublisher(root, compact_every=10)
    row = lambda i, n, epoch: spark.createDataFrame([(i, 0, n, epoch, [epoch], [n], epoch)], pos.LIFE_SCHEMA)
    for batch in range(40):
        if batch == 20:
            reader = pub.current(spark)  # planned over the version of batch 19
        pub(row(batch % 3, batch + 1, batch // 20), batch)
        if batch == 29:
            assert len(reader.collect()) == 3  # still readable after the next full version
        assert len(pub.entries(spark)) <= 2 + 20
    kinds = [e[1] for e in pub.entries(spark)]
    assert (kinds.count("full"), kinds.count("delta")) == (2, 10)
    folders = sorted(x for x in os.listdir(root) if not x.startswith("_"))
    assert folders == [f"delta={b:08d}" for b in range(30, 40)] + ["full=00000029", "full=00000039"]
    # two lives of each listing: the last row of each life counts
    assert {r.listing_id: r.cum_units for r in pub.current(spark).collect()} == {0: 19 + 40, 1: 20 + 38, 2: 18 + 39}


def _made(path):
    path.mkdir(exist_ok=True)
    return path
