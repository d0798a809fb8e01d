import hashlib
import random

from shelfwise.llm import warc


def brute(rows, min_bytes=1000):
    low = lambda i: (i is not None, i or 0)
    first = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= min_bytes:
            first[p] = max(first.get(p, i), i, key=low)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        again = first.get(p, i) is not None and p in first and first[p] != i
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", first[p] if again else None))
    return sorted(out, key=str)


def pages():
    rng = random.Random(7)
    nasty = ["", None, "\r\n\r\n", "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nxx", "x\r", "x\r\n", "\r\n" * 700, "é" * 600, "\r\n\r\n" * 300 + "end\r\n\r\n", "z" * 999, "z" * 1000, "\x00\n" * 600]
    urls = ["http://www.Example.com/a?b=1", "https://sub.example.com:8080/x", "no url", None, "http://h/%0D%0A x\r\ny", "http://[bad"]
    rows = [(i, rng.choice(urls), rng.choice(nasty)) for i in range(150)]
    return rows + [(None, urls[0], nasty[8]), (None, None, "q" * 2000), (None, None, "q" * 2000), (149, urls[0], rows[149][2]), (200, urls[1], "long " * 400000)]


def test_round_trip_and_revisits(spark):
    rows = pages()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, size int")
    out = warc.archive(df)
    got = out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows)
    assert sorted([(r.page_id, r.url) for r in out.collect()], key=str) == sorted([(i, u or "") for i, u, _ in rows], key=str)


def test_index_is_globally_ordered(spark, scratch_dir):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string").repartition(5)
    path = f"{scratch_dir}/warc-order"
    warc.write_warc(warc.plan_records(df), path)
    rows = [(r.url_key, r.ts, r.page_id is not None, r.page_id or 0) for r in warc.read_index(spark, path).collect()]
    assert len(rows) == len(pages()) and rows == sorted(rows, key=lambda r: (r[0].encode(), *r[1:]))


def test_many_passes_with_tiny_blocks(spark, scratch_dir, monkeypatch):
    monkeypatch.setattr(warc, "RUN", 3)
    df = spark.createDataFrame(pages(), "page_id long, url string, html string").repartition(4)
    path = f"{scratch_dir}/warc-passes"
    warc.write_warc(warc.plan_records(df), path)
    runs = warc.staged(warc.fill_sizes(warc.read_runs(spark, path)), "runs")
    # runs of three rows, whichever worker wrote them
    runs = runs.selectExpr("*", "floor(seq / 3) as part").selectExpr(*[c for c in runs.columns if c not in ("run", "seq")], "concat(run, '-', part) as run", "cast(seq % 3 as int) as seq")
    assert runs.where("seq = 0").count() >= 50 and warc.merge_passes(50, 2) == 5
    for fan_in, block, range_rows in ((2, 1, 1000), (3, 2, 40)):
        got = [tuple(r) for r in warc.merge_runs(runs, fan_in, block, range_rows).collect()]
        keys = [warc._order(r) for r in got]
        assert keys == sorted(keys)
        assert sorted(got, key=str) == sorted([tuple(r)[:8] for r in runs.select(*[c.split()[0] for c in warc.INDEX.split(", ")]).collect()], key=str)


def test_archive_is_globally_ordered_with_sizes(spark):
    out = warc.archive(spark.createDataFrame(pages(), "page_id long, url string, html string").repartition(5)).collect()
    keys = [warc._order(r) for r in out]
    assert keys == sorted(keys) and {r.record_type for r in out} == {"response", "revisit"}
    assert all(r.payload_bytes is not None for r in out)


def test_merge_of_blocks_in_order_of_first_keys():
    rng = random.Random(9)
    row = lambda i: (f"k{i:05d}", "t", i, "u", "response", 1, "d", None)
    runs = [sorted(rng.choices(range(400), k=rng.randint(1, 300))) for _ in range(6)]
    blocks = [(r, no, b) for r, ids in enumerate(runs) for no, b in enumerate(warc._batches(map(row, ids), 8))]
    blocks.sort(key=lambda x: (x[2].column(0)[0].as_py(), x[0], x[1]))
    merged = warc._merged(((r, b.serialize().to_pybytes()) for r, _, b in blocks), 6)
    assert [r[2] for r in merged] == sorted(i for ids in runs for i in ids)


def test_merge_passes():
    assert [warc.merge_passes(n, 4) for n in (0, 1, 4, 5, 16, 17, 64, 65)] == [0, 0, 0, 1, 1, 2, 2, 3]


def test_loser_tree_merges():
    rng = random.Random(8)
    for k in range(0, 12):
        runs = [sorted(rng.choices(range(50), k=rng.randint(0, 9))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_empty(spark):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
