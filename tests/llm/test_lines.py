import random

import numpy as np
from pyspark.sql import functions as F

from shelfwise.llm import lines

LOWER = {i: i + 32 for i in range(65, 91)}
SPACE = " \t\n\v\f\r"


def brute(rows, min_chars=40, min_docs=5):
    key = lambda x: x.strip(SPACE).translate(LOWER)
    low = lambda i: -(1 << 63) if i is None else i
    held = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                held.setdefault(key(x), set()).add(low(i))
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        keep = [x for x in parts if not (len(held.get(key(x), ())) >= min_docs and max(held[key(x)]) != low(i))]
        out.append((i, len(parts), len(parts) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


def run(docs, **kw):
    out = lines.dedup_lines(docs, **kw)
    assert out.columns[:len(docs.columns)] == docs.columns
    n_lines, n_dropped = out.columns[-2:]
    return sorted([tuple(r) for r in out.select("doc_id", n_lines, n_dropped, "text").collect()], key=str)


def test_matches_brute_force_with_edges(docs_of):
    rng = random.Random(1)
    pool = [f"Shared Line number {i} with enough characters É to count" for i in range(6)] + ["short", "", "  ", "x" * 39, "é" * 40, "é" * 39]
    rows = [(i, "\n".join(rng.choice(["", " ", "\t"]) + (x.upper() if rng.random() < .3 and x.isascii() else x) + rng.choice(["", "\r"]) for x in rng.choices(pool, k=rng.randint(0, 6))))
            for i in range(40)]
    rows += [(None, pool[0]), (None, pool[1]), (7, None), (8, ""), (39, pool[2]), (39, pool[2]), (50, "\n".join([pool[3]] * 3000)), (51, "a" * 200000)]
    assert run(docs_of(rows)) == brute(rows)


def test_tiny_filters_stay_exact(docs_of):
    rows = [(i, f"a line that is unique to document {i:03d} {i:03d}\n" + "the very same line in all of the documents") for i in range(60)]
    assert run(docs_of(rows), filter_bits=1 << 12) == brute(rows)


def test_empty_table(docs_of):
    assert run(docs_of([])) == []


def test_bloom_pair_misses_no_repeat():
    p = lines.BloomPair(1 << 10)
    h = np.arange(1, 300, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    p.add(h[:200], h[:3])
    p.add(h[100:], h[:0])
    assert all(p.twice[s][np.r_[0:3, 100:200]].all() for s in lines._slots(h, p.bits))


def test_filter_broadcast_is_bounded(spark, docs_of):
    docs = docs_of([(i, f"line {i} " + "z" * 50) for i in range(500)]).select(F.col("doc_id"), "text")
    assert sum(map(len, lines.twice_seen(docs, 40, 1 << 16).values())) <= (1 << 16) // 8


def test_many_segments_and_any_bound_stay_exact(docs_of, monkeypatch):
    rows = [(i, f"a line that is unique to document {i:03d} {i:03d}\nthe very same line in all of the documents\n"
             + f"one of the seven lines that some documents share {i % 7}") for i in range(90)]
    want = brute(rows)
    assert sum(r[2] for r in want) == 89 + 90 - 7
    for bits in (6, 9):
        monkeypatch.setattr(lines, "segment_plan", lambda n: (bits, 1 << 10))
        for bound in (1 << 10, 1 << 28):
            assert run(docs_of(rows), filter_bits=bound) == want


def test_plan_follows_the_number_of_lines():
    assert lines.segment_plan(0) == (6, 1 << 10)
    for n in (10 ** 6, 10 ** 8, 10 ** 10, 10 ** 12):
        segment_bits, bits = lines.segment_plan(n)
        per = n / (1 << segment_bits)
        assert per <= lines.SEGMENT_KEYS and bits >= 8 * per and bits <= 1 << 24


def test_folded_filter_keeps_its_hashes():
    h = np.arange(1, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    p = lines.BloomPair(1 << 16)
    p.add(h, h[:50])
    small = lines.fold_sparse(p.twice)
    assert 64 <= len(small) < 1 << 12 and small.mean() < .25
    assert all(small[s][:50].all() for s in lines._slots(h, len(small)))
    assert np.logical_and.reduce([small[s] for s in lines._slots(h[50:], len(small))]).mean() < .05
    assert len(lines.fold_sparse(lines.BloomPair(1 << 10).twice)) == 0


def test_suspects_are_found_across_segments():
    h = np.arange(1, 3000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    seg, filters = lines._segments_of(h, 6), dict.fromkeys(range(64), b"")
    for s in range(0, 64, 2):
        p = lines.BloomPair(1 << 12)
        p.add(h[seg == s], h[:900][seg[:900] == s])
        filters[s] = lines._packed(lines.fold_sparse(p.twice))
    got = lines._suspected(lines.side_by_side(filters), h)
    assert got[:900][seg[:900] % 2 == 0].all() and not got[seg % 2 == 1].any() and got[900:].mean() < .05
