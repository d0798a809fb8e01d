import hashlib
import math
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import resample as R


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def features(text, max_n):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, max_n=1, buckets=10_000, min_words=20, percent=10):
    at = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for texts, sums in ((docs, s), (target, t)):
        for _, text in texts:
            for f in features(text, max_n):
                sums[at(f)] += 1
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[k] + 1) * (big_s + buckets) / ((s[k] + 1) * (big_t + buckets)))) for k in range(buckets)]
    rows = []
    for doc_id, text in docs:
        f = features(text, max_n)
        weight = sum(gain[at(x)] for x in f)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    pool = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(pool[:percent * len(pool) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=str)


def run(docs, target, **kw):
    return sorted(map(tuple, R.resample(docs, target, **kw).collect()), key=str)


def sample(rng, n):
    pool = [f"word{i}" for i in range(200)] + ["Ünï", "日本", "A1b", "x" * 1500]
    return [(i, " ".join(rng.choices(pool, k=rng.choice([0, 3, 19, 20, 60]))) + rng.choice(["", ".", "\n", "!?"])) for i in range(n)]


def test_matches_brute_force_with_edges(docs_of):
    rng = random.Random(1)
    docs = sample(rng, 80) + [(None, "null id " * 15), (None, None), (500, None), (501, ""), (502, " ,;"), (7, "again " * 30), (7, "again " * 30),
                              (600, "same text for all " * 6), (601, "same text for all " * 6), (602, "very long text " * 60000)]
    target = sample(rng, 6) + [(1, None)]
    for kw in ({}, {"max_n": 3, "buckets": 97, "percent": 40, "min_words": 3}, {"percent": 100, "min_words": 0}, {"percent": 0}):
        assert run(docs_of(docs), docs_of(target), **kw) == brute(docs, target, **kw)


def test_an_inexact_quantile_loses_no_rank(docs_of):
    docs = sample(random.Random(3), 120)
    assert run(docs_of(docs), docs_of(docs[:3]), accuracy=2, percent=60) == brute(docs, docs[:3], percent=60)


def test_empty_tables(docs_of):
    assert run(docs_of([]), docs_of([(1, "a b")])) == []
    docs = [(i, "few words of text " * 8) for i in range(30)]
    assert run(docs_of(docs), docs_of([])) == brute(docs, [])


def test_drawn_documents_keep_their_columns(docs_of):
    docs = docs_of(sample(random.Random(2), 60))
    picked = R.resample(docs, docs.limit(4), percent=30, min_words=3)
    got = R.drawn_documents(docs, picked)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in picked.collect() if r["rank"]}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=60))
def test_matrices_equal_the_plain_crc(features):
    features += [b"z" * R.LONG, b"y" * (R.LONG + 1)]
    assert R.crc32_matrices(features).tolist() == [zlib.crc32(f) for f in features]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aB1 .é日", max_size=80), st.integers(1, 9), st.integers(1, 4))
def test_blocks_lose_no_feature(text, size, max_n):
    n, counts = R.feature_counts(text, max_n, size)
    want = {}
    for f in features(text, max_n):
        want[f.encode()] = want.get(f.encode(), 0) + 1
    assert n == len(words(text)) and dict(counts) == want
