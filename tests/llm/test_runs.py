import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import runs as R


def plain_lyndon(x):
    """From each place to the next smaller suffix."""
    return [next((j for j in range(i + 1, len(x)) if x[j:] < x[i:]), len(x)) - i for i in range(len(x))]


def brute_runs(x, periods, shortest):
    found = {}
    for q in range(1, len(x) // periods + 1):
        i = 0
        while i + q < len(x):
            start = i
            while i + q < len(x) and x[i] == x[i + q]:
                i += 1
            length = i - start + q
            if length >= max(shortest, periods * q):
                found.setdefault((start, length), q)  # the smallest period comes first
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def split(text):
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(rows, periods=4, shortest=6):
    out = []
    for doc_id, text in rows:
        w = split(text or "")
        r = brute_runs(w, periods, shortest)
        best = min(r, key=lambda x: (-x[1], x[0], x[2])) if r else (None,) * 3
        gone = {i for s, n, q in r for i in range(s + q, s + n)}
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        out.append((doc_id, len(r), *best, 1000 * best[1] // best[2] if r else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in r)),
                    sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=str)


symbols = st.lists(st.integers(0, 3), max_size=50) | st.builds(
    lambda a, b, n, c: a + b * n + c, st.lists(st.integers(0, 2), max_size=8), st.lists(st.integers(0, 2), min_size=1, max_size=6),
    st.integers(1, 9), st.lists(st.integers(0, 2), max_size=8))


@settings(max_examples=400, deadline=None)
@given(symbols)
def test_grouping_gives_the_lyndon_array(x):
    assert R.lyndon_array(x) == plain_lyndon(x)


@settings(max_examples=400, deadline=None)
@given(symbols, st.sampled_from([(4, 6), (2, 2), (3, 1), (5, 12)]))
def test_runs_equal_brute_force(x, rule):
    assert R.runs_of(np.array(x, np.int64), *rule) == brute_runs(x, *rule)


@settings(max_examples=200, deadline=None)
@given(st.lists(symbols, min_size=1, max_size=4))
def test_cutting_at_rare_words_loses_no_run(texts):
    got = R.text_runs([" ".join(f"w{v}" for v in x) for x in texts], 4, 6)
    assert [r for _, r in got] == [brute_runs(x, 4, 6) for x in texts]


def _rows():
    rng = random.Random(4)
    rows = []
    for i in range(120):
        w = rng.choices(["a", "b", "C", "é", "日本", "x y"], k=rng.randint(0, 60))
        if rng.random() < 0.6 and w:
            unit = w[:rng.randint(1, 5)]
            w += unit * rng.randint(2, 8)
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(w)))
    return rows + [(None, "a " * 7), (None, None), (500, None), (501, ""), (502, " \n "), (7, "b c " * 9), (7, "b c " * 9), (503, "one two three " * 300),
                   (504, "x" * 300000)]


def test_queries_rows_match_brute_force(docs_of):
    rows = _rows()
    assert sorted(map(tuple, R.find_runs(docs_of(rows)).collect()), key=str) == brute(rows)
    assert sorted(map(tuple, R.find_runs(docs_of(rows), 2, 2).collect()), key=str) == brute([r for r in rows], 2, 2)


def test_a_very_long_text_is_one_run(docs_of):
    r, = R.find_runs(docs_of([(1, "first " + "one two three " * 30000)]), with_text=True).collect()
    assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.collapsed) == (1, 1, 90000, 3, 30000000, "first one two three")


def test_texts_and_runs_are_returned(docs_of):
    r, = R.find_runs(docs_of([(1, "see a b a b a b a b end")]), with_text=True).collect()
    assert [tuple(x) for x in r.runs] == [(1, 8, 2)] and r.collapsed == "see a b end"


def test_planted_tails_follow_the_rule(docs_of):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 37))) for i in range(300)] + [(20, None), (None, "a b")]
    got = sorted((r.doc_id, split(r.text or "")) for r in R.with_planted_tails(docs_of(rows)).collect() if r.doc_id is not None)
    want = []
    for i, text in rows:
        w, h = split(text or ""), zlib.crc32(str(i).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n and i is not None:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (k - a) % p] if k >= a else w[k] for k in range(n)]
        want.append((i, w))
    assert got == sorted((x for x in want if x[0] is not None))


def test_empty_table(docs_of):
    assert R.find_runs(R.with_planted_tails(docs_of([]))).collect() == []
