import random

import numpy as np
import pytest
import xxhash

from shelfwise.llm import simhash


def brute(rows):
    def fp(t):
        w = (t or "").encode().lower().split()
        grams = [b" ".join(w[i:i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    fps = [fp(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                comp[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted([(d, fps[i], low.get(root(i))) for i, (d, _) in enumerate(rows)], key=str)


def test_components_match_brute_force(docs_of):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdeéF", k=3))
    rows, n = [], 0
    for _ in range(12):
        base = [word() for _ in range(rng.choice([1, 2, 3, 60, 200]))]
        for _ in range(rng.randint(1, 8)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = word()
            rows.append((n, rng.choice([" ", "\t", "\n "]).join(w)))
            n += 1
    rows += [(500, None), (501, ""), (502, " \n"), (None, "only null id here"), (None, rows[0][1]), (3, rows[3][1]), (3, rows[3][1]), (600, "w " * 50000)]
    got = simhash.simhash_components(docs_of(rows)).collect()
    assert sorted([(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got], key=str) == brute(rows)


def test_crowded_bucket_in_chunks(spark):
    rng = np.random.default_rng(0)
    base, weak = int(rng.integers(1 << 62)), rng.choice(64, 12, replace=False)
    near = {base ^ sum(1 << int(b) for b in weak[rng.random(12) < 0.4]) for _ in range(600)} | {int(x) for x in rng.integers(1 << 62, size=300)}
    near = [x - (1 << 64) if x >> 63 else x for x in near]
    fps = spark.createDataFrame([(x,) for x in near], "fp long")
    got = {}
    for r in simhash.components(simhash.links(fps, 3, chunk=50)).collect():
        got[r.node] = r.root
    u = np.array(near, np.int64).view(np.uint64)
    adj = np.bitwise_count(u[:, None] ^ u[None, :]) <= 3
    seen, want = set(), []
    for i in range(len(near)):
        if i not in seen:
            todo, group = [i], {i}
            while todo:
                for j in np.flatnonzero(adj[todo.pop()]).tolist():
                    if j not in group:
                        group.add(j)
                        todo.append(j)
            seen |= group
            want.append(frozenset(near[j] for j in group))
    have = {}
    for x in near:
        have.setdefault(got.get(x, x), set()).add(x)
    assert {frozenset(v) for v in have.values()} == set(want)


def test_near_dedup_keeps_one_and_columns(docs_of):
    docs = docs_of([(1, "a b c d e f"), (2, "a b c d e f"), (3, "other words entirely different here"), (None, "a b c d e f")])
    out = simhash.near_dedup(docs)
    assert out.columns == docs.columns
    assert sorted([r.doc_id for r in out.collect()], key=str) == sorted([1, 3, None], key=str)


def test_near_dedup_keeps_one_row_of_a_group(docs_of):
    copy, other, third = "a b c d e f", "other words entirely different here", "yet another text that nobody has written before"
    # repeated rows of 1; 4 is kept for one group and shares its id with a row of another
    docs = docs_of([(1, copy), (1, copy), (1, "A  B c d e f"), (2, copy), (4, other), (5, other), (5, third), (6, third), (4, copy)])
    got = [(r.doc_id, r.text.lower().split()) for r in simhash.near_dedup(docs).collect()]
    assert sorted(got) == [(1, copy.split()), (4, other.split()), (5, third.split())]
    assert simhash.near_dedup(docs_of([(7, None), (7, ""), (7, " ")])).count() == 1


def test_empty(docs_of):
    assert simhash.simhash_components(docs_of([])).count() == 0


@pytest.mark.parametrize("n", [2, 3, 40])
def test_pivots_never_discard_a_link(n):
    rng = np.random.default_rng(n)
    x = rng.integers(0, 1 << 63, n).astype(np.uint64)
    y = x ^ np.array([sum(1 << int(b) for b in rng.choice(63, 3, replace=False)) for _ in range(n)], np.uint64)
    assert (np.abs(simhash.pivot_table(x) - simhash.pivot_table(y)).max(axis=1) <= 3).all()
