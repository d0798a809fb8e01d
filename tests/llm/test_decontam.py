import hashlib
import random
import re

import pytest

from shelfwise.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, items, n=13):
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    wins = {}
    for i, t in items:
        w = words(t)
        if i is None or not w:
            continue
        size = min(n, len(w))
        for k in range(len(w) - size + 1):
            wins.setdefault(tuple(w[k:k + size]), set()).add(str(i))
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for win, its in wins.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    found |= its
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(2)
    vocab = ["Wort", "año", "x1", "B2", "test", "naïve", "東京", "q", "and", "THE"]
    text = lambda k: " ".join(rng.choices(vocab, k=k))
    items = [(i, text(rng.choice([3, 12, 13, 14, 30]))) for i in range(12)] + [(3, "Wort!? q"), (None, text(20)), (77, None), (78, "... --"), (79, "")]
    items += [(80, items[0][1]), items[1]]
    said = lambda: (rng.choice(items[:12])[1]).replace(" ", "--")
    rows = [(i, text(20) + rng.choice([". ", ", ", "\n"]) + said() + "; " + text(rng.choice([0, 5, 400])) if i % 3 else text(30)) for i in range(30)]
    rows += [(None, items[2][1]), (5, None), (6, ""), (6, ""), (9, "!!!"), (10, text(30000))]
    return rows, items


def check(spark, docs_of, case, **kw):
    rows, items = case
    docs, bench = docs_of(rows), spark.createDataFrame(items, "item_id long, text string")
    out = decontam.scan_documents(docs, bench, **kw)
    assert out.columns[:len(docs.columns)] == docs.columns
    got = sorted([tuple(r) for r in out.select("doc_id", *out.columns[-5:]).collect()], key=str)
    assert got == brute(rows, items)


def test_broadcast_set(spark, docs_of, case):
    check(spark, docs_of, case)


def test_joined_windows_give_the_same(spark, docs_of, case):
    check(spark, docs_of, case, broadcast_chars=0)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.scan_documents(docs_of([]), none).count() == 0
    row = decontam.scan_documents(docs_of([(1, "a b c")]), none).first()
    assert row.n_words == 3 and row.n_hit == 0


def test_spans_are_cut(spark, docs_of):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    out = decontam.scan_documents(docs_of([(1, "Keep this. Alpha, BETA gamma! And this é.")]), bench, spans=True)
    assert out.first().text == "Keep this. ,  ! And this é."
