"""Quality and toxicity: held-out accuracy, edge rows, gradients."""
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfwise.llm import quality, toxicity
from shelfwise.sources.tables import read_table

SF = "/root/testdata/sf0.01"
ODD = [(10 ** 9, None), (10 ** 9 + 1, ""), (None, "some text"), (10 ** 9 + 2, " \n\t "), (10 ** 9 + 3, "word " * 100000), (10 ** 9 + 3, "word " * 100000)]


def held(n, k):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % n == k, F.lit(False))


def scored(spark, docs_of, module, label, n, k):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    model = module.train(docs, labels.union(spark.createDataFrame([(None, 1, 1), (3, None, None)], labels.schema)), ~held(n, k))
    odd = module.score_documents(docs_of(ODD), model)
    name = odd.columns[-2]
    odd_rows = odd.select("doc_id", F.col(name).alias("s")).collect()
    assert len(odd_rows) == len(ODD) and all(0 <= r.s <= 1 for r in odd_rows)
    assert module.score_documents(docs_of([]), model).count() == 0
    out = module.score_documents(docs.select("doc_id", "text"), model).join(labels, "doc_id").toPandas()
    fold = out.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % n == k)
    return out[fold], label


def test_quality_held_out(spark, docs_of):
    out, label = scored(spark, docs_of, quality, "quality", 3, 1)
    assert (out.predicted == out[label]).mean() > 0.95


def test_toxicity_held_out(spark, docs_of):
    out, label = scored(spark, docs_of, toxicity, "toxic", 5, 0)
    assert (out.predicted == out[label]).mean() > 0.85


def test_no_labels_or_one_class(spark, docs_of):
    docs = docs_of([(1, "a"), (2, "b")])
    for rows in ([], [(1, 1, 0)], [(1, None, None)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        for module in (quality, toxicity):
            out = module.score_documents(docs, module.train(docs, labels, F.lit(True)))
            assert out.count() == 2 and all(0 <= r[-2] <= 1 for r in out.collect())


def test_flat_trees_equal_a_plain_walk():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, quality.N_STATS))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    t = quality.fit(x, y, trees=20, depth=3)

    def walk(row):
        total = t.base
        for f, th, leaf in zip(t.feature, t.threshold, t.leaf):
            i = 0
            while i < len(f):
                i = 2 * i + (2 if row[f[i]] > th[i] else 1)
            total += leaf[i - len(f)]
        return 1 / (1 + np.exp(-total))
    assert np.allclose(t.score(x), [walk(r) for r in x])
    assert ((t.score(x) > 0.5) == y).mean() > 0.95


def test_network_gradients():
    rng = np.random.default_rng(1)
    dim, h = toxicity.WORD_DIM + toxicity.CHAR_DIM, toxicity.HIDDEN
    mk = lambda *s: rng.standard_normal(s) * 0.4
    p = {"If": mk(dim, 3 * h), "Ib": mk(dim, 3 * h), "Uf": mk(h, 3 * h), "Ub": mk(h, 3 * h), "bf": mk(3 * h), "bb": mk(3 * h), "A": mk(2 * h, h), "a": mk(h), "o": mk(2 * h), "c": np.float64(0.1)}
    net = toxicity.Network({}, p)
    x, mask = mk(5, 3, dim), np.ones((5, 3, 1))
    mask[3:, 1] = 0
    y, w = np.array([1.0, 0.0, 1.0]), np.ones(3)
    _, grad, _, _ = toxicity._gradients(net, x, mask, y, w)
    for k in p:
        if k == "c":
            continue
        at = tuple(rng.integers(0, s) for s in p[k].shape)
        old, ends = p[k][at], []
        for e in (1e-3, -1e-3):
            p[k][at] = old + e
            ends.append(toxicity._gradients(net, x, mask, y, w)[0])
        p[k][at] = old
        assert abs((ends[0] - ends[1]) / 2e-3 - grad[k][at]) < 2e-3, k


def plain_score(net, text):
    """From text to score, word by word."""
    words, p, h = (text or "").lower().split(), net.p, toxicity.HIDDEN
    sig = lambda x: 1 / (1 + np.exp(-x))

    def vector(word):
        stem = word.strip(toxicity.STRIP)
        marked = f"^{stem}$" if stem else "^ $"
        rows = []
        for a, b, c in zip(marked, marked[1:], marked[2:]):
            x = (ord(a) * 0x9E3779B1 + ord(b) * 0x85EBCA6B + ord(c) * 0xC2B2AE35) % 2 ** 64
            rows.append(p["C"][((x ^ x >> 15) * 0x2545F4914F6CDD1D % 2 ** 64 >> 40) % toxicity.CHAR_BUCKETS])
        return np.concatenate([p["W"][net.vocab.get(stem, 0)], np.mean(rows, axis=0)])

    def states(xs, d):
        s, out = np.zeros(h), []
        for x in xs:
            g, u = x @ p["I" + d] + p["b" + d], p["U" + d]
            z, r = sig(g[:h] + s @ u[:, :h]), sig(g[h:2 * h] + s @ u[:, h:2 * h])
            s = (1 - z) * np.tanh(g[2 * h:] + r * (s @ u[:, 2 * h:])) + z * s
            out.append(s)
        return out

    best, start = -20.0, 0
    while start == 0 and words or start < len(words) - toxicity.STRIDE:
        xs = [vector(w) for w in words[start:start + toxicity.WINDOW]]
        both = np.concatenate([states(xs, "f"), states(xs[::-1], "b")[::-1]], axis=1)
        e = np.exp(np.tanh(both @ p["A"]) @ p["a"])
        best = max(best, float(e / e.sum() @ both @ p["o"] + p["c"]))
        start += toxicity.STRIDE
    return sig(net.scale * best + net.shift)


def test_scores_equal_a_plain_version(spark, docs_of):
    rng = np.random.default_rng(2)
    vocabulary = [f"word{i}" for i in range(60)] + ["Étage,", "漢字", "!!", "don't", "x"]
    texts = [None, "", " ", "..."] + [" ".join(rng.choice(vocabulary, n)) for n in (1, 2, 16, 17, 31, 32, 33, 48, 49, 150, 700)]
    y = np.arange(len(texts)) % 2
    net = toxicity.train_network(texts, y.astype(float), rounds=1, steps=4)
    got = toxicity.score_documents(docs_of(list(enumerate(texts))), (net, 0.5)).collect()
    assert np.allclose([r[-2] for r in sorted(got, key=lambda r: r.doc_id)], [plain_score(net, t) for t in texts], atol=1e-4)


def test_training_reads_whole_texts(spark, docs_of):
    # the only toxic words stand deep inside long texts, away from evenly spread windows
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        words = rng.choice([f"w{k}" for k in range(300)], 6000).tolist()
        if i % 2:
            words[1000 + 31 * i:1000 + 31 * i] = ["vile", "insult", "here"]
        rows.append((i, " ".join(words)))
    docs, labels = docs_of(rows), spark.createDataFrame([(i, 0, i % 2) for i in range(120)], "doc_id long, quality int, toxic int")
    assert max(len(toxicity.worth_learning(toxicity.stems_of(t), {"vile": 5.0})) for _, t in rows) <= toxicity.MAX_WINDOWS
    known, plain = toxicity.gather_evidence(docs.join(labels.withColumnRenamed("toxic", "label"), "doc_id"), 60, 60), toxicity.evidence([t for _, t in rows], np.arange(120) % 2)
    assert sorted(known.words) == sorted(plain.words) and (known.gram_pos == plain.gram_pos).all() and (known.gram_neg == plain.gram_neg).all()
    out = toxicity.score_documents(docs, toxicity.train(docs, labels, F.col("doc_id") < 80)).collect()
    assert np.mean([r[-1] == r.doc_id % 2 for r in out if r.doc_id >= 80]) > 0.95


def test_windows_cover_the_text():
    for n in range(0, 200):
        covered = {i for s in toxicity.window_starts(n) for i in range(s, min(s + toxicity.WINDOW, n))}
        assert covered == set(range(n))


def test_small_word_table_gives_the_same_scores(monkeypatch):
    texts = [" ".join(f"w{(i * 7 + j) % 97}" for j in range(150)) for i in range(12)]
    net = toxicity.train_network(texts, np.array([0, 1] * 6), rounds=1, steps=3)
    want = toxicity.Scorer(net).logits(texts)
    monkeypatch.setattr(toxicity, "MAX_TABLE", 64)
    assert np.allclose(toxicity.Scorer(net).logits(texts), want, atol=1e-4)


def test_texts_are_split_once_whatever_the_table_holds(monkeypatch):
    split = []

    class Text(str):
        def lower(self):
            split.append(self[:9])
            return str(self).lower()

    texts = [" ".join(f"w{i}x{j}" for j in range(100)) for i in range(40)]
    net = toxicity.train_network(texts, np.arange(40) % 2, rounds=1, steps=3)
    want = np.concatenate([toxicity.Scorer(net).logits([t]) for t in texts])
    monkeypatch.setattr(toxicity, "MAX_TABLE", 250)
    assert np.allclose(toxicity.Scorer(net).logits([Text(t) for t in texts]), want, atol=1e-4)
    assert len(split) == len(texts)


def test_words_and_stems_in_arrow_equal_the_plain_ones():
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [None, "", " ", "\n\t", "a", " Lead and trail ", "İstanbul ΣΑΣ ß", "...", "(it's)  \"so\"—", "nul\x00l \u200b zero", "x".join(spaces), *(f"{s}One{s}{s}two.{s}" for s in spaces)]
    words, begin = toxicity.split_words(texts)
    ids, stems = toxicity.stem_ids(words)
    assert len(set(stems)) == len(stems)
    for t, a, b in zip(texts, begin, begin[1:]):
        assert words[a:b].to_pylist() == toxicity.words_of(t) and [stems[i] for i in ids[a:b]] == toxicity.stems_of(t)
    assert len(toxicity.split_words([])[0]) == 0 and toxicity.split_words([])[1].tolist() == [0]


def test_statistics_are_finite():
    for t in (None, "", " ", "\n\n", "a", "é" * 10, "x" * 300000):
        s = quality.statistics(t)
        assert len(s) == quality.N_STATS and np.isfinite(s).all()
    assert isinstance(pd.DataFrame([quality.statistics("a b")]), pd.DataFrame)
