"""Toxicity: bidirectional gated recurrent network with attention pooling, trained in numpy.

Input per word: the embedding of the word, if the training vocabulary holds it, next to the mean embedding of
its hashed character trigrams, so spelling variants share evidence. Two gated recurrent passes read a window
of words, attention pools their states, a logistic unit scores the window. Windows of ``WINDOW`` words
overlap by half and cover the whole text. A document's logit is its best window's.

Only documents are labelled, so training alternates: windows of toxic documents are picked by the current
model (first by the log-odds of their words), windows of other documents are all negative. The embeddings'
first coordinate starts at those log-odds. The sample is the ``max_rows`` labelled documents with the smallest
id hash. Spark tasks read its texts whole: they count the documents of each word (the ``VOCAB`` most telling and
sums by trigram bucket reach the driver), then return the windows worth learning from, that is all of a text, or
of texts with more than ``MAX_WINDOWS`` the strongest half that number and as many evenly spread ones. The
network is trained on those on the driver. Its threshold is fitted on the best window of every whole sample
text, again scored in tasks.

Scoring covers every row and every window: tasks split a batch of texts into words once, number the distinct stems
of a stretch of words in Arrow, project each of them once (a table bounded by ``MAX_TABLE`` stems) and run the
recurrences over thousands of windows at a time.

Defined results: null, empty or wordless text has no window and gets the score of the model's bias on an empty
document; a null doc_id is scored and never used for learning; disagreeing labels count by majority (ties: 1);
with no usable labels of both kinds every score is the label's mean (0.5 with none), kept below 0.5 if no
toxic label is known; repeated rows score alike; an empty table gives an empty result; extra columns pass.
"""
from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, prepare, staged
from .quality import learning_rows

WINDOW, STRIDE = 32, 16
WORD_DIM, CHAR_DIM, HIDDEN = 8, 8, 8
CHAR_BUCKETS = 4096
MAX_ROWS, MAX_WINDOWS, VOCAB = 10_000, 36, 30_000
MAX_TABLE = 150_000
CHUNK = 4096
STRIP = ".,;:!?\"'()[]{}<>|#$%&*@^~`=+_-/\\"


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def trigrams(stems: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the character trigrams of all ``^stem$``, one after the other, and how many each stem has."""
    marked = [f"^{w}$" if w else "^ $" for w in stems]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked)) - 2
    c = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    h = c[:-2] * np.uint64(0x9E3779B1) + c[1:-1] * np.uint64(0x85EBCA6B) + c[2:] * np.uint64(0xC2B2AE35)
    h = (h ^ h >> np.uint64(15)) * np.uint64(0x2545F4914F6CDD1D) >> np.uint64(40)
    keep = np.ones(len(c), bool)  # trigrams that reach into the next stem
    ends = np.cumsum(sizes + 2)
    keep[ends - 1] = keep[ends - 2] = False
    return (h[keep[:-2]] % np.uint64(CHAR_BUCKETS)).astype(np.int64), sizes


def window_starts(n: int) -> range:
    """Starts of overlapping windows that cover n words."""
    return range(0, max(n - STRIDE, 1), STRIDE) if n else range(0)


def stems_of(text: str | None) -> list[str]:
    return [w.strip(STRIP) for w in words_of(text)]


def worth_learning(stems: list[str], odds: dict, most: int = MAX_WINDOWS) -> list[int]:
    """Window starts: all, or of more than ``most`` those with the most telling words and evenly spread ones."""
    starts = window_starts(len(stems))
    if len(starts) <= most:
        return list(starts)
    half = np.maximum.reduceat(np.fromiter((odds.get(w, 0.0) for w in stems), float, len(stems)), np.arange(0, len(stems), STRIDE))
    strong = np.argsort(-np.maximum(half[:-1], half[1:]), kind="stable")[:most // 2]
    even = np.linspace(0, len(starts) - 1, most - most // 2).astype(int)
    return [starts[i] for i in sorted({*strong.tolist(), *even.tolist()})]


def stretches(stems: list[str], odds: dict):
    """(start, stems) of the windows worth learning from; overlapping ones are one stretch."""
    begin = end = None
    for a in worth_learning(stems, odds):
        if end is not None and a == end + STRIDE:
            end = a
            continue
        if end is not None:
            yield begin, stems[begin:end + WINDOW]
        begin = end = a
    if end is not None:
        yield begin, stems[begin:end + WINDOW]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


@dataclass
class Network:
    vocab: dict
    p: dict = field(default_factory=dict)
    scale: float = 1.0
    shift: float = 0.0

    def inputs(self, stems: list[str]) -> np.ndarray:
        """Row per stem: word embedding (row 0 for unknown words) and mean trigram embedding."""
        ids = np.fromiter(map(self.vocab.get, stems, repeat(0)), np.int64, len(stems))
        flat, sizes = trigrams(stems)
        chars = np.add.reduceat(self.p["C"][flat], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
        return np.concatenate([self.p["W"][ids], chars], axis=1).astype(np.float32)

    def table(self, stems: list[str]) -> np.ndarray:
        """Gates of stems, CHUNK at a time."""
        gates = np.empty((len(stems), 6 * HIDDEN), np.float32)
        for i in range(0, len(stems), CHUNK):
            gates[i:i + CHUNK] = self.project(self.inputs(stems[i:i + CHUNK]))
        return gates

    def project(self, x: np.ndarray) -> np.ndarray:
        """Input part of all gates of both directions: 6 x HIDDEN per word."""
        return np.concatenate([x @ self.p["If"] + self.p["bf"], x @ self.p["Ib"] + self.p["bb"]], axis=1)

    def windows(self, gates: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Logits of windows: ``at`` holds rows of ``gates`` (WINDOW per window, -1 after the end)."""
        n, t = at.shape
        mask = (at >= 0).T
        ones, whole = mask[:, :, None].astype(np.float32), mask.all(axis=1)
        g = gates.take(np.maximum(at, 0).T, axis=0)
        h = np.empty((t, n, 2 * HIDDEN), np.float32)
        for side, U in enumerate(("Uf", "Ub")):
            s = np.zeros((n, HIDDEN), np.float32)
            first, rec = 3 * HIDDEN * side, self.p[U]
            for k in range(t) if side == 0 else range(t - 1, -1, -1):  # as _gru, in place
                zr = s @ rec[:, :2 * HIDDEN]
                zr += g[k, :, first:first + 2 * HIDDEN]
                np.negative(zr, out=zr)
                np.exp(zr, out=zr)
                zr += 1
                np.divide(1, zr, out=zr)
                c = s @ rec[:, 2 * HIDDEN:]
                c *= zr[:, HIDDEN:]
                c += g[k, :, first + 2 * HIDDEN:first + 3 * HIDDEN]
                np.tanh(c, out=c)
                step = s - c
                step *= zr[:, :HIDDEN]
                step += c
                step -= s
                if not whole[k]:
                    step *= ones[k]
                s += step
                h[k, :, side * HIDDEN:(side + 1) * HIDDEN] = s
        e = np.tanh(h @ self.p["A"]) @ self.p["a"]
        e = np.where(mask, e, -1e9)
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        return (w[:, :, None] * h).sum(axis=0) @ self.p["o"] + self.p["c"]

    def score(self, best: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale * best + self.shift)


def _gru(g, s, rec):
    """One step: update, reset, candidate; returns the new state and what backpropagation needs."""
    zr = sigmoid(g[:, :2 * HIDDEN] + s @ rec[:, :2 * HIDDEN])
    z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
    m = s @ rec[:, 2 * HIDDEN:]
    c = np.tanh(g[:, 2 * HIDDEN:] + r * m)
    return c + z * (s - c), (z, r, m, c, s)


def _gradients(net: Network, x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Loss and gradients of a batch; x: steps x windows x inputs."""
    p, (t, n, _) = net.p, x.shape
    g = net.project(x.reshape(t * n, -1)).reshape(t, n, -1)
    h = np.zeros((t, n, 2 * HIDDEN), np.float32)
    kept = [[None] * t, [None] * t]
    sides = (("f", slice(0, 3 * HIDDEN), range(t)), ("b", slice(3 * HIDDEN, 6 * HIDDEN), range(t - 1, -1, -1)))
    for side, (d, cols, order) in enumerate(sides):
        s = np.zeros((n, HIDDEN), np.float32)
        for k in order:
            new, kept[side][k] = _gru(g[k, :, cols], s, p["U" + d])
            s = s + mask[k] * (new - s)
            h[k, :, side * HIDDEN:(side + 1) * HIDDEN] = s
    u = np.tanh(h @ p["A"])
    e = np.where(mask[:, :, 0] > 0, u @ p["a"], -1e9)
    w = np.exp(e - e.max(axis=0))
    w /= w.sum(axis=0)
    pooled = (w[:, :, None] * h).sum(axis=0)
    logit = pooled @ p["o"] + p["c"]
    prob = sigmoid(logit)
    loss = float(-(weight * (y * np.log(prob + 1e-7) + (1 - y) * np.log(1 - prob + 1e-7))).sum() / weight.sum())
    grad = {k: np.zeros_like(v) for k, v in p.items() if k not in ("W", "C")}
    dl = ((prob - y) * weight / weight.sum()).astype(np.float32)
    grad["o"], grad["c"] = pooled.T @ dl, np.float32(dl.sum())
    dp = dl[:, None] * p["o"]
    dw = (h * dp).sum(axis=2)
    de = w * (dw - (w * dw).sum(axis=0))
    dh = w[:, :, None] * dp
    grad["a"] = np.einsum("tn,tnk->k", de, u)
    du = de[:, :, None] * p["a"] * (1 - u * u)
    grad["A"] = np.einsum("tni,tnk->ik", h, du)
    dh = dh + du @ p["A"].T
    dg = np.zeros_like(g)
    for side, (d, cols, order) in enumerate(sides):
        rec, ds = p["U" + d], np.zeros((n, HIDDEN), np.float32)
        drec = grad["U" + d]
        for k in reversed(order):
            z, r, m, c, s = kept[side][k]
            ds = ds + dh[k, :, side * HIDDEN:(side + 1) * HIDDEN]
            dn = ds * mask[k]
            dc = dn * (1 - z) * (1 - c * c)
            dz = dn * (s - c) * z * (1 - z)
            dr = dc * m * r * (1 - r)
            gates = np.concatenate([dz, dr], axis=1)
            dm = dc * r
            dg[k, :, cols] = np.concatenate([gates, dc], axis=1)
            drec[:, :2 * HIDDEN] += s.T @ gates
            drec[:, 2 * HIDDEN:] += s.T @ dm
            ds = ds - dn + dn * z + gates @ rec[:, :2 * HIDDEN].T + dm @ rec[:, 2 * HIDDEN:].T
    flat, gf, gb = x.reshape(t * n, -1), dg[:, :, :3 * HIDDEN].reshape(t * n, -1), dg[:, :, 3 * HIDDEN:].reshape(t * n, -1)
    grad["If"], grad["bf"], grad["Ib"], grad["bb"] = flat.T @ gf, gf.sum(axis=0), flat.T @ gb, gb.sum(axis=0)
    dx = (gf @ p["If"].T + gb @ p["Ib"].T).reshape(t, n, -1)
    return loss, grad, dx, logit


def _log_odds(n_pos, n_neg, pos, neg):
    return np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))


@dataclass
class Evidence:
    """Documents of both labels, and how many of them hold each telling word and each trigram bucket (summed over words)."""

    n_pos: int
    n_neg: int
    words: list  # (stem, pos, neg), most telling first
    gram_pos: np.ndarray
    gram_neg: np.ndarray

    def odds(self) -> dict:
        return {w: float(_log_odds(self.n_pos, self.n_neg, pos, neg)) for w, pos, neg in self.words}


def evidence(texts: list[str], y: np.ndarray) -> Evidence:
    """``gather_evidence`` for texts in memory."""
    n_pos, counts = int(y.sum()), {}
    for t, label in zip(texts, y):
        for w in set(stems_of(t)):
            counts.setdefault(w, [0, 0])[0 if label else 1] += 1
    counts.pop("", None)
    n_neg = len(y) - n_pos
    telling = {w: abs(_log_odds(n_pos, n_neg, p, n)) * (p + n) ** 0.5 for w, (p, n) in counts.items() if p + n >= 3}
    words = [(w, *counts[w]) for w in sorted(telling, key=lambda w: (-telling[w], w))[:VOCAB]]
    return Evidence(n_pos, n_neg, words, *_gram_counts(list(counts), np.array(list(counts.values())).reshape(-1, 2)))


def _gram_counts(stems: list[str], counts: np.ndarray):
    if not stems:
        return np.zeros(CHAR_BUCKETS), np.zeros(CHAR_BUCKETS)
    flat, sizes = trigrams(stems)
    return tuple(np.bincount(flat, np.repeat(counts[:, i], sizes), CHAR_BUCKETS) for i in (0, 1))


def train_network(texts: list[str], y: np.ndarray, **kw) -> Network | None:
    """``train`` for texts in memory; None if one of the two labels is missing."""
    if len(y) == 0 or y.min() == y.max():
        return None
    known = evidence(texts, y)
    odds = known.odds()
    net = fit_network(known, ((i, w) for i, t in enumerate(texts) for _, w in stretches(stems_of(t), odds)), y, **kw)
    if net:
        net.scale, net.shift = _calibrate(Scorer(net).logits(texts), y)
    return net


def fit_network(known: Evidence, learned: Iterable[tuple[int, list[str]]], y: np.ndarray, rounds: int = 5, steps: int = 80, batch: int = 256, seed: int = 7) -> Network | None:
    """``learned``: stretches of stems with the number of their document in ``y``, kept as numbers only. None without
    windows of toxic documents."""
    table: dict = {}  # stems to numbers
    parts, doc_of = [], []
    for i, stems in learned:
        ids = np.full(len(stems) + WINDOW, -1, np.int32)
        ids[:len(stems)] = [table.setdefault(x, len(table)) for x in stems]
        starts = np.array(window_starts(len(stems)))
        parts.append(ids[starts[:, None] + np.arange(WINDOW)])
        doc_of += [i] * len(starts)
    at, doc_of, listed = np.concatenate([np.zeros((0, WINDOW), np.int32), *parts]), np.array(doc_of, np.int64), list(table)
    del parts, table
    is_pos = y[doc_of] > 0
    if not is_pos.any():
        return None
    rng = np.random.default_rng(seed)
    frequent = [w for w, _, _ in known.words]
    vocab = {w: i + 1 for i, w in enumerate(frequent)}
    make = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
    dim = WORD_DIM + CHAR_DIM
    p = {"W": make(len(vocab) + 1, WORD_DIM) * 0.3, "C": make(CHAR_BUCKETS, CHAR_DIM) * 0.3, "If": make(dim, 3 * HIDDEN), "Ib": make(dim, 3 * HIDDEN),
         "Uf": make(HIDDEN, 3 * HIDDEN), "Ub": make(HIDDEN, 3 * HIDDEN), "bf": np.zeros(3 * HIDDEN, np.float32), "bb": np.zeros(3 * HIDDEN, np.float32),
         "A": make(2 * HIDDEN, HIDDEN), "a": make(HIDDEN), "o": make(2 * HIDDEN), "c": np.float32(-1.0)}
    odds = np.array([0.0, *known.odds().values()])
    p["W"][:, 0] = np.clip(odds, -2, 6) / 3
    p["C"][:, 0] = np.clip(np.log((known.gram_pos + 1) / (known.n_pos + 1)) - np.log((known.gram_neg + 1) / (known.n_neg + 1)), -2, 6) / 3
    net = Network(vocab, p)
    word_id = np.array([vocab.get(w, 0) for w in listed], np.int64)
    flat, sizes = trigrams(listed)
    grams = np.split(flat, np.cumsum(sizes)[:-1])
    strength = np.where(at >= 0, odds[word_id][np.maximum(at, 0)], -9).max(axis=1)  # first pick: the most telling word
    moments: dict = {}
    step = 0
    for r in range(rounds):
        chosen = _best_windows(strength, doc_of, is_pos)
        negatives = np.flatnonzero(~is_pos)
        hard = negatives[np.argsort(-strength[negatives], kind="stable")[:max(len(negatives) // 50, batch)]]
        for _ in range(steps):
            step += 1
            rows = np.concatenate([rng.choice(chosen, batch // 2), rng.choice(negatives, batch // 4) if len(negatives) else chosen[:0],
                                   rng.choice(hard, batch // 4) if len(hard) else chosen[:0]])
            _train_step(net, at[rows], is_pos[rows].astype(np.float32), word_id, grams, moments, step)
        strength = _all_logits(net, listed, at)
    return net


def _best_windows(strength, doc_of, is_pos):
    """The best window of each toxic document; the weakest eighth is left out, as labels are noisy."""
    order = np.lexsort((-strength, doc_of))
    first = order[np.concatenate([[True], np.diff(doc_of[order]) > 0])]
    first = first[is_pos[first]]
    return first[strength[first] >= np.quantile(strength[first], 0.125)]


def _all_logits(net, listed, at):
    gates = net.project(net.inputs(listed))
    return np.concatenate([net.windows(gates, at[i:i + CHUNK]) for i in range(0, len(at), CHUNK)])


def _train_step(net, at, y, word_id, grams, moments, step, rate=0.01):
    used, back = np.unique(np.maximum(at, 0), return_inverse=True)
    back = back.reshape(at.shape)
    own = [grams[i] for i in used]
    sizes = np.array([len(g) for g in own])
    flat = np.concatenate(own)
    chars = np.add.reduceat(net.p["C"][flat], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
    rows = np.concatenate([net.p["W"][word_id[used]], chars], axis=1).astype(np.float32)
    mask = (at >= 0).T[:, :, None].astype(np.float32)
    _, grad, dx, _ = _gradients(net, rows[back].transpose(1, 0, 2), mask, y, np.ones(len(y), np.float32))
    dx = dx * mask
    drow = np.zeros_like(rows)
    np.add.at(drow, back.T.ravel(), dx.reshape(-1, dx.shape[2]))
    gw, gc = np.zeros_like(net.p["W"]), np.zeros_like(net.p["C"])
    np.add.at(gw, word_id[used], drow[:, :WORD_DIM])
    np.add.at(gc, flat, np.repeat(drow[:, WORD_DIM:] / sizes[:, None], sizes, axis=0))
    grad["W"], grad["C"] = gw, gc
    for k, g in grad.items():  # Adam
        m, v = moments.setdefault(k, [np.zeros_like(net.p[k]), np.zeros_like(net.p[k])])
        m = moments[k][0] = 0.9 * m + 0.1 * g
        v = moments[k][1] = 0.99 * v + 0.01 * g * g
        net.p[k] = (net.p[k] - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)


def _calibrate(best, y, rounds: int = 400):
    a, b = 1.0, 0.0
    x = np.clip(best, -12, 12)
    for _ in range(rounds):
        q = sigmoid(a * x + b)
        a -= 0.05 * float(((q - y) * x).mean() + 0.001 * (a - 1))
        b -= 0.2 * float((q - y).mean())
    return max(a, 0.1), b


class Scorer:
    """Scores batches of texts; projects the distinct stems of a stretch of words at a time, at most MAX_TABLE."""

    def __init__(self, net: Network):
        self.net = net

    def logits(self, texts: list) -> np.ndarray:
        """Logit of the best window of each text; -20 without words."""
        words, begin = split_words(texts)
        starts = [np.arange(b, e - STRIDE if e - b > STRIDE else b + 1, STRIDE) if e > b else np.zeros(0, np.int64) for b, e in zip(begin, begin[1:])]
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        starts = np.concatenate([np.zeros(0, np.int64), *starts]).astype(np.int64)
        best = np.full(len(texts), -20.0)
        i, most = 0, 4 * MAX_TABLE
        while i < len(starts):
            first = starts[i]
            j = max(int(np.searchsorted(starts, first + most - WINDOW, "right")), i + 1)
            ids, stems = stem_ids(words.slice(first, starts[j - 1] + WINDOW - first))
            if len(stems) > MAX_TABLE and j > i + 1:  # more than the table holds: fewer words at a time
                most //= 2
                continue
            gates = self.net.table(stems)
            ids = np.concatenate([ids, np.full(WINDOW, -1)])
            for k in range(i, j, CHUNK):
                s, o = starts[k:min(k + CHUNK, j)], owner[k:min(k + CHUNK, j)]
                pos = s[:, None] + np.arange(WINDOW)
                at = np.where(pos < begin[o + 1][:, None], ids[pos - first], -1)
                np.maximum.at(best, o, self.net.windows(gates, at))
            i = j
        return best


def split_words(texts: list) -> tuple[pa.Array, np.ndarray]:
    """``words_of`` all texts, one after the other, and where each text begins and the last ends."""
    parts = pc.utf8_split_whitespace(pa.array([(t or "").lower() for t in texts], pa.large_string()))
    words, ends = parts.flatten(), parts.offsets.to_numpy()
    real = pc.not_equal(words, "")  # there is an empty one beside white space at an end
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return words.filter(real), before[ends - ends[0]].astype(np.int64)


def stem_ids(words: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Number of each word's stem and the distinct stems."""
    distinct = words.dictionary_encode()
    stems = pc.utf8_trim(distinct.dictionary, characters=STRIP).dictionary_encode()
    return stems.indices.to_numpy()[distinct.indices.to_numpy()], stems.dictionary.to_numpy(zero_copy_only=False).tolist()


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", max_rows: int = MAX_ROWS):
    """(network or None, fallback score)."""
    spark = docs.sparkSession
    prepare(spark)
    sample = staged(learning_rows(docs, labels, label, usable, max_rows), "toxicity-sample")
    y = sample.select("doc_id", "label").toPandas().set_index("doc_id")["label"].sort_index()  # at most max_rows numbers
    prior = float(y.mean()) if len(y) else 0.5
    if y.nunique() < 2:
        return None, prior
    known = gather_evidence(sample, int(y.sum()), int(len(y) - y.sum()))
    picked = sample.mapInArrow(_worth_batches(spark.sparkContext.broadcast(known.odds())), "doc_id long, start int, stems string")
    number = {i: n for n, i in enumerate(y.index)}
    rows = staged(picked, "toxicity-stretches").orderBy("doc_id", "start").toLocalIterator()  # at most max_rows * MAX_WINDOWS windows
    net = fit_network(known, ((number[r.doc_id], r.stems.split(" ")) for r in rows), y.to_numpy(float))
    if net:
        best = sample.mapInArrow(_best_batches(spark.sparkContext.broadcast(net)), "doc_id long, best double").toPandas().set_index("doc_id")["best"]
        net.scale, net.shift = _calibrate(best.reindex(y.index).to_numpy(), y.to_numpy(float))
    return net, prior


def gather_evidence(sample: DataFrame, n_pos: int, n_neg: int) -> Evidence:
    """sample: text, label. Words are counted in Spark; at most VOCAB of them and the trigram buckets are collected."""
    held = sample.mapInArrow(_word_batches, "stem string, pos long, neg long")
    counts = staged(held.groupBy("stem").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "toxicity-words")
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    often = counts.where(F.col("pos") + F.col("neg") >= 3)
    words = often.orderBy(F.desc(F.abs(odds) * F.sqrt(F.col("pos") + F.col("neg"))), "stem").limit(VOCAB).collect()
    grams = counts.mapInArrow(_gram_batches, "bucket int, pos double, neg double").groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).orderBy("bucket").collect()
    sums = np.zeros((2, CHAR_BUCKETS))
    for r in grams:
        sums[:, r.bucket] = r.pos, r.neg
    return Evidence(n_pos, n_neg, [(r.stem, r.pos, r.neg) for r in words], *sums)


def _word_batches(batches):
    """Stems with the documents of each label that hold them, summed over a batch."""
    for b in batches:
        counts: dict = {}
        for t, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
            for w in set(stems_of(t)):
                counts.setdefault(w, [0, 0])[0 if label else 1] += 1
        counts.pop("", None)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1))], names=["stem", "pos", "neg"])


def _gram_batches(batches):
    sums = np.zeros((2, CHAR_BUCKETS))
    for b in batches:
        sums += _gram_counts(b.column("stem").to_pylist(), np.stack([b.column("pos").to_numpy(), b.column("neg").to_numpy()], 1))
    at = np.flatnonzero(sums.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array(c[at], pa.float64()) for c in sums)], names=["bucket", "pos", "neg"])


def _worth_batches(bc):
    def run(batches):
        for b in batches:
            rows = []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                w = stems_of(t)
                rows += [(i, a, " ".join(x)) for a, x in stretches(w, bc.value)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.string()))], names=["doc_id", "start", "stems"])
    return run


def _best_batches(bc):
    def run(batches):
        scorer = Scorer(bc.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scorer.logits(b.column("text").to_pylist()), pa.float64())], names=["doc_id", "best"])
    return run


def _score_batches(bc):
    def run(batches):
        net, prior = bc.value
        scorer = Scorer(net) if net else None
        for b in batches:
            texts = b.column("text").to_pylist()
            score = net.score(scorer.logits(texts)) if net else np.full(len(texts), prior)
            rest = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], b.column("text"), pa.array(score, pa.float64())], names=[*rest, "text", "score"])
    return run


def score_documents(docs: DataFrame, model) -> DataFrame:
    """``docs`` plus score and predicted."""
    spark = docs.sparkSession
    prepare(spark)
    names = {c: f"c{i}" for i, c in enumerate(docs.columns) if c != "text"}
    base = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], "text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in base.schema.fields) + ", score double"
    out = base.mapInArrow(_score_batches(spark.sparkContext.broadcast(model)), schema)
    score, predicted = fresh(docs, "score", "predicted")
    return out.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns], F.col("score").alias(score), (F.col("score") >= 0.5).cast("int").alias(predicted))
