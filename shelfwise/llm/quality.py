"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from the whole text (character classes, word and line repetition, shape of words and lines,
compressibility). Trees are grown level by level on quantile-binned statistics with gradient histograms,
then flattened to three arrays (feature, threshold, leaf value) of complete binary trees, which tasks walk
with vectorised numpy, one level of all rows at a time.

The model is fitted on a bounded sample: the ``max_rows`` labelled documents with the smallest id hash. Only
their statistics (a few hundred bytes each) come to the driver. Scoring covers every row.

Defined results: null text scores as empty text; a null doc_id is scored and never used for learning; labels
that disagree on one doc_id count by majority (ties: 1), null labels not at all; with no usable labels every
score is 0.5; repeated rows score alike; an empty table gives an empty result; extra columns pass through.
"""
from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, prepare, smallest_hashes

MAX_ROWS = 20_000
BINS = 64
LETTERS = b"abcdefghijklmnopqrstuvwxyz"
STOP = frozenset(b" \t\n\r\v\f")
SYMBOLS = b"#$%&*|!<>{}[]@=_^~\\/+`"
PUNCT = b".,;:?'\"()-"
_CLASS = np.zeros(256, np.int64)  # 0 other
for _i, _set in enumerate((LETTERS, LETTERS.upper(), b"0123456789", b" \t\r\v\f", b"\n", SYMBOLS, PUNCT, bytes(range(128, 256))), 1):
    _CLASS[list(_set)] = _i
N_STATS = 28
BLOCK = 1 << 20


def _repeat(items: list) -> tuple[float, float]:
    """Share of distinct items, and share of the most frequent one."""
    n = len(items)
    if not n:
        return 1.0, 0.0
    counts: dict = {}
    for x in items:
        counts[x] = counts.get(x, 0) + 1
    return len(counts) / n, max(counts.values()) / n


def _compressed(raw: bytes) -> int:
    c = zlib.compressobj(1)
    return sum(len(c.compress(raw[i:i + BLOCK])) for i in range(0, len(raw), BLOCK)) + len(c.flush())


def statistics(text: str | None) -> list[float]:
    raw = (text or "").encode()
    n = len(raw)
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    classes = np.bincount(_CLASS, weights=bytes_, minlength=9)
    words, lines = raw.split(), raw.split(b"\n")
    nw, nl = len(words), len(lines)
    lens = np.fromiter(map(len, words), np.int64, nw)
    line_lens = np.fromiter(map(len, lines), np.int64, nl)
    distinct, top = _repeat(words)
    line_distinct, line_top = _repeat([x for x in lines if x])
    sentences = raw.split(b".")
    sentence_distinct, sentence_top = _repeat([x.strip() for x in sentences if len(x) > 1])
    same = sum(map(bytes.__eq__, words, words[1:]))
    upper = sum(map(bytes.isupper, words))
    alpha = sum(map(bytes.isalpha, words))
    p = bytes_[bytes_ > 0] / max(n, 1)
    return [np.log1p(n), np.log1p(nw), np.log1p(nl), *(classes / max(n, 1)).tolist(), float(-(p * np.log(p)).sum()),
            float(lens.mean()) if nw else 0.0, float(lens.std()) if nw else 0.0, distinct, top, same / max(nw, 1), upper / max(nw, 1), alpha / max(nw, 1),
            line_distinct, line_top, float(np.log1p(line_lens.mean())), sentence_distinct, sentence_top,
            nw / max(len(sentences), 1) / 100, sum(map(bytes.istitle, words)) / max(nw, 1), _compressed(raw) / max(n, 1)]


@dataclass
class Trees:
    """``feature`` and ``threshold`` of inner nodes, ``leaf`` values; trees of equal depth, children of i at 2i+1 and 2i+2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        rows, total = np.arange(len(x)), np.full(len(x), self.base)
        inner = self.feature.shape[1]
        depth = (inner + 1).bit_length() - 1
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            total += leaf[at - inner]
        return 1.0 / (1.0 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, l2: float = 1.0, min_rows: int = 5) -> Trees:
    inner, leaves = 2 ** depth - 1, 2 ** depth
    empty = Trees(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if len(y) == 0:
        return empty
    mean = min(max(y.mean(), 0.5 / (len(y) + 1)), 1 - 0.5 / (len(y) + 1))
    empty.base = float(np.log(mean / (1 - mean)))
    if y.min() == y.max():
        return empty
    n, k = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    edge = np.full((k, BINS), np.inf)
    for j, c in enumerate(cuts):
        edge[j, :len(c)] = c
    raw = np.full(n, empty.base)
    feats, thres, vals = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        f_of, t_of = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            flat = ((node - first)[:, None] * k + np.arange(k)) * BINS + binned
            size = width * k * BINS
            hist = [np.bincount(flat.ravel(), np.repeat(w, k), size).reshape(width, k, BINS) for w in (g, h, np.ones(n))]
            gl, hl, cl = (np.cumsum(a, axis=2) for a in hist)
            gt, ht, ct = gl[:, :, -1:], hl[:, :, -1:], cl[:, :, -1:]
            gain = gl ** 2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt ** 2 / (ht + l2)
            gain[(cl < min_rows) | (ct - cl < min_rows) | ~np.isfinite(edge)[None]] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            ok = gain.reshape(width, -1)[np.arange(width), best] > 1e-6
            j, b = best // BINS, best % BINS
            f_of[first:first + width] = j
            t_of[first:first + width] = np.where(ok, edge[j, b], np.inf)  # no split: all rows go left
            right = (binned[np.arange(n), j[node - first]] > b[node - first]) & ok[node - first]
            node = 2 * node + 1 + right
        at = node - inner
        value = -rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + l2)
        raw += value[at]
        feats.append(f_of)
        thres.append(t_of)
        vals.append(value)
    return Trees(empty.base, np.array(feats), np.array(thres), np.array(vals))


def _stats_batches(batches):
    for b in batches:
        x = [statistics(t) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column("label")], names=["x", "label"])


def learning_rows(docs: DataFrame, labels: DataFrame, label: str, usable: Column, max_rows: int) -> DataFrame:
    """doc_id, text, label of at most ``max_rows`` labelled documents that meet ``usable`` (an expression on doc_id)."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & usable)
             .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label")))
    chosen = known.join(F.broadcast(smallest_hashes(known.select("doc_id"), max_rows)), "doc_id")  # at most max_rows
    one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return one.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", max_rows: int = MAX_ROWS) -> Trees:
    prepare(docs.sparkSession)
    rows = learning_rows(docs, labels, label, usable, max_rows).select("text", "label").mapInArrow(_stats_batches, "x array<double>, label int")
    rows = rows.toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), N_STATS)
    order = np.lexsort(x.T)  # the fit does not depend on task order
    return fit(x[order], rows["label"].to_numpy(float)[order])


def _score_batches(bc):
    def run(batches):
        model = bc.value
        for b in batches:
            x = np.array([statistics(t) for t in b.column("text").to_pylist()], float).reshape(b.num_rows, N_STATS)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(x), pa.float64())], names=[*b.schema.names, "score"])
    return run


def score_documents(docs: DataFrame, model: Trees) -> DataFrame:
    """``docs`` plus score and predicted."""
    spark = docs.sparkSession
    prepare(spark)
    names = {c: f"c{i}" for i, c in enumerate(docs.columns) if c != "text"}
    base = docs.select("text", *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in base.schema.fields) + ", score double"
    out = base.mapInArrow(_score_batches(spark.sparkContext.broadcast(model)), schema)
    score, predicted = fresh(docs, "score", "predicted")
    return out.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns], F.col("score").alias(score), (F.col("score") >= 0.5).cast("int").alias(predicted))
