"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

Words are maximal runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z. Every window of ``n``
consecutive words of a benchmark item (or the whole item, if shorter) goes into a hash set. Tasks scan the
token windows of whole documents: word ids by the benchmark's own vocabulary, a polynomial window hash, a
lookup in the set, then verification against the exact words. A document is contaminated if hit words
exist and make at least 5 % of its words.

The set is broadcast only while the benchmark's texts hold at most ``broadcast_chars`` characters in all
(counted by Spark first); a worker expands a character to about 104 bytes, so the bound of 2 million is about
210 MB. Beyond that the windows of both sides are joined by hash over a shuffle, where only document windows leave
their task that a bit table of the benchmark's window hashes (at most ``FILTER_BITS`` bits) holds, and each document
is scanned against the windows joined to it; results are the same.

Defined results: null or empty text has no words, no hits, is not contaminated; benchmark rows with null id
or without words are ignored; repeated item rows count once; repeated documents are judged row by row;
empty tables give empty or hit-free results; extra columns pass through.
"""
from __future__ import annotations

import hashlib
import uuid
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, prepare, staged

_WORD = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
TABLE = bytes(b if b in _WORD else (b + 32 if 65 <= b <= 90 else 32) for b in range(256))
PRIME = 0x9E3779B97F4A7C15
CHUNK = 1 << 15
FILTER_BITS = 1 << 26


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TABLE).split()


def item_windows(words: list[bytes], n: int) -> set[tuple]:
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


class WindowSet:
    """Hash set of windows, by window length; exact words are kept for verification."""

    def __init__(self, windows: dict[tuple, set]):
        self.vocab = {w: i + 1 for i, w in enumerate(sorted({w for t in windows for w in t}))}
        self.by_len: dict[int, tuple[np.ndarray, dict]] = {}
        for size in sorted({len(t) for t in windows}):
            exact = {tuple(self.vocab[w] for w in t): items for t, items in windows.items() if len(t) == size}
            hashes = np.unique(self._hash(np.array(list(exact), dtype=np.uint64).reshape(-1, size)))
            self.by_len[size] = (hashes, exact)

    @staticmethod
    def _hash(m: np.ndarray) -> np.ndarray:
        h = np.zeros(len(m), np.uint64)
        for k in range(m.shape[1]):
            h = (h + m[:, k]) * np.uint64(PRIME)
            h ^= h >> np.uint64(29)
        return h

    def scan(self, docs: list[list[bytes]]) -> tuple[list[np.ndarray], list[set]]:
        """For each document: a mask of hit words, and the items whose windows occur."""
        total = sum(map(len, docs)) + len(docs)
        ids = np.zeros(total, np.uint64)
        starts, at = [], 0
        for d in docs:
            starts.append(at)
            ids[at:at + len(d)] = np.fromiter(map(self.vocab.get, d, repeat(0)), np.uint64, len(d))
            at += len(d) + 1  # a zero between documents ends every window
        pos = np.arange(total)
        run = pos - np.maximum.accumulate(np.where(ids == 0, pos, -1)) if total else pos
        edge = np.zeros(total + 1, np.int64)
        found: list[set] = [set() for _ in docs]
        bounds = np.array(starts)
        for size, (hashes, exact) in self.by_len.items():
            ends = np.flatnonzero(run >= size)
            for c in range(0, len(ends), CHUNK):
                e = ends[c:c + CHUNK]
                m = ids[e[:, None] + np.arange(1 - size, 1)]
                h = self._hash(m)
                slot = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                for i in np.flatnonzero(hashes[slot] == h).tolist():
                    items = exact.get(tuple(m[i].tolist()))
                    if items is not None:
                        first = int(e[i]) - size + 1
                        edge[first] += 1
                        edge[first + size] -= 1
                        found[int(np.searchsorted(bounds, first, "right")) - 1] |= items
        hit = np.cumsum(edge)[:total] > 0
        return [hit[s:s + len(d)] for s, d in zip(starts, docs)], found


def _cut_spans(text: str | None, mask: np.ndarray) -> str:
    """The text without the hit words (bytes between them stay)."""
    raw = (text or "").encode()
    flat = raw.translate(TABLE)
    out, at, p = [], 0, 0
    for w, bad in zip(flat.split(), mask):
        p = flat.index(w, p)
        if bad:
            out.append(raw[at:p])
            at = p + len(w)
        p += len(w)
    out.append(raw[at:])
    return b"".join(out).decode()


def _judge(sets, spans: bool):
    """``sets(batch)`` yields (row numbers, WindowSet) groups covering the batch."""
    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            n_words, n_hit, n_items, sha, cut = ([None] * len(texts) for _ in range(5))
            for rows, ws in sets(b):
                docs = [words_of(texts[r]) for r in rows]
                masks, found = ws.scan(docs)
                for r, d, m, items in zip(rows, docs, masks, found):
                    n_words[r], n_hit[r], n_items[r] = len(d), int(m.sum()), len(items)
                    sha[r] = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
                    cut[r] = _cut_spans(texts[r], m) if spans and n_hit[r] else texts[r]
            rest = [c for c in b.schema.names if c not in ("text", "near")]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in rest] + [pa.array(cut, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(n_items, pa.int64()), pa.array(sha, pa.string())],
                names=[*rest, "text", "n_words", "n_hit", "n_items", "items_sha256"])
    return run


_WORKER: dict = {}


def _shared_set(bc):
    token = uuid.uuid4().hex  # a worker builds the set once per query

    def sets(b):
        ws = _WORKER.get("set")
        if ws is None or _WORKER.get("id") != token:
            windows: dict[tuple, set] = {}
            for item, text, n in bc.value:
                for t in item_windows(words_of(text), n):
                    windows.setdefault(t, set()).add(item)
            ws = WindowSet(windows)
            _WORKER.update(id=token, set=ws)
        yield list(range(b.num_rows)), ws
    return sets


def _joined_sets(b):
    for r, near in enumerate(b.column("near").to_pylist()):
        windows: dict[tuple, set] = {}
        for x in near or []:
            windows.setdefault(tuple(x["w"].split(b" ")), set()).add(x["item"])
        yield [r], WindowSet(windows)


def _window_hash(w: bytes) -> int:
    return xxhash.xxh64_intdigest(w) - (1 << 63)


def _item_rows(n: int):
    def run(batches):
        for b in batches:
            rows = [(i, b" ".join(w), len(w)) for i, t in zip(b.column("item").to_pylist(), b.column("text").to_pylist())
                    for w in item_windows(words_of(t), n)]
            yield pa.RecordBatch.from_arrays([pa.array([_window_hash(r[1]) for r in rows], pa.int64()), pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int32())],
                                             names=["h", "item", "w", "size"])
    return run


def _bit_table(windows: DataFrame) -> np.ndarray:
    """Bit table of the hashes: about 16 bits a window; Spark fills its words, at most FILTER_BITS / 64 of them are collected."""
    bits = min(FILTER_BITS, 1 << max(10, (16 * windows.count()).bit_length()))
    place = F.pmod("h", F.lit(bits))
    words = windows.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(h, {bits}L) & 63 AS INT))")).alias("held")).toPandas()
    table = np.zeros(bits // 64, np.int64)
    table[words["word"].to_numpy(np.int64)] = words["held"].to_numpy(np.int64)
    return table.view(np.uint64)


def _doc_rows(sizes: list[int], bc):
    def run(batches):
        table = bc.value
        for b in batches:
            for k, t in zip(b.column("k").to_pylist(), b.column("text").to_pylist()):
                d = words_of(t)
                hs = np.array(list({_window_hash(b" ".join(d[i:i + s])) for s in sizes for i in range(len(d) - s + 1)}), np.int64)
                at = hs & (len(table) * 64 - 1)
                hs = hs[(table[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)) > 0]
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(hs), pa.binary()), pa.array(hs, pa.int64())], names=["k", "h"])
    return run


def scan_documents(docs: DataFrame, benchmark: DataFrame, n: int = 13, spans: bool = False,
                   broadcast_chars: int = 2_000_000) -> DataFrame:
    """``docs`` plus n_words, n_hit, n_items, items_sha256, contaminated; with ``spans`` hit words are cut from text."""
    spark = docs.sparkSession
    prepare(spark)
    items = (benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
             .where(F.col("item").isNotNull() & F.col("text").isNotNull()).distinct())
    order = docs.columns
    names = {c: f"c{i}" for i, c in enumerate(order) if c != "text"}
    base = docs.select("text", *[F.col(f"`{c}`").alias(x) for c, x in names.items()])
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if size <= broadcast_chars:
        bc = spark.sparkContext.broadcast([(r.item, r.text, n) for r in items.collect()])
        sets = _shared_set(bc)
    else:
        windows = staged(items.mapInArrow(_item_rows(n), "h long, item string, w binary, size int"), "bench-windows")
        sizes = sorted(r.size for r in windows.select("size").distinct().collect())  # at most n values
        # documents with one text share one result, so the text's 128-bit hash is the row key
        keyed = base.withColumn("k", F.unhex(F.md5("text")))
        held = spark.sparkContext.broadcast(_bit_table(windows))
        pairs = keyed.where(F.col("k").isNotNull()).select("k", "text").dropDuplicates(["k"]).mapInArrow(_doc_rows(sizes, held), "k binary, h long")
        near = pairs.join(windows, "h").groupBy("k").agg(F.collect_set(F.struct("w", "item")).alias("near"))
        base = keyed.join(near, "k", "left").drop("k")
        sets = _joined_sets
    fields = [f for f in base.schema.fields if f.name not in ("text", "near")]
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in fields) + "text string, n_words long, n_hit long, n_items long, items_sha256 string"
    out = base.mapInArrow(_judge(sets, spans), schema)
    new = ["n_words", "n_hit", "n_items", "items_sha256"]
    out = out.select(*[F.col(names.get(c, c)).alias(c) for c in order],
                     *[F.col(x).alias(y) for x, y in zip(new, fresh(docs, *new))],
                     ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias(fresh(docs, "contaminated")[0]))
    return out
