"""SimHash near-dedup verified through pivot distance tables.

Fingerprints: 64 bits over the XXH64 values (seed 42) of 3-word shingles of the whole text, A-Z lower-cased.
Equal fingerprints collapse to one row first, so exact copies cost nothing further. Distinct fingerprints
that may differ in at most ``max_bits`` bits meet by the pigeonhole rule: of ``max_bits`` + 2 bit blocks two
such fingerprints agree on at least two, so each pair of blocks is one bucket key (10 keys of 25 bits by
default). Inside a bucket the method's table decides: Hamming distances of each fingerprint to many reference
fingerprints are computed once; since |d(x,p) - d(y,p)| <= d(x,y), a pair whose largest coordinate difference
exceeds ``max_bits`` is discarded; survivors are verified bit by bit.

A bucket is never held whole: it is cut into chunks of bounded expected size, and every two chunks meet in a
group of their own. A group returns a spanning forest of its links (fewer than its rows), not its pairs, which
keeps every component. Components are found by distributed star contraction.

Defined results: null, empty or blank text has fingerprint zero and is linked like any other; null doc_id is
kept and never chosen as component id unless all are null; repeated rows are all returned; empty in, empty out.
"""
from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, long_id, prepare, staged
from .components import components

SEED = 42
PIVOTS = 24
CHUNK = 2048
SHINGLES = 1 << 15


def shingle_hashes(text: str | None, words: int = 3) -> np.ndarray:
    w = (text or "").encode().lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    if len(w) <= words:
        grams = [b" ".join(w)]
    else:
        grams = list(map(b" ".join, zip(*(w[i:] for i in range(words)))))
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, len(grams))


def fingerprint(h: np.ndarray) -> int:
    """Bit j is set if over half of the hashes have bit j set."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), SHINGLES):
        part = h[i:i + SHINGLES]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = ones * 2 > len(h)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def _fingerprints(words: int):
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(shingle_hashes(t, words)) for t in b.column("text").to_pylist()], np.uint64)
            rest = [n for n in b.schema.names if n not in ("doc_id", "text")]
            columns = [b.column("doc_id"), pa.array(fp.view(np.int64), pa.int64()), *map(b.column, rest)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", *rest])
    return run


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Fixed reference fingerprints: hashes of their own numbers."""
    return np.array([xxhash.xxh64_intdigest(f"pivot {i}".encode(), SEED) for i in range(n)], np.uint64)


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Row per fingerprint, column per pivot: Hamming distance."""
    return np.bitwise_count(fps[:, None] ^ pivots()[None, :]).astype(np.int8)


def _near(fps: np.ndarray, table: np.ndarray, x: int, among: np.ndarray, max_bits: int) -> np.ndarray:
    """Of ``among``, the rows within ``max_bits`` of row x: by coordinate difference, then exactly."""
    for cut in (slice(0, 6), slice(6, None)):
        among = among[(np.abs(table[among, cut] - table[x, cut]) <= max_bits).all(axis=1)]
    return among[np.bitwise_count(fps[among] ^ fps[x]) <= max_bits]


def spanning_links(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the graph that links fingerprints at most ``max_bits`` bits apart."""
    table = pivot_table(fps)
    left, out = np.arange(len(fps)), []
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            got = _near(fps, table, x, left, max_bits)
            if len(got):
                out += [(x, int(y)) for y in got]
                queue += got.tolist()
                left = np.setdiff1d(left, got, assume_unique=True)
    return out


def _pairs_of_two(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Mask over rows of two fingerprints: linked."""
    t = np.abs(pivot_table(fps[:, 0]) - pivot_table(fps[:, 1])).max(axis=1) <= max_bits
    t[t] = np.bitwise_count(fps[t, 0] ^ fps[t, 1]) <= max_bits
    return t


def _bucket_links(max_bits: int):
    def run(batches):
        for b in batches:
            col = b.column("fps")
            values = col.flatten().to_numpy().view(np.uint64)
            ends = np.cumsum(np.diff(col.offsets.to_numpy()))
            starts = np.concatenate([[0], ends[:-1]])
            size = ends - starts
            two = starts[size == 2]
            u, v = [], []
            if len(two):
                m = np.stack([values[two], values[two + 1]], axis=1)
                m = m[_pairs_of_two(m, max_bits)]
                u.append(m[:, 0])
                v.append(m[:, 1])
            for i in np.flatnonzero(size > 2).tolist():
                fps = values[starts[i]:ends[i]]
                if links := spanning_links(fps, max_bits):
                    at = np.array(links)
                    u.append(fps[at[:, 0]])
                    v.append(fps[at[:, 1]])
            if u:
                u, v = np.concatenate(u).view(np.int64), np.concatenate(v).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
    return run


def _block_masks(max_bits: int) -> list[int]:
    """Masks of all pairs of max_bits + 2 bit blocks: two fingerprints within max_bits agree under one of them."""
    n = max_bits + 2
    edges = [round(64 * i / n) for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [x | y for x, y in combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, max_bits: int, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fps`` (fp long): enough of them to keep every component."""
    keys = F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part"))
                     for i, m in enumerate(_block_masks(max_bits))])
    keyed = fps.select("fp", F.explode(keys).alias("x")).select("fp", F.xxhash64("x.k", "x.part").alias("key"))
    crowded = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / chunk).cast("int").alias("c"))
    mine = keyed.join(crowded, "key").withColumn("g", F.pmod(F.xxhash64("fp"), F.col("c")).cast("int"))
    # chunk g meets every chunk j (itself included) in the group (min, max)
    met = mine.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
    groups = (met.groupBy("key", F.least("g", "j").alias("a"), F.greatest("g", "j").alias("b"))
              .agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1))
    return groups.select("fps").mapInArrow(_bucket_links(max_bits), "u long, v long").distinct()


def _with_component(marked: DataFrame, max_bits: int) -> DataFrame:
    """``marked`` (doc_id, fp and more) with component_id."""
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = components(links(distinct.select("fp"), max_bits))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = staged(rooted.join(lowest, "root").select("fp", "root", "component_id"), "simhash-class")
    return marked.join(of_fp, "fp")


def simhash_components(docs: DataFrame, words: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fp (long) and component_id (smallest doc_id in reach) for every row of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)
    marked = staged(docs.select(long_id(), "text").mapInArrow(_fingerprints(words), "doc_id long, fp long"), "simhash")
    return _with_component(marked, max_bits).select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, words: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each component that has a doc_id: one of the smallest doc_id. Columns as given.

    Of several rows with that doc_id in one component, the smallest SHA-256 of the text decides; rows that share
    doc_id and text are one document, of which any one row is kept. Rows with null doc_id stay."""
    prepare(docs.sparkSession)
    keep, digest, rows = fresh(docs, "kept_id", "kept_text", "kept_rows")
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    given = docs.where(F.col("doc_id").cast("long").isNotNull())
    marked = staged(docs.select(long_id(), "text", text.alias("digest")).mapInArrow(_fingerprints(words), "doc_id long, fp long, digest string"), "simhash")
    lowest = _with_component(marked, max_bits).where(F.col("doc_id") == F.col("component_id"))
    alike = lowest.groupBy("root", "doc_id", "digest").agg(F.count("*").alias("n"))
    best = alike.groupBy("root").agg(F.min(F.struct("digest", "doc_id", "n")).alias("x"))
    kept = staged(best.select(F.col("x.doc_id").alias(keep), F.col("x.digest").alias(digest), F.col("x.n").alias(rows)), "simhash-kept")

    def of(some: DataFrame) -> DataFrame:
        return given.join(some, (F.col("doc_id").cast("long") == F.col(keep)) & (text == F.col(digest)))

    out = of(kept.where(F.col(rows) == 1)).select(*docs.columns).union(docs.where(F.col("doc_id").cast("long").isNull()))
    repeated = kept.where(F.col(rows) > 1)
    if not repeated.isEmpty():
        out = out.union(of(repeated).dropDuplicates([keep, digest]).select(*docs.columns))
    return out
