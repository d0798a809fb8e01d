"""Line dedup over a whole corpus with a pair of Bloom filters.

Method: every task reduces its documents' lines to 64-bit hashes, unique per Arrow batch; they are written once,
packed. A fixed share of the hash values, counted exactly, gives the number of distinct lines, and from it follow
the number of hash prefixes (segments) and the bits of a segment's filters. A small shuffle deals the hashes by
segment, and a task holds the filters of one segment at a time: a *once-seen* filter answers whether a hash came
before, and a hash that did enters the *twice-seen* filter. Once-seen filters never leave their task. A twice-seen
filter is folded in halves as long as it stays sparse, so its size follows the number of repeated lines, and all
together are broadcast. Should they exceed ``filter_bits`` they are folded further before any of them reaches the
driver. A second scan shuffles only lines that the twice-seen filters suspect; there SHA-256 keys are counted
exactly per distinct document and the surviving occurrence is chosen. False positives of the filters cost shuffle,
never results; a corpus with far more repeated lines than ``filter_bits`` can tell apart suspects more lines and
stays exact.

Defined results: null text is one empty line; a null doc_id is one unknown document that sorts below all
ids; repeated rows of one doc_id are one document (all its rows keep the line if it is the largest holder);
an empty table gives an empty result; extra columns pass through untouched; a very long text is one row of a
task, which holds its lines at once.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, prepare, staged

SPACE = b" \t\n\v\f\r"
MIN_SEGMENT_BITS = 6
SEGMENT_KEYS = 1 << 20
MAX_TASKS = 1 << 15
SAMPLED = 256
PROBES = 4
SPARSE = 0.1
UNKNOWN_ID = -(1 << 63)


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def long_keys(text: str | None, min_chars: int) -> set[bytes]:
    """Distinct keys of at least ``min_chars`` code points."""
    out = set()
    for line in (text or "").encode().split(b"\n"):
        if len(line) < min_chars:
            continue
        key = line_key(line)
        if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
            out.add(key)
    return out


def _slots(h: np.ndarray, bits) -> list[np.ndarray]:
    """Double hashing: PROBES positions below ``bits`` (powers of two, one for all or one each) for each 64-bit hash."""
    a, b, last = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(29)) | np.uint64(1), np.asarray(bits, np.uint64) - np.uint64(1)
    return [((a + np.uint64(i) * b) & last).astype(np.int64) for i in range(PROBES)]


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """The filter of ``size`` bits that holds the same hashes: positions are taken modulo a power of two."""
    while len(bits) > size:
        bits = bits[:len(bits) // 2] | bits[len(bits) // 2:]
    return bits


def fold_sparse(bits: np.ndarray) -> np.ndarray:
    """Halved while less than ``SPARSE`` of the bits are set; empty if none is."""
    if not bits.any():
        return bits[:0]
    while len(bits) > 64 and bits.mean() < SPARSE:
        bits = fold(bits, len(bits) // 2)
    return bits


class BloomPair:
    """Once-seen and twice-seen filter of one hash prefix."""

    def __init__(self, bits: int):
        self.bits, self.once, self.twice = bits, np.zeros(bits, bool), np.zeros(bits, bool)

    def add(self, h: np.ndarray, again: np.ndarray) -> None:
        """``h``: hashes without repeats; ``again``: those that the sender saw more than once."""
        slots = _slots(h, self.bits)
        seen = np.logical_and.reduce([self.once[s] for s in slots]) if len(h) else np.zeros(0, bool)
        for s in slots:
            self.twice[s[seen]] = True
            self.once[s] = True
        for s in _slots(again, self.bits):
            self.twice[s] = True


def _hash_batches(min_chars: int):
    def run(batches):
        for b in batches:
            hashes = [xxhash.xxh64_intdigest(k) for t in b.column("text").to_pylist() for k in long_keys(t, min_chars)]
            h, n = np.unique(np.array(hashes, dtype=np.uint64), return_counts=True)
            if len(h):
                share = h[h % np.uint64(SAMPLED) == 0].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([h.tobytes()], pa.binary()), pa.array([h[n > 1].tobytes()], pa.binary()),
                                                  pa.array([share], pa.list_(pa.int64()))], names=["hashes", "again", "share"])
    return run


def _segments_of(h: np.ndarray, segment_bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - segment_bits)).astype(np.int64)


def _deal(segment_bits: int):
    """Splits packed hashes, which are in ascending order, by their segment."""
    def run(batches):
        for b in batches:
            for packed, repeated in zip(*(b.column(c).to_pylist() for c in ("hashes", "again"))):
                h, again = np.frombuffer(packed, np.uint64), np.frombuffer(repeated, np.uint64)
                seg, cuts = np.unique(_segments_of(h, segment_bits), return_index=True)
                own = _segments_of(again, segment_bits)
                lo, hi = np.searchsorted(own, seg), np.searchsorted(own, seg, "right")
                yield pa.RecordBatch.from_arrays([pa.array(seg.astype(np.int32)), pa.array([p.tobytes() for p in np.split(h, cuts[1:])], pa.binary()),
                                                  pa.array([again[i:j].tobytes() for i, j in zip(lo, hi)], pa.binary())],
                                                 names=["seg", "hashes", "again"])
    return run


def _filter_segments(bits: int):
    """Twice-seen filters of a task whose rows come segment after segment."""
    def run(batches):
        at = pair = None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([_packed(fold_sparse(pair.twice))], pa.binary())],
                                              names=["seg", "twice"])

        for b in batches:
            for s, h, again in zip(*(c.to_pylist() for c in b.columns)):
                if s != at:
                    if pair is not None:
                        yield out()
                    at, pair = s, BloomPair(bits)
                pair.add(np.frombuffer(h, np.uint64), np.frombuffer(again, np.uint64))
        if pair is not None:
            yield out()
    return run


def _packed(bits: np.ndarray) -> bytes:
    return np.packbits(bits, bitorder="little").tobytes()


def _fold_to(size: int):
    def run(batches):
        for b in batches:
            rows = [_packed(fold(np.unpackbits(np.frombuffer(f, np.uint8), bitorder="little").view(bool), size)) for f in b.column("twice").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("seg"), pa.array(rows, pa.binary())], names=["seg", "twice"])
    return run


def _suspected(filters: tuple, h: np.ndarray) -> np.ndarray:
    """Which hashes the twice-seen ``filters`` (``side_by_side``) suspect."""
    starts, sizes, data = filters
    seg = _segments_of(h, len(starts).bit_length() - 1)
    out = sizes[seg] > 0
    at = np.flatnonzero(out)
    seg = seg[at]
    for p in _slots(h[at], sizes[seg]):
        out[at] &= ((data[starts[seg] + (p >> 3)] >> (p & 7)) & 1).astype(bool)
    return out


def side_by_side(filters: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and bits of each segment's filter, and the bytes of all."""
    sizes = np.array([len(filters[s]) for s in range(len(filters))], np.int64)
    return np.cumsum(sizes) - sizes, sizes * 8, np.frombuffer(b"".join(filters[s] for s in range(len(filters))), np.uint8)


def _suspect_rows(bc, min_chars: int):
    def run(batches):
        filters = bc.value
        for b in batches:
            keys, ids = [], []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                own = long_keys(t, min_chars)
                keys += own
                ids += [i] * len(own)
            if not keys:
                continue
            ok = _suspected(filters, np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys)))
            at = np.flatnonzero(ok).tolist()
            yield pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(keys[k]).digest() for k in at], pa.binary()),
                                              pa.array([ids[k] for k in at], pa.int64())], names=["key", "doc_id"])
    return run


def _rewrite(min_chars: int):
    def run(batches):
        for b in batches:
            text, total, dropped = [], [], []
            for t, drop in zip(b.column("text").to_pylist(), b.column("drop").to_pylist()):
                t = t or ""
                n = t.count("\n") + 1
                if drop:
                    gone, keep = set(drop), []
                    for line in t.encode().split(b"\n"):
                        key = line_key(line) if len(line) >= min_chars else b""
                        if len(key) < min_chars or hashlib.sha256(key).digest() not in gone:
                            keep.append(line)
                    text.append(b"\n".join(keep).decode())
                    dropped.append(n - len(keep))
                else:
                    text.append(t)
                    dropped.append(0)
                total.append(n)
            rest = [c for c in b.schema.names if c not in ("text", "drop")]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in rest] + [pa.array(text, pa.string()), pa.array(total, pa.int64()),
                                              pa.array(dropped, pa.int64())], names=[*rest, "text", "n_lines", "n_dropped"])
    return run


def segment_plan(distinct: int) -> tuple[int, int]:
    """Bits of the segment number and bits of a segment's filters for ``distinct`` line hashes: eight bits a hash."""
    segment_bits = max(MIN_SEGMENT_BITS, (max(distinct, 1) // SEGMENT_KEYS).bit_length())
    return segment_bits, 1 << max(10, (8 * distinct >> segment_bits).bit_length())


def twice_seen(docs: DataFrame, min_chars: int, filter_bits: int) -> dict[int, bytes]:
    """The twice-seen filters by segment, empty where nothing repeats: at most ``filter_bits`` / 8 bytes in all
    (a filter that has any bit takes 8 bytes at least), whatever the input."""
    packed = staged(docs.select("text").mapInArrow(_hash_batches(min_chars), "hashes binary, again binary, share array<long>"), "line-hashes")
    share = packed.select(F.explode("share").alias("h")).agg(F.countDistinct("h")).first()[0]
    segment_bits, bits = segment_plan(share * SAMPLED)
    segments = 1 << segment_bits
    dealt = packed.mapInArrow(_deal(segment_bits), "seg int, hashes binary, again binary").repartition(min(segments, MAX_TASKS), "seg")
    filters = staged(dealt.sortWithinPartitions("seg").mapInArrow(_filter_segments(bits), "seg int, twice binary"), "line-filters")
    if (filters.agg(F.sum(F.octet_length("twice"))).first()[0] or 0) * 8 > filter_bits:
        size = 1 << (max(64, filter_bits // segments).bit_length() - 1)
        filters = filters.mapInArrow(_fold_to(size), "seg int, twice binary")
    return dict.fromkeys(range(segments), b"") | {r.seg: bytes(r.twice) for r in filters.collect()}


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, filter_bits: int = 1 << 28) -> DataFrame:
    """``docs`` (doc_id, text, ...) with repeated lines dropped from ``text``, plus n_lines and n_dropped.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased. Keys of at least ``min_chars``
    code points held by at least ``min_docs`` documents stay only in the largest doc_id. ``filter_bits``
    (a power of two) bounds the broadcast filters: 32 MB by default; what they take follows the repeated lines.
    """
    spark = docs.sparkSession
    prepare(spark)
    slim = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(UNKNOWN_ID)).alias("doc_id"), "text")
    bc = spark.sparkContext.broadcast(side_by_side(twice_seen(slim, min_chars, filter_bits)))
    held = staged(slim.mapInArrow(_suspect_rows(bc, min_chars), "key binary, doc_id long").distinct(), "line-suspects")
    # written first, so that the join reads two plain exchanges, which Spark can split at a hot line
    common = staged(held.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep"))
                    .where(F.col("n") >= min_docs).select("key", "keep"), "line-common")
    drops = (held.join(common, "key").where(F.col("doc_id") != F.col("keep"))
             .groupBy("doc_id").agg(F.collect_list("key").alias("drop")))
    # own names inside, so that extra columns may be called anything
    order = docs.columns
    names = {c: f"c{i}" for i, c in enumerate(order) if c not in ("doc_id", "text")}
    extra = [F.col(f"`{c}`").alias(n) for c, n in names.items()]
    base = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(UNKNOWN_ID)).alias("join_id"), *extra)
    joined = base.join(drops.withColumnRenamed("doc_id", "join_id"), "join_id", "left").drop("join_id")
    fields = [f for f in joined.schema.fields if f.name not in ("text", "drop")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", text string, n_lines long, n_dropped long"
    out = joined.mapInArrow(_rewrite(min_chars), schema)
    n_lines, n_dropped = fresh(docs, "n_lines", "n_dropped")
    back = [F.col(names.get(c, c)).alias(c) for c in order]
    return out.select(*back, F.col("n_lines").alias(n_lines), F.col("n_dropped").alias(n_dropped))
