"""Target-distribution importance resampling over hashed word features.

Features are all runs of 1 to ``max_n`` consecutive words, repeats counted; a feature's bucket is the CRC-32 of
its bytes modulo ``buckets``. A bucket's gain compares its share in the target texts with its share in all
documents, a document's weight is the sum of gains over its features, and the documents of highest weight plus
seeded Gumbel noise are drawn.

CRCs are computed in length-bucketed matrices: the distinct features of an Arrow batch are grouped by equal byte
length into two-dimensional uint8 arrays, all CRCs of an array are updated together column by column, and the
results are scattered back to the features' places. Features of more than ``LONG`` bytes, whose arrays would
have a row or two, take the standard library's CRC.

Plan: one scan counts buckets (one array per task, its non-zero entries summed in a shuffle of at most
``buckets`` rows a task), a second scan weighs documents. Gains are one array of ``buckets`` numbers. The draw
numbers only rows above an approximate quantile that is checked to leave enough of them; ranges of the score plus
partition offsets give the ranks, so no task sees more than its range.

Defined results: null text has no words; a document without features weighs 0; documents of fewer than
``min_words`` words are scored and never drawn; a null doc_id is scored with the empty noise key and ranks after
equal scores of known ids; repeated rows are documents of their own; empty tables give empty results or gains
against an empty target; texts of any length are read in blocks cut between words; extra columns are ignored.
"""
from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from .common import long_id, prepare, staged

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
BLOCK = 1 << 22
LONG = 1024
CELLS = 1 << 22


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


TABLE = _crc_table()


def crc32_matrices(features: list[bytes]) -> np.ndarray:
    """Unsigned CRC-32 of every feature, computed for all features of one byte length at a time."""
    sizes = np.fromiter(map(len, features), np.int64, len(features))
    out = np.zeros(len(features), np.uint32)
    order = np.argsort(sizes, kind="stable")
    lengths, firsts = np.unique(sizes[order], return_index=True)
    for length, first, last in zip(lengths, firsts, [*firsts[1:], len(order)]):
        if length > LONG:
            for i in order[first:last]:
                out[i] = zlib.crc32(features[i])
            continue
        step = max(1, CELLS // max(int(length), 1))
        for a in range(first, last, step):
            rows = order[a:min(a + step, last)]
            matrix = np.frombuffer(b"".join([features[i] for i in rows]), np.uint8).reshape(len(rows), length)
            crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
            for column in np.ascontiguousarray(matrix.T):
                crc = TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
            out[rows] = ~crc
    return out


def words_in_blocks(data: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """Words of ``data``, a list per block; blocks end between words."""
    start = 0
    while start < len(data):
        gap = GAP.search(data, start + size) if start + size < len(data) else None
        end = gap.start() if gap else len(data)
        yield WORD.findall(data, start, end)
        start = end


def feature_counts(text: str | None, max_n: int, size: int = BLOCK) -> tuple[int, Counter]:
    """Number of words, and how often each feature occurs."""
    counts, n_words, carry = Counter(), 0, []
    for words in words_in_blocks((text or "").encode().lower(), size):
        n_words += len(words)
        counts.update(words)
        joined = carry + words
        for n in range(2, max_n + 1):  # runs that end in this block
            first = max(len(carry) - n + 1, 0)
            counts.update(map(b" ".join, zip(*(joined[first + k:] for k in range(n)))))
        carry = joined[max(len(joined) - max_n + 1, 0):]
    return n_words, counts


def _batch_buckets(texts: list, max_n: int, buckets: int):
    """Per text: number of words, buckets of its distinct features, their counts."""
    counted = [feature_counts(t, max_n) for t in texts]
    place: dict[bytes, int] = {}
    for _, counts in counted:
        for f in counts:
            place.setdefault(f, len(place))
    of = (crc32_matrices(list(place)) % np.uint32(buckets)).astype(np.int64)
    for n_words, counts in counted:
        at = np.fromiter(map(place.__getitem__, counts), np.int64, len(counts))
        yield n_words, of[at], np.fromiter(counts.values(), np.int64, len(counts))


def bucket_counts(texts: DataFrame, max_n: int, buckets: int) -> np.ndarray:
    """Number of features of column ``text`` in each bucket, over all rows."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, at, n in _batch_buckets(b.column("text").to_pylist(), max_n, buckets):
                np.add.at(total, at, n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])
    prepare(texts.sparkSession)
    sums = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():  # at most ``buckets`` rows
        out[r.bucket] = r.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousand times the log ratio of smoothed shares, rounded down."""
    b, all_s, all_t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (all_s + b) / ((float(s) + 1) * (all_t + b))))
                     for s, t in zip(source, target)], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, max_n: int) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""
    buckets = len(gains)

    def run(batches):
        for b in batches:
            rows = [(n_words, int(n.sum()), int((gains[at] * n).sum()))
                    for n_words, at, n in _batch_buckets(b.column("text").to_pylist(), max_n, buckets)]
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], names=["doc_id", "n_words", "n_features", "weight"])
    prepare(docs.sparkSession)
    return docs.select(long_id(), "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int):
    """Gumbel noise in thousandths, fixed by the document's id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, max_n: int = 1, buckets: int = 10_000, seed: int = 2024,
             min_words: int = 20, percent: int = 10, accuracy: int = 1000) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (1, 2, ... of the drawn documents, else null) of every
    row of ``docs``. Drawn are ``percent`` per cent, rounded down, of the documents of ``min_words`` words or more."""
    gains = bucket_gains(bucket_counts(docs, max_n, buckets), bucket_counts(target, max_n, buckets))
    scored = staged(weigh(docs, gains, max_n).withColumn("score", (F.col("weight") + noise(seed)).cast("long"))
                    .withColumn("tie", F.monotonically_increasing_id()), "resample-scores")
    eligible = scored.where(F.col("n_words") >= min_words)
    share = max(0.0, 1 - percent / 100 - 2 / accuracy)
    n, low = eligible.agg(F.count(F.lit(1)), F.percentile_approx("score", share, accuracy)).first()
    drawn = percent * n // 100
    unranked = F.lit(None).cast("long")
    if not drawn:
        return scored.withColumn("rank", unranked).drop("tie")
    high = (F.col("n_words") >= min_words) & (F.col("score") >= low)
    if scored.where(high).count() < drawn:  # beyond the stated error of the quantile
        high = F.col("n_words") >= min_words
    numbered = number_rows(scored.where(high), [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("tie")], "rank")
    kept = numbered.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank").cast("long")))
    return kept.unionByName(scored.where(~high).withColumn("rank", unranked)).drop("tie")


def drawn_documents(docs: DataFrame, selection: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id was drawn."""
    ids = selection.where(F.col("rank").isNotNull()).select("doc_id").distinct()
    return docs.join(ids, docs["doc_id"].cast("long").eqNullSafe(ids["doc_id"]), "left_semi")
