"""Token ids in ORC files: a global, ordered token stream with one row per document.

Layout: documents are dealt by range of doc_id and sorted, a file per range, so files, stripes and row groups
hold ascending ids. A row holds the range's number, the ids before it in its range, its token count and its ids.
ORC writes the integer columns in run-length encoding (bit-packed ids, ascending doc ids and starts as deltas),
keeps minimum and maximum of each stripe and row group, and a Bloom filter on doc_id. Spark's reader splits files
between stripes, so stripes are read in parallel, and skips stripes and row groups that a pushed doc_id filter
excludes by those indexes; column pruning leaves ids unread where only counts are asked.

Encoding: a text is cut before a blank or line feed that follows a character that is no white space, behind a line
feed between two such characters, and between a Latin letter or digit and a punctuation mark. No match of the
tokenizer's split pattern crosses such a place, so the cut pieces encode on their own to the whole text's ids. A
worker remembers the ids of pieces (at most ``PIECES`` of at most ``LONGEST`` characters); of those it meets for the
first time, a single word or number goes to the library's model directly, others through the whole library. Texts of
any length are read in blocks of pieces.

Defined results: null text is empty text and holds only the end id; strings of special tokens are ordinary text; a
null doc_id sorts first; repeated rows of one doc_id are rows of their own, in order of their text (documents
before a row are those of smaller ids and the earlier ones of its own); an empty table writes a folder that reads
as an empty table; extra columns are ignored.
"""
from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import long_id, prepare

SCHEMA = "range int, doc_id long, before long, n_tokens long, ids array<int>"
PIECES, LONGEST = 1_000_000, 48
BLOCK = 1 << 20
CUT = re.compile(r"(?<=\S)(?=[ \n])")
OTHER_SPACE = re.compile(r"[^\S \n]")
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"  # letters in every version of Unicode
MARK = r"!-&(-/:-@\[-`{-~"  # ASCII but the apostrophe
PLAIN = re.compile(rf"\n(?=[^ \n])|[ \n]*[0-9{LATIN}]+(?=[{MARK} \n])|[ \n]*[^ \n]+|[ \n]+")
WORD = re.compile(rf" ?(?:[{LATIN}]+|[0-9]+)")  # one match of the split pattern
# fixed values of byte-level vocabularies: printable bytes stand for themselves, the others for U+0100 and on
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(PRINTABLE)))}
BLANK = chr(BYTE_CHARS[32])


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """Parts of about ``size`` characters, cut where no token crosses."""
    start = 0
    while start < len(text):
        cut = CUT.search(text, start + size) if start + size < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def pieces_of(text: str) -> list[str]:
    return CUT.split(text) if OTHER_SPACE.search(text) else PLAIN.findall(text)


class _Pieces(dict):
    """Ids of pieces, as bytes. When full, the newer half of the entries stays."""

    def __init__(self, path: str, limit: int):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.limit, self.older = self.tokenizer.model, limit // 2, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            if WORD.fullmatch(piece):
                chars = piece.replace(" ", BLANK) if piece.isascii() else piece.encode().decode("latin-1").translate(BYTE_CHARS)
                ids = [t.id for t in self.model.tokenize(chars)]
            else:
                ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
            found = pack(f"<{len(ids)}i", *ids)
        if len(piece) <= LONGEST:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found


class PieceEncoder:
    """Ids of whole texts by a tokenizer file, through a bounded table of pieces."""

    def __init__(self, path: str, limit: int = PIECES):
        self.pieces = _Pieces(path, limit)

    def encode(self, text: str | None) -> np.ndarray:
        parts = (b"".join(map(self.pieces.__getitem__, pieces_of(block))) for block in blocks(text or ""))
        return np.frombuffer(b"".join(parts), "<i4")


_WORKER: dict = {}


def _encoder(path: str) -> PieceEncoder:
    if path not in _WORKER:
        _WORKER[path] = PieceEncoder(path)
    return _WORKER[path]


def _encode(path: str, end_id: int):
    def run(batches):
        encoder, part, before = _encoder(path), TaskContext.get().partitionId(), 0
        for b in batches:
            ids = [np.append(encoder.encode(t), np.int32(end_id)) for t in b.column("text").to_pylist()]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            ends = np.cumsum(sizes)
            flat = np.concatenate(ids or [np.zeros(0, "<i4")])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(ids), part, np.int32)), b.column("doc_id"), pa.array(before + ends - sizes),
                pa.array(sizes), pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat))],
                names=["range", "doc_id", "before", "n_tokens", "ids"])
            before += int(sizes.sum())
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, ranges: int | None = None,
                 stripe_bytes: int = 16 << 20, row_group: int = 1000, bloom_error: float = 0.01, compression: str = "zstd") -> None:
    """Write the ids of every whole text of ``docs``, each document closed by ``end_id``, as ORC files below ``path``.

    ``tokenizer_path`` is a byte-level tokenizer file that every worker can open. ``ranges`` is the number of files
    (by default the session's shuffle partitions). Rows of one doc_id are dealt by their text too, so a hot id is
    split. Texts are shuffled, not ids, so that the sampling of the ranges costs a scan and no encoding."""
    spark = docs.sparkSession
    prepare(spark)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("mark")]
    dealt = (docs.select(long_id(), F.coalesce("text", F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))
             .repartitionByRange(ranges, *order).sortWithinPartitions(*order, "text"))
    (dealt.select("doc_id", "text").mapInArrow(_encode(tokenizer_path, end_id), SCHEMA).write
     .option("compression", compression).option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", row_group)
     .option("orc.create.index", "true").option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", bloom_error)
     .orc(path))


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids from the files below ``path``; ``doc_ids`` (a literal list) is pushed to
    the indexes. A range's offset is the sum of the counts of the ranges before it: two narrow columns are read
    for it, and its table has one row per file."""
    rows = spark.read.schema(SCHEMA).orc(path)
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("range").agg(F.sum("n_tokens").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin([int(i) for i in doc_ids]))
    return rows.join(F.broadcast(offsets), "range").select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids")


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, number of ids and the CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    def run(batches):
        for b in batches:
            ids = b.column("ids")
            flat = np.asarray(ids.flatten()).astype("<i4")
            ends = np.cumsum(np.asarray(ids.value_lengths()).astype(np.int64))
            starts = np.append(0, ends)[:-1]
            crc = [zlib.crc32(flat[a:z].tobytes()) for a, z in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), pa.array(ends - starts), pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])
    prepare(tokens.sparkSession)
    return tokens.select("doc_id", "start", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder and return the digests of what they hold."""
    spark = docs.sparkSession
    path = f"{prepare(spark)}/token-orc-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer_path, end_id)
    return digests(read_tokens(spark, path))
