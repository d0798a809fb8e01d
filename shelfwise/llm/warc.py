"""WARC archives written and read by Spark, with an external merge of the capture index.

Writing: Spark's text writer with the record terminator CRLF CRLF as line separator and gzip, one record per
row: version line, headers, blank line, payload. That is a WARC 1.1 file on any storage that Spark reaches.
A payload of at least ``min_bytes`` that occurs several times is stored once, in the record of its largest
page_id; the others are revisit records without body that name it. Reading: gzip files are never split, so a
task reads a file's separator-delimited pieces in order and reassembles records by Content-Length, holding
one record at a time; payload sizes and SHA-1 digests come from the bytes read.

Index: each reading task emits its captures as locally sorted runs of ``RUN`` rows, which are written. Revisits
get the size of their response, then the runs are dealt by range of (url key, timestamp, page_id, run), so a hot
URL or host splits over tasks and rows equal in all of these still split by run; the number of ranges follows the
number of captures. Inside a range Spark's spilling sort lays out runs as blocks of ``block`` rows, ordered by
their first key: that is the order in which a merge needs them. A loser tree merges ``fan_in`` runs with one block
of each in memory; more runs take more passes, each leaving ``fan_in`` times fewer, until one is left.
Partitions in order form the global capture history, which is what ``archive`` returns.

Defined results: null html is an empty payload; null url has an empty key; rows with one page_id are all
written, and if they share the payload of the response all of them are responses; null page_id sorts below
all and is written without number; an empty table gives no captures; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
import itertools
import re
import uuid
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import long_id, prepare, staged

CRLF = b"\r\n"
BREAK = b"\r\n\r\n"
RUN = 4096
BLOCK = 512
FAN_IN = 32
RANGE_ROWS = 1 << 17
BLOCKS = "run long, no long, url_key string, ts string, page_id long, rows binary"
INDEX = "url_key string, ts string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def plan_records(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """page_id, url, html, digest, size, record_type, refers_to."""
    rows = pages.select(long_id("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.select("*", F.sha1(F.encode("html", "UTF-8")).alias("digest"), F.octet_length("html").cast("long").alias("size"))
    large = F.col("size") >= min_bytes
    shared = (rows.where(large).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("digest", "first"))
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (rows.join(shared, "digest", "left")
            .select("page_id", "url", "html", "digest", "size", F.when(again, "revisit").otherwise("response").alias("record_type"),
                    F.when(again, F.col("first")).alias("refers_to")))


def record_text(epoch: str = "2024-01-01") -> "F.Column":
    """One WARC record as text, without the closing separator. The capture time is ``epoch`` plus page_id seconds."""
    when = F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(f"{epoch} 00:00:00")) + F.coalesce("page_id", F.lit(0)) % F.lit(10 ** 9)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    # a URL is a header value: white space, control characters and % are percent-encoded
    uri = F.replace(F.replace(F.replace(F.replace("url", F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(" "), F.lit("%20"))
    head = F.concat_ws("\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "record_type"), F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
                       F.concat(F.lit("WARC-Date: "), when), F.concat(F.lit("WARC-Target-URI: "), uri), F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
                       F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("refers_to")))),
                       F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                       F.lit("Content-Type: text/html; charset=utf-8"), F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")))
    return F.concat(head, F.lit("\r\n\r\n"), body).alias("value")


def write_warc(records: DataFrame, path: str) -> None:
    records.select(record_text()).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def records(pieces):
    """(headers, payload) of a stream of separator-delimited pieces; skips separators left between files."""
    head, want, got, size = None, 0, [], 0
    for piece in pieces:
        data = piece + BREAK
        while data:
            if head is None:
                data = data.lstrip(CRLF)
                if not data:
                    break
                at = data.index(BREAK)
                fields = data[:at].split(CRLF)
                if not fields[0].startswith(b"WARC/"):
                    raise ValueError(f"not a WARC record: {fields[0][:80]!r}")
                head = {k.lower(): v.strip() for k, _, v in (f.partition(b":") for f in fields[1:])}
                want, got, size = int(head[b"content-length"]), [], 0
                data = data[at + len(BREAK):]
            take = data[:want - size]
            got.append(take)
            size += len(take)
            data = data[len(take):]
            if size < want:
                break
            yield head, b"".join(got)
            head = None
    if head is not None:
        raise ValueError("a WARC file ends inside a record")


def url_key(url: str) -> str:
    """Sort key of a URL: host labels reversed, then port, path and query."""
    try:
        s = urlsplit(url)
        host, port = s.hostname or "", f":{s.port}" if s.port else ""
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    host = re.sub(r"^www\d*\.", "", host)
    return ",".join(reversed(host.split("."))) + port + ")" + (s.path or "/") + (f"?{s.query}" if s.query else "")


def _number(urn: bytes) -> int | None:
    digits = urn[len(b"<urn:page:"):-1]
    return int(digits) if digits else None


def _plain(uri: str) -> str:
    return re.sub("%(25|0D|0A|20)", lambda m: chr(int(m[1], 16)), uri)


def _captures(batches):
    """Index rows of the archives read by this task, in sorted runs of RUN rows numbered per task."""
    def pieces():
        for b in batches:
            yield from b.column("value").to_pylist()

    task, n, run = uuid.uuid4().hex, 0, []

    def out():
        run.sort(key=_order)
        cols = list(zip(*run))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()))]
            + [pa.array([f"{task}-{n}"] * len(run), pa.string()), pa.array(range(len(run)), pa.int32())],
            names=["url_key", "ts", "page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "run", "seq"])

    for head, body in records(pieces()):
        url = _plain(head[b"warc-target-uri"].decode())
        kind = head[b"warc-type"].decode()
        if kind == "response":
            own = (len(body), hashlib.sha1(body).hexdigest(), None)
        else:  # the size is the response's, joined before the merge
            own = (None, head[b"warc-payload-digest"].decode().removeprefix("sha1:"), _number(head[b"warc-refers-to"]))
        run.append((url_key(url), head[b"warc-date"].decode(), _number(head[b"warc-record-id"]), url, kind, *own))
        if len(run) == RUN:
            yield out()
            n, run = n + 1, []
    if run:
        yield out()


def _order(row) -> tuple:
    return row[0].encode(), row[1], row[2] is not None, row[2] or 0


class LoserTree:
    """Merge of k sorted iterators: inner nodes hold the loser of their match, so each row costs log2 k comparisons."""

    END = (1,)

    def __init__(self, runs: list, key):
        self.runs, self.key, self.k = [iter(r) for r in runs], key, len(runs)
        self.rows = [None] * self.k
        self.keys = [self._next(i) for i in range(self.k)]
        self.losers = [0] * max(self.k, 1)
        self.winner = self._build(1) if self.k else 0

    def _next(self, i):
        row = next(self.runs[i], None)
        self.rows[i] = row
        return self.END if row is None else (0, self.key(row), i)

    def _build(self, node: int) -> int:
        """Plays the matches below ``node``; leaves are nodes k .. 2k-1."""
        if node >= self.k:
            return node - self.k
        a, b = self._build(2 * node), self._build(2 * node + 1)
        win, lose = (a, b) if self.keys[a] <= self.keys[b] else (b, a)
        self.losers[node] = lose
        return win

    def open(self, i: int, rows) -> None:
        """Gives the exhausted run ``i`` further rows."""
        self.runs[i] = iter(rows)
        self.keys[i] = self._next(i)
        self.winner = self._build(1)

    def __iter__(self):
        return self.until(None)

    def until(self, last):
        """The rows up to key ``last``, all without one."""
        while self.k and self.rows[self.winner] is not None and (last is None or self.keys[self.winner][1] <= last):
            yield self.rows[self.winner]
            w = self.winner
            self.keys[w] = self._next(w)
            node = (w + self.k) // 2
            while node >= 1:
                if self.keys[self.losers[node]] < self.keys[w]:
                    w, self.losers[node] = self.losers[node], w
                node //= 2
            self.winner = w


def _block(run: int, no: int, rows: pa.RecordBatch) -> pa.RecordBatch:
    """A row of BLOCKS: sorted rows of one run, named by the first key."""
    first = [rows.column(c)[0].as_py() for c in ("url_key", "ts", "page_id")]
    data = rows.serialize().to_pybytes()
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((run, no, *first, data), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()))],
                                      names=["run", "no", "url_key", "ts", "page_id", "rows"])


def _index_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(c, kinds[t]) for c, t in (f.split() for f in INDEX.split(", "))])


def _batches(rows, size: int):
    """Record batches of ``size`` index rows."""
    schema, rows = _index_schema(), iter(rows)
    while some := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def _cut_blocks(size: int):
    """Blocks of the runs of a partition sorted by (run, seq); runs are numbered from 0 in that order."""
    def run(batches):
        schema = _index_schema()
        rows = (r for b in batches for r in zip(b.column("run").to_pylist(), *(b.column(c).to_pylist() for c in schema.names)))
        for number, (_, of_run) in enumerate(itertools.groupby(rows, lambda r: r[0])):
            for no, block in enumerate(_batches((r[1:] for r in of_run), size)):
                yield _block(number, no, block)
    return run


def _merged(blocks, fan_in: int):
    """Rows of the runs whose ``blocks`` come in the order of their first keys, one block of each run in memory."""
    schema, tree = _index_schema(), LoserTree([()] * fan_in, _order)
    for run, rows in blocks:
        batch = pa.ipc.read_record_batch(pa.py_buffer(rows), schema)
        fresh_rows = list(zip(*(c.to_pylist() for c in batch.columns)))
        # all that is still to come sorts at or after this block, so the run's block before is used up by then
        yield from tree.until(_order(fresh_rows[0]))
        tree.open(run % fan_in, fresh_rows)
    yield from tree


def _merge_pass(fan_in: int, size: int):
    """Merges each group of ``fan_in`` neighbouring runs of a partition into one."""
    def run(batches):
        rows = (r for b in batches for r in zip(b.column("run").to_pylist(), b.column("rows").to_pylist()))
        for group, blocks in itertools.groupby(rows, lambda r: r[0] // fan_in):
            for no, block in enumerate(_batches(_merged(blocks, fan_in), size)):
                yield _block(group, no, block)
    return run


def _last_pass(fan_in: int, size: int):
    def run(batches):
        rows = (r for b in batches for r in zip(b.column("run").to_pylist(), b.column("rows").to_pylist()))
        yield from _batches(_merged(rows, fan_in), size)
    return run


def read_runs(spark, path: str) -> DataFrame:
    """Captures of the archives in ``path`` as written sorted runs; revisits without size."""
    raw = spark.read.option("lineSep", "\r\n\r\n").text(path).select(F.encode("value", "UTF-8").alias("value"))
    return staged(raw.mapInArrow(_captures, INDEX + ", run string, seq int"), "capture-runs")


def fill_sizes(runs: DataFrame) -> DataFrame:
    """Revisits get the payload size of the response they name."""
    size = (runs.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
            .agg(F.max("payload_bytes").alias("full")))
    known = runs.where("record_type = 'response'")
    filled = runs.where("record_type = 'revisit'").join(size, ["refers_to", "payload_digest"], "left")
    filled = filled.select(*[F.col("full").alias(c) if c == "payload_bytes" else F.col(c) for c in runs.columns])
    return staged(known.union(filled), "capture-sizes")


def merge_passes(runs: int, fan_in: int) -> int:
    """Passes before the last one, which merges what then are at most ``fan_in`` runs."""
    passes = 0
    while runs > fan_in:
        runs, passes = -(-runs // fan_in), passes + 1
    return passes


def merge_runs(runs: DataFrame, fan_in: int = FAN_IN, block: int = BLOCK, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The written ``runs`` merged: globally ordered by (url_key, ts, page_id) over the partitions."""
    n, most = runs.agg(F.count("*"), F.count(F.when(F.col("seq") == 0, 1))).first()
    ranges = max(1, -(-n // range_rows))
    dealt = runs.repartitionByRange(ranges, "url_key", "ts", "page_id", "run", "seq").sortWithinPartitions("run", "seq")
    blocks = dealt.mapInArrow(_cut_blocks(block), BLOCKS)
    order = ["url_key", "ts", "page_id", "run", "no"]
    for _ in range(merge_passes(most, fan_in)):
        by_group = blocks.sortWithinPartitions(F.floor(F.col("run") / fan_in), *order)
        blocks = by_group.mapInArrow(_merge_pass(fan_in, block), BLOCKS)
    return blocks.sortWithinPartitions(*order).mapInArrow(_last_pass(fan_in, RUN), INDEX)


def read_index(spark, path: str) -> DataFrame:
    """Captures of the archives in ``path``, globally ordered by (url_key, ts, page_id) over the partitions."""
    return merge_runs(fill_sizes(read_runs(spark, path)))


def archive(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Writes ``pages`` as WARC, reads them back and returns the capture history in global order."""
    spark = pages.sparkSession
    path = f"{prepare(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(plan_records(pages, min_bytes), path)
    return read_index(spark, path)
