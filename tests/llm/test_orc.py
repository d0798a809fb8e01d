import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyarrow import orc as reader
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm import orc

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [" ", "  ", "\n", "\t", "　", "\x1c", "\x85", "\xa0", "a", "é", "日本", "!", "'s", "'", "1", "23", "<|endoftext|>", "\r", "​",
       "\U0001F600", "a,", "b.c", "x;", "é!", "ß:", "9.", "don't", "ab", "ſ", "ŉ", "$$$", "x&&", "\n\n", "9-9", "a_b", "(c)", "\nw"]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def brute(rows, plain):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = plain(text or "") + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_pieces_encode_like_whole_texts(plain, monkeypatch):
    rng, encoder = random.Random(5), orc.PieceEncoder(PATH, limit=300)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 16))) for _ in range(4000)]
    assert [encoder.encode(t).tolist() for t in texts] == [plain(t) for t in texts]
    monkeypatch.setattr(orc.blocks, "__defaults__", (7,))
    assert [encoder.encode(t).tolist() for t in texts[:1500]] == [plain(t) for t in texts[:1500]]
    assert all("".join(orc.blocks(t, 5)) == t for t in texts)


def test_written_files_give_the_stream_back(docs_of, plain):
    rng = random.Random(2)
    rows = [(i * 3 - 50, " ".join(rng.choices(["token", "ids,", "Ünï", "<|endoftext|>", "\n"], k=rng.randint(0, 40)))) for i in range(120)]
    rows += [(1000, None), (1001, ""), (1002, "long text " * 60000), (None, "no id")]
    rng.shuffle(rows)
    got = orc.round_trip(docs_of(rows), PATH).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows, plain), key=str)


def test_repeated_ids_are_dealt_and_ordered(docs_of, plain):
    rows = [(5, f"text {i % 40}") for i in range(300)] + [(1, "first"), (9, "last")]
    got = sorted(map(tuple, orc.round_trip(docs_of(rows), PATH).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [1] + [5] * 300 + [9]
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in brute(rows, plain))


def test_empty_table(docs_of):
    assert orc.round_trip(docs_of([]), PATH).collect() == []


def _rows_out_of_scan(df):
    df.collect()
    stack, seen = [df._jdf.queryExecution().executedPlan()], []
    while stack:
        p = stack.pop()
        if "AdaptiveSparkPlan" in p.nodeName():
            stack.append(p.executedPlan())
            continue
        if p.nodeName().startswith("Scan orc"):
            seen.append(p.metrics().apply("numOutputRows").value())
        for k in range(p.children().size()):
            stack.append(p.children().apply(k))
        if hasattr(p, "plan") and "QueryStage" in p.nodeName():
            stack.append(p.plan())
    return seen


def test_indexes_prune_stripes_and_row_groups(spark, docs_of, tmp_path):
    path = f"{tmp_path}/tokens"
    docs = spark.range(40_000).select((F.col("id") * 2).alias("doc_id"), F.concat_ws(" ", F.lit("text of"), "id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 3)).alias("text"))
    orc.write_tokens(docs, path, PATH, ranges=2, stripe_bytes=1 << 18, row_group=1000)
    rows = spark.read.schema(orc.SCHEMA).orc(path)
    files = sorted(glob.glob(path + "/*.orc"))
    assert len(files) == 2 and all(reader.ORCFile(f).nstripes > 1 for f in files)
    assert _rows_out_of_scan(rows) == [40_000]
    one = rows.where("doc_id = 30000")
    assert "EqualTo(doc_id,30000)" in one._jdf.queryExecution().toString()
    assert 1 <= _rows_out_of_scan(one)[0] <= 2000  # its row group, by the minimum and maximum
    absent = [int(i) for i in range(20_001, 20_041, 2)]  # within the range of a row group: only the Bloom filter knows
    assert sum(_rows_out_of_scan(rows.where(F.col("doc_id") == i))[0] == 0 for i in absent) >= 17


def test_lookup_and_split_reads_equal_the_whole(spark, docs_of, tmp_path):
    path = f"{tmp_path}/tokens"
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some text of"), "id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 3)).alias("text"))
    orc.write_tokens(docs, path, PATH, ranges=2, stripe_bytes=1 << 16)
    whole = {r.doc_id: tuple(r) for r in orc.digests(orc.read_tokens(spark, path)).collect()}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 40_000)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        split = spark.read.schema(orc.SCHEMA).orc(path)
        busy = split.groupBy(F.spark_partition_id()).count().count()
        assert busy > 2  # more tasks with rows than files: stripes of a file are read apart
        assert {r.doc_id: tuple(r) for r in orc.digests(orc.read_tokens(spark, path)).collect()} == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    some = {r.doc_id: tuple(r) for r in orc.digests(orc.read_tokens(spark, path, [3, 19_999, 70_000])).collect()}
    assert some == {i: whole[i] for i in (3, 19_999)}
