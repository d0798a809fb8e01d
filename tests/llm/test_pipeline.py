import hashlib
import re
import zlib

import numpy as np
import pandas as pd
import tiktoken

import corpus_pipeline
import public_tokenizers
from shelfwise.llm import bpe, quality
from tests.llm.test_decontam import brute as decontam_brute
from tests.llm.test_lines import brute as lines_brute
from tests.llm.test_simhash import brute as simhash_brute

SF = "/root/testdata/sf0.001"


def test_stages_and_run_match_a_plain_version(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id").quality
    bench = pd.read_parquet(f"{SF}/benchmark.parquet")
    stats = {i: quality.statistics(t) for i, t in zip(docs.doc_id, docs.text)}
    known = [i for i in docs.doc_id if i in labels.index and zlib.crc32(str(i).encode()) % 3 != 1]
    x, y = np.array([stats[i] for i in known]), np.array([labels[i] for i in known], float)
    order = np.lexsort(x.T)
    model = quality.fit(x[order], y[order])
    rows = [(i, t) for i, t in zip(docs.doc_id, docs.text) if model.score(np.array([stats[i]]))[0] >= 0.5]
    rows = [(i, t) for i, _, _, t in lines_brute(rows)]
    keep = {c for _, _, c in simhash_brute(rows)}
    rows = [r for r in rows if r[0] in keep]
    bad = {r[0] for r in decontam_brute(rows, list(zip(bench.item_id, bench.text))) if r[-1]}
    rows = [r for r in rows if r[0] not in bad]
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    got = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len(got) < len(docs)
    assert sorted((r.doc_id, r.ids) for r in got) == sorted((i, enc.encode_ordinary(t)) for i, t in rows)
    assert {r.decoded_sha256 for r in got} == {hashlib.sha256(t.encode()).hexdigest() for _, t in rows}


def test_stages_keep_columns_and_take_odd_rows(spark, docs_of):
    docs = docs_of([(1, "A clean sentence of ordinary words, written once. " * 3), (2, None), (None, ""), (1, "A clean sentence of ordinary words, written once. " * 3)])
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, some, SF)
            assert out.columns == docs.columns, name
            out.collect()
    assert re.fullmatch("[a-z0-9A-Z -]+", corpus_pipeline.STAGES[-1][0])
