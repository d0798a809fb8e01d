"""Corpus pipeline over ``documents``: each stage calls one operator of ``shelfwise.llm`` with its production
parameters, and works on all rows that its predecessor kept.

Rows with null text count as empty documents; a null doc_id is judged like any other row (and never merged
with another document); extra columns of ``documents`` pass through every stage but the last.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import bpe, decontam, lines, quality, simhash
from shelfwise.llm.common import staged
from shelfwise.llm.queries import QUALITY_FOLD, held_out
from shelfwise.sources.tables import read_table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality classifier accepts."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"), ~held_out(*QUALITY_FOLD))
    scored = quality.score_documents(docs, model)
    return scored.where(F.col(scored.columns[-1]) == 1).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that many documents share, but in the largest doc_id; n_chars follows the text."""
    out = lines.dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near copies: 3-word shingles, at most 3 differing bits."""
    return simhash.near_dedup(docs, words=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark windows of 13 words make at least 5 % of the words."""
    judged = decontam.scan_documents(docs, read_table(spark, sf_dir, "benchmark"), n=13)
    return judged.where(~F.col(judged.columns[-1])).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and their digests."""
    import public_tokenizers
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [("quality classifier", quality_filter), ("line dedup", line_dedup), ("SimHash near-dedup", near_dedup),
          ("benchmark decontamination", decontaminate), ("byte-level BPE", tokenize)]
#: the classifier, SimHash and byte-level BPE have no SQL form; tests/llm/test_pipeline.py has a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
