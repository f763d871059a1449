"""The corpus pipeline: quality rules, near duplicates, decontamination, PII, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet to the shared checkpoint folder and read again as the next
stage's ``docs``. All but the last return the columns of their input. Rows
are handled as the operators state: null texts are empty, repeated rows stay
repeated except where one document of a group of near duplicates stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.llm import decontamination, ngram_join, packing, pii, quality_rules
from quillrank.llm.common import Scratch, table
from quillrank.llm.queries import PII_KEY, WORD_BPE


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that base rules and isolation forest keep."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of 5-word shingle sets with a Jaccard of 0.8 or more."""
    return ngram_join.keep_first(docs, 5, 8, 10)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without verified overlap with a test item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; ``n_chars``, where there is one, is counted anew."""
    out = pii.replace_pii(docs, PII_KEY, count="__mentions")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__mentions") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, with the CRC-32 of their ids."""
    pieces = packing.pack(docs, public_tokenizers.path(WORD_BPE))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", benchmark), ("PII", private), ("packing", packed)]
#: SQL has no isolation forest, keyed surrogates or tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote is deleted once the next one is written."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            scratch.drop(f"stage{k - 1}")
    return docs
