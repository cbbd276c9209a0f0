"""A corpus from documents to token ids, in five stages.

Every stage takes (spark, docs, sf_dir) and judges all rows that the stage
before kept. All but the last return the columns of documents; null and empty
texts, repeated rows and extra columns are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from packetloom.llm import bpe, decontamination, importance, near_duplicates, secrets
from packetloom.llm.queries import ship_package, table, tokenizer_file
from packetloom.session import materialise

# The stages depend on models of the whole corpus and on a tokenizer, which SQL cannot state.
ORACLE_SQL = None

SHINGLE_WORDS = 5  # fixed value: width of the near-duplicate stage's shingles


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws."""
    ship_package(spark)
    return importance.drawn_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates by shingles of SHINGLE_WORDS words."""
    ship_package(spark)
    return near_duplicates.one_of_each_group(docs, width=SHINGLE_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    ship_package(spark)
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return secrets.redacted(docs, complete=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, with digests of ids and of the decoded text."""
    ship_package(spark)
    return bpe.encoded_documents(docs, tokenizer_file("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicate),
    ("benchmark decontamination", decontaminate),
    ("secret scans", secret),
    ("byte-level BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline-{i}")
    return docs
