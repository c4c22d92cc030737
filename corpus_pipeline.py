"""From raw documents to packed training sequences, one stored table after the other.

STAGES are (name, function) pairs. Each function takes (spark, docs, sf_dir) and returns a
DataFrame; all but the last return the columns of documents. ``run`` writes the result of
each stage to the shared folder and rereads it as the input of the next, so a lost
executor costs at most part of the stage that runs.

A null text is an empty one: it has fewer words than the rules ask for. An empty table
gives empty results in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scholarweave.llm import packing, quality_rules, secrets, simhash
from scholarweave.llm.queries import WORD_BPE
from scholarweave.workspace import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the word rules and the compression bands."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, the one with the smallest id."""
    return simhash.keep_one_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret and n_chars of the new text."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, WORD_BPE)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

# SQL can express neither the compression ratios nor the hashes nor the tokenizer; the
# tests compare the stages with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
