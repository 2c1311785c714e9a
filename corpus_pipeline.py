"""From raw documents to packed training sequences: five stages over the whole corpus."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loanloom.llm import exact, minhash, packing, quality, secrets
from loanloom.session import discard, materialize

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WINDOW = 2048


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label quality classifier keeps."""
    return quality.keep_good(docs, quality.train(docs))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of all documents with one text, white space aside."""
    return exact.keep_first(docs)


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with five-word shingles that are 0.8 similar or more."""
    return minhash.keep_one(docs, width=5, percent=80)


def no_live_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with credentials that belong to few owners masked."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in sequences of ``WINDOW`` tokens."""
    return packing.pack(docs, TOKENIZER, window=WINDOW, with_ids=False)


STAGES = [
    ("quality_classifier", good_quality),
    ("exact_dedup", distinct_texts),
    ("near_dedup", no_near_duplicates),
    ("secret_scan", no_live_secrets),
    ("packing", packed),
]

#: Classifier, sketches and tokenizer have no SQL; tests/llm compare stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is a table the next one reads.

    A stage's table is deleted when the next one's has been written.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
