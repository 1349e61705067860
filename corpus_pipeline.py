"""A training-data pipeline: each stage calls one of the operators in tidemark.llm.

``run`` applies the stages to ``documents``; every stage's result is written as
Parquet in the shared folder and read again as the next one's documents.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.llm import bpe, exact_dedup, language_id, mixing, near_dedup  # noqa: E402
from tidemark.llm.common import from_key, read_documents, saved  # noqa: E402
from tidemark.session import ship_package  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter or are like no language learned from the corpus."""
    return language_id.identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal normalised texts stays."""
    return exact_dedup.kept_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: three-word shingles, two bits."""
    return near_dedup.one_of_each(docs, shingle=3, max_bits=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: a row a copy, with its ids' and text's digests."""
    return bpe.encoded(docs, with_ids=False).select(
        from_key("key").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("mixing", mix),
    ("bpe", tokens),
]

# Learned language profiles and BPE are outside SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, one after the other."""
    ship_package(spark)
    docs = read_documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, f"pipeline-{name}")
    return docs
