"""A training-data pipeline over ``documents``: each stage takes what its predecessor kept.

Language ID drops documents without a language (no text, no letter, or an
ambiguous one); near-dedup keeps one document of each group, whose sets are
alike from ``NEAR_PERCENT`` on (op6's own threshold is higher); decontamination
drops documents that hold a benchmark item; the last stage encodes the rest.
Null ids and texts, repeated rows and empty tables are treated as the
operators' modules say; no stage fails on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import bpe, common, decontam, langid, minhash


#: The stage's threshold of similarity; 85 is that of query op6 alone.
NEAR_PERCENT = 80


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.with_language(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs, percent=NEAR_PERCENT)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.cleaned(docs, common.table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, decoded): packed token ids, and the bytes they decode to."""
    return bpe.encode_decode(docs)


STAGES = [
    ("language ID", with_language),
    ("MinHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", encoded),
]

#: The stages learn, sketch, tile and encode, which SQL cannot express; tests
#: hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), "stage")
    return docs
