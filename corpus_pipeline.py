"""A corpus made ready for training: five stages, each written before the next reads it.

Every stage works on all that the one before it kept, and does what it decides:
documents that fail the quality rules go, one of each near-duplicate class
stays, personal data is masked, sources are taken as often as their targets say,
and the rest is packed into sequences. All but the last return the documents'
own columns. Nulls, empty tables and rows that repeat are treated as the
operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crosswind.llm import dedup, mixing, packing, pii, quality
from crosswind.session import settle


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, whose thresholds follow from these documents."""
    return quality.kept_documents(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return dedup.first_of_each(docs)


def anonymous_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return pii.masked_documents(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs).drop("row")


STAGES = [
    ("quality rules", good_documents),
    ("near-duplicates", distinct_documents),
    ("personal data", anonymous_documents),
    ("mixing", mixed_documents),
    ("packing", packed_sequences),
]

# Sampling sketches, shingles and token ids cannot be said in SQL; tests/llm has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
