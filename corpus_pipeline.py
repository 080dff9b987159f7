"""From documents to packed training sequences, in stages that are each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from conform.llm import exact, language, matrices, mixing, simhash
from conform.llm.staging import staged


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without text or without a letter go."""
    found = language.predicted(docs, language.learn(docs))
    return found.where("lang_pred <> 'und'").select(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.without_exact_duplicates(docs).select(*docs.columns)


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links, three words to a shingle and at most three differing bits."""
    return simhash.one_of_each_group(docs, length=3, radius=3).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences. Workers hold what earlier stages left, so they remember fewer words."""
    return matrices.packed_documents(docs, remembered=400_000)


STAGES = [
    ("language", identified),
    ("exact_dedup", deduplicated),
    ("simhash", near_deduplicated),
    ("mixing", mixed),
    ("packing", packed),
]

#: Trained models, hashes of shingles and tokenizers are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
