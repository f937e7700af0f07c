"""A corpus from raw documents to training sequences, one operator of plycask.llm a stage.

Every stage takes (spark, docs, sf_dir), works on all that the one before it kept, and all but the last
return the columns of documents, whatever else they are called.  No stage fails on nulls, empty or very long texts,
ties, repeated rows or an empty table, which gives an empty table.  ``run`` writes each stage's documents to the shared folder and reads
them again, so a lost executor never costs more than the stage at hand.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plycask.llm import decontaminate, exact_dedup, language_id, minhash, packing
from plycask.llm.scratch import Scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus's languages; a text that is null or has no letter is in none.  Repeated rows are judged alike."""
    return language_id.reject_unknown(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, null and empty ones being equal: the one of the smallest doc_id, null last; one row of repeated ones."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one of the smallest doc_id, null last; texts without a word are one class."""
    return minhash.drop_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item; null and empty texts leak none, and null items are not looked for."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens; a null text has its separator alone, and repeated rows are packed each for itself."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: Signatures, the trained model and the tokenizer have no SQL; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
