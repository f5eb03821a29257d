"""A training corpus from ``documents``: clean, de-duplicate, decontaminate, mix, and write token files.

Each stage takes (spark, docs, sf_dir), applies one operator of ``censusmart.llm`` to all its predecessor kept, and returns a
DataFrame. ``run`` writes each stage's result as Parquet in the shared folder and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusmart.llm import decontaminate, mixing, quality_rules, simhash, token_files
from censusmart.llm.storage import saved

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that break one; n_chars follows the text."""
    return quality_rules.clean_documents(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints (three-word shingles, links of two bits at most): the smallest id."""
    return simhash.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in id order; returns each document's place in them, read back."""
    return token_files.token_index(spark, token_files.write_tokens(docs, TOKENIZER))


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_duplicates), ("decontamination", decontamination),
          ("mixing", mix), ("token_files", tokens)]

# The stages are not expressible in SQL; tests/llm compares their operators with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        result = saved(stage(spark, result, sf_dir), name)
    return result
