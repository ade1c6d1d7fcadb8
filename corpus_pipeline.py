"""The corpus pipeline: stages over ``documents``, each written and read again by the next.

Every stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import decontaminate, mixing, secret_scan, simhash, toxicity
from loomline.operators.groups import ensure_checkpoint_dir


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go; the models learn from all labelled ones."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return simhash.drop_near_copies(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; every document stays. ``n_chars`` follows the text."""
    return secret_scan.mask_secrets(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document, at weights 1, 2, 3 over the sources."""
    return mixing.taken(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash_near_dedup", remove_near_copies),
    ("decontamination", remove_leaks),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
]

# Model scores and fingerprints are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is stored as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/loomline/{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
