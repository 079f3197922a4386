"""A corpus pipeline over ``documents``: language ID, near-dedup, passage dedup, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which the caller writes and
reads again as the next stage's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from playspan.llm import bpe, forest, langid, mixing, suffix
from playspan.llm.common import small_batches
from playspan.session import stage


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that language ID rejects."""
    small_batches(spark)
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    small_batches(spark)
    return forest.keep_one_each(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 200 bytes or more that start elsewhere too; every row stays."""
    small_batches(spark)
    return suffix.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source to its target; a document comes once per epoch it is taken in."""
    small_batches(spark)
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text of each row.

    Fewer words are kept per worker than in a job of its own: the executors still hold the
    memory of the stages before.
    """
    small_batches(spark)
    return bpe.digest(docs, kept=50_000)


STAGES = [
    ("language", identify),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("mix", mix),
    ("encode", encode),
]

#: The stages cannot be told in SQL (trained centroids, hashes, merges); tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
