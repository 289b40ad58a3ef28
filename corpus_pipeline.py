"""Cleans a corpus in stages, each stored as Parquet and read again by the next.

Toxic documents go, one document of each group of near copies stays, passages that occur more than
once are cut out, documents are drawn to target weights, and what is left is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tourney.llm import bpe, minhash, mixing, suffixes, toxicity
from tourney.session import materialise

# Shortest repeated passage that is cut out, in bytes; fifty words are longer than that.
PASSAGE_BYTES = 200
TOKEN_SHARE = 0.8
VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.without_near_duplicates(docs, words=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(docs, PASSAGE_BYTES)


def draw_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sampled_documents(docs, TOKEN_SHARE)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_documents(docs, public_tokenizers.path(VOCABULARY))
    return encoded.withColumn("n_tokens", F.size("token_ids").cast("bigint"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("mixture", draw_mixture),
    ("bpe", encode),
]

# Learned scores, sketches and merges have no SQL form; the tests follow run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` after all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
