"""Five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents. All but the last return the
columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestrata.llm import decontamination, jaccard_join, pii, sentencepieces, toxicity
from lodestrata.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model learns from the labels of the others' tables."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.remove_toxic(docs, toxicity.train(docs, labels))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of five-word-shingle sets of similarity 0.8 or more, one stays."""
    return jaccard_join.keep_one(docs, size=5, percent=80)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a ten-word passage of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminate(docs, benchmark)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes a tag of its kind."""
    return pii.redact(docs, pii.train(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids beside every text, checked by decoding them."""
    return sentencepieces.add_pieces(docs, sentencepieces.load())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("pii", mask_personal_data),
    ("sentencepiece", encode),
]

#: SQL cannot express the learned stages; tests hold the run against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
