"""Registered queries of this subpackage: one for each operator, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import (
    chosen_path,
    decontamination,
    jaccard_join,
    licenses,
    lm_score,
    merkle,
    pii,
    sentencepieces,
    sharding,
    token_alignment,
    topk,
    toxicity,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op7_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontamination.contamination(documents, benchmark)


@query("op9_license_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query("op1_url_filter", url_filter.ORACLE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


@query("op6_sharding", sharding.ORACLE_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query("op3_topk_search", topk.ORACLE_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = toxicity.train(documents, labels, ~held_out)
    scored = toxicity.score(documents, model)
    held = F.coalesce(held_out, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, "score", "predicted")


@query("op4_ngram_jaccard_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.join_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query("op8_lm_scoring")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    scored = lm_score.score(table(spark, sf_dir, "documents"), rest != 2)
    return scored.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@query("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return pii.find(documents, pii.train(documents))


@query("op2_sentencepiece")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepieces.add_pieces(documents, sentencepieces.load())
    return coded.select("doc_id", "n_pieces", "round_trip", "piece_ids")


@query("op11_merkle_manifest", merkle.ORACLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered(table(spark, sf_dir, "documents"))


@query("op12_minhash_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_copies(table(spark, sf_dir, "documents")).drop("text_key")


@query("op13_tokenizer_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.measures(table(spark, sf_dir, "documents"), token_alignment.load())
