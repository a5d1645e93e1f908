"""The operators of this folder as queries, one each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayfare.llm import scoring, toxicity
from wayfare.llm.common import table
from wayfare.llm.golomb import exact_groups
from wayfare.llm.harmonic import pack
from wayfare.llm.hashtree import shard_documents
from wayfare.llm.importance import resample
from wayfare.llm.linededup import dedup_lines
from wayfare.llm.mixing import mix
from wayfare.llm.nndescent import near_vectors
from wayfare.llm.oracles import ORACLES
from wayfare.llm.pagediff import main_texts
from wayfare.llm.randomness import scan_secrets
from wayfare.llm.spelling import spelling_variants
from wayfare.llm.vptree import near_groups

Query = Callable[[SparkSession, str], DataFrame]


def op1_vantage_point_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_nn_descent_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op3_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_deletion_neighbourhood_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op7_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_golomb_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_nearest_url_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return main_texts(pages).select("page_id", "url", "text", "n_chars")


def op10_weak_supervision_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score_documents(documents, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op11_gram_index_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return resample(documents, table(spark, sf_dir, "benchmark", "text"))


def op13_randomness_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))


_ALL = [
    op1_vantage_point_simhash, op2_nn_descent_embeddings, op3_hash_tree_shards, op4_deletion_neighbourhood_lines,
    op5_harmonic_packing, op6_sainte_lague_mix, op7_attention_scores, op8_golomb_exact_dedup, op9_nearest_url_extraction,
    op10_weak_supervision_toxicity, op11_gram_index_spelling, op12_importance_resampling, op13_randomness_secrets,
]
QUERIES: dict[str, Query] = {q.__name__: q for q in _ALL}

__all__ = ["ORACLES", "QUERIES"]
