"""From raw documents to packed training sequences.

Five stages, each one operator of ``wayfare.llm``: toxic documents go, repeated
lines go, one document of each SimHash group stays, sources are mixed to their
target weights, and what is left is packed into sequences. Each stage's result is
written as Parquet and read as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfare.cluster import written
from wayfare.llm import harmonic, linededup, mixing, toxicity, vptree
from wayfare.llm.common import table


def toxic_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier scores 0.5 or more are rejected."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def repeated_lines_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines equal or one word apart the earliest stays."""
    return linededup.without_repeated_lines(docs)


def near_duplicates_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash fingerprints stays: 4-word shingles, 4 bits."""
    return vptree.one_of_each_group(docs)


def sources_are_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source gives as many words as its target; repeats follow within a document."""
    return mixing.mixed_documents(docs)


def sequences_are_packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return harmonic.pack(docs)


STAGES = [
    ("toxicity", toxic_documents_go),
    ("line dedup", repeated_lines_go),
    ("simhash near-dedup", near_duplicates_go),
    ("mixing", sources_are_mixed),
    ("packing", sequences_are_packed),
]

#: Fingerprints, the trained classifier and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``: one row per packed piece."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
