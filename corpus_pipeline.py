"""The corpus pipeline: stages over ``documents``, each written before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postloom.llm.decontaminate import clean_documents
from postloom.llm.language import identified_documents
from postloom.llm.near_dup import one_of_each
from postloom.llm.packing import packed_documents
from postloom.llm.quality import kept_documents
from postloom.llm.queries import vocabulary
from postloom.llm.shared import fresh_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows and is sure of; null and letterless texts go."""
    return identified_documents(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and, with labels, the risk-controlled cutoffs."""
    return kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents and their places in training sequences."""
    placed = packed_documents(docs, vocabulary("word_bpe_49k.json"), 1)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("quality", quality),
    ("near_dup", near_dup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]
# Trained weights, signatures and tokenizers are beyond SQL: tests compare the stages with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from ``documents`` on."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
