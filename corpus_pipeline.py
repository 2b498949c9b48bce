"""The training-data pipeline over ``documents``: five stages, each written as Parquet and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kitchenlight.llm import decontaminate, packing, quality, secrets, similar
from kitchenlight.llm.common import document_columns, documents, stored
from kitchenlight.llm.queries import importable


def keep_good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the perplexity of trusted text does not reject."""
    return quality.keep_good(docs.select(*document_columns(docs)), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose five-word shingles are alike to 0.8 or more."""
    return similar.drop_near_copies(docs.select(*document_columns(docs)))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontaminate.drop_leaks(docs.select(*document_columns(docs)), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secrets.redact_secrets(docs.select(*document_columns(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents and their places in sequences of 2048."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", keep_good_text),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: Perplexities, automata and tokenizers have no SQL; tests/llm/test_pipeline.py checks every stage by brute force.
ORACLE_SQL = None


@importable
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token pieces of what all stages keep."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
