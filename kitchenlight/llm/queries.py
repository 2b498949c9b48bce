"""One query per operator, with production parameters over the whole table."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kitchenlight.llm import (
    alignment, decontaminate, html, language, oracles, packing, quality, repeats, secrets, sharding, simhash, syncmers, trie, windows
)
from kitchenlight.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]
ROOT = str(Path(__file__).resolve().parents[2])


def importable(query: Query) -> Query:
    """``query`` with this package on the path of Python workers started from now on.

    On a cluster the package is sent with ``--py-files``; here it matters where the driver was started elsewhere.
    """

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        variables = spark.sparkContext.environment
        paths = variables.get("PYTHONPATH", "").split(os.pathsep)
        if ROOT not in paths:
            variables["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
        return query(spark, sf_dir)

    return run


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compare_with_edits(documents(spark, sf_dir))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard_documents(documents(spark, sf_dir))
    return found.withColumn("law", F.lit("key")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(documents(spark, sf_dir))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op11_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = windows.remove_windows(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "op1_fingerprints": importable(op1_fingerprints),
    "op2_decontamination": importable(op2_decontamination),
    "op3_repeats": importable(op3_repeats),
    "op4_quality": importable(op4_quality),
    "op5_packing": importable(op5_packing),
    "op6_sharding": importable(op6_sharding),
    "op7_simhash": importable(op7_simhash),
    "op8_secrets": importable(op8_secrets),
    "op9_html": importable(op9_html),
    "op10_language": importable(op10_language),
    "op11_windows": importable(op11_windows),
    "op12_trie": importable(op12_trie),
    "op13_alignment": importable(op13_alignment),
}

ORACLES: dict[str, str] = {"op11_windows": oracles.OP11_WINDOWS, "op12_trie": oracles.OP12_TRIE}
