"""A corpus from raw documents to training shards, in stages that each read what the one before has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assayer.llm import decontaminate, mixing, quality, sharding, simhash
from assayer.llm.shared import table
from assayer.sources import remove_folder, scratch_folder

# A trained classifier, near copies and moves between shards are not SQL; tests/llm compare with brute force.
ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.good(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies by SimHash stays, the one with the smallest id."""
    return simhash.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come near their targets: documents are left out or repeated, in training order."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.shard(docs)


STAGES: list[tuple[str, Stage]] = [
    ("good quality", good_quality),
    ("near copies", near_copies),
    ("benchmark free", benchmark_free),
    ("mixture", mixture),
    ("shards", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each result but the last is written, and removed when it has been used."""
    docs = table(spark, sf_dir, "documents")
    folder = None
    for name, stage in STAGES:
        found = stage(spark, docs, sf_dir)
        written = scratch_folder(spark, name.replace(" ", "-"))
        found.write.parquet(written)
        if folder:
            remove_folder(spark, folder)
        folder, docs = written, spark.read.parquet(written)
    return docs
