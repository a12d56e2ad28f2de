"""The registered queries of the operators and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    codes,
    covertree,
    decontaminate,
    licenses,
    lines,
    mixing,
    personal,
    quality,
    sharding,
    simhash,
    variants,
    warc,
    wrappers,
)
from .shared import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return wrap


@query("op1_decontaminate", decontaminate.SQL)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.report(documents, table(spark, sf_dir, "benchmark", "item_id", "text"))


@query("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op3_warc")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_wrappers")
def op4_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"),
        simhash.hexadecimal(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query("op6_licenses", licenses.sql())
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op7_covertree")
def op7_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_copies(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query("op8_mixing", mixing.SQL)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents", "doc_id", "source", "text"))
    return found.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        F.round("position", 9).alias("position"),
    )


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return quality.report(documents, table(spark, sf_dir, "labels", "doc_id", "quality"))


@query("op10_personal")
def op10_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op11_lines", lines.SQL)
def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op12_variants")
def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op13_codes", codes.SQL)
def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
