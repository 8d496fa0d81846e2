"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwright.llm import (chat, embedding_join, filter_audit, license_scan, line_rules,
                             merge_dropout, mixing, sharding, simhash, substring_dedup, toxicity,
                             vector_codes, warc)
from sparkwright.llm.common import new_scratch
from sparkwright.sources.files import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.quality_rules(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op6_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.embedding_links(table(spark, sf_dir, "embeddings"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", simhash.hex_fingerprint(found["fp"]).alias("fingerprint"),
                        "component_id")


def op8_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_dropout.encode_documents(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "removed_spans")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_scratch(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), out)
    return warc.read_warc(spark, out).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.digests(chat.format_conversations(turns.unionByName(more)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_toxicity, op2_quality_rules, op3_mixing, op4_license_scan, op5_sharding,
        op6_embedding_join, op7_simhash_dedup, op8_merge_dropout, op9_substring_dedup, op10_warc,
        op11_filter_audit, op12_vector_codes, op13_chat_format)}

ORACLES: dict[str, str] = {
    "op2_quality_rules": line_rules.ORACLE_SQL,
    "op3_mixing": mixing.ORACLE_SQL,
    "op5_sharding": sharding.ORACLE_SQL,
    "op6_embedding_join": embedding_join.ORACLE_SQL,
    "op10_warc": warc.ORACLE_SQL,
    "op11_filter_audit": filter_audit.ORACLE_SQL,
    "op12_vector_codes": vector_codes.ORACLE_SQL,
    "op13_chat_format": chat.ORACLE_SQL,
}
