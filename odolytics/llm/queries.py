"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from odolytics.llm import (
    decontaminate,
    fingerprint,
    kneser_ney,
    language,
    licenses,
    line_dedup,
    merkle,
    mixing,
    near_dup,
    prefix_trie,
    secret_scan,
    suffix_dedup,
    transcripts,
)
from odolytics.plans.registry import query


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_minhash_near_dedup", near_dup.ORACLE)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, folder, "documents"))


@query("op2_fingerprints")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, folder, "documents"))


@query("op3_language_id")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return language.held_out_languages(_table(spark, folder, "documents"))


@query("op4_kneser_ney")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.held_out_scores(_table(spark, folder, "documents"))


@query("op5_mix_sources", mixing.ORACLE)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents"))


@query("op6_suffix_dedup", suffix_dedup.ORACLE)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(_table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


@query("op7_line_dedup", line_dedup.ORACLE)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_dedup(_table(spark, folder, "documents")).select(
        "doc_id", "n_units", "n_removed", "removed_chars", "kept_md5"
    )


@query("op7_line_dedup_every_line", line_dedup.ORACLE_EVERY_LINE)
def op7_every_line(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_dedup(_table(spark, folder, "documents"), sentence_chars=None).select(
        "doc_id", "n_units", "n_removed", "removed_chars", "kept_md5"
    )


@query("op8_license_scan", licenses.ORACLE)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, folder, "documents"))


@query("op9_transcripts")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return transcripts.held_out_roles(_table(spark, folder, "conversations"))


@query("op10_decontaminate", decontaminate.ORACLE)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contained_items(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@query("op11_prefix_trie", prefix_trie.ORACLE)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, folder, "conversations"))


@query("op12_merkle_manifest", merkle.ORACLE)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(_table(spark, folder, "documents"))


@query("op13_secret_scan", secret_scan.ORACLE)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secrets(_table(spark, folder, "documents"))
