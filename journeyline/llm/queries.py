"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from journeyline.llm import (decontam, interaction, langid, linededup, merkle, minhash, mixing, packing, quality, scratch, sharding, toxicity,
                             urlfilter, warc)
from journeyline.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch.root(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_warc(_table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.passage_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed_chunks", "n_removed_lines", "spans", F.crc32(F.col("clean_text").cast("binary")).alias("clean_crc32"),
                      F.octet_length("clean_text").cast("long").alias("clean_bytes"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(_table(spark, sf_dir, "documents"))


def op10_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit(spark, f"{sf_dir}/documents.parquet", _table(spark, sf_dir, "labels"))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the URLs of all pages whose host has a word of ``urlfilter.HOST_WORDS``."""
    pages = _table(spark, sf_dir, "pages")
    return urlfilter.judge(pages, urlfilter.listing(urlfilter.unwanted(pages)))


QUERIES = {f.__name__: f for f in (op1_minhash, op2_warc, op3_mixing, op4_quality, op5_toxicity, op6_sharding, op7_line_dedup,
                                   op8_decontamination, op9_language_id, op10_token_packing, op11_merkle, op12_filter_audit, op13_url_filters)}
