"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns the rows that go on, with the columns of ``documents``; the last adds
the shard, slot and sizes. ``run`` writes each stage's rows as Parquet in the shared folder and reads them again, so a
lost executor repeats part of one stage only.

The near-duplicate stage links rows, not ids: each row has a key of its own there, so rows without a doc_id are
deduplicated too, and of unlike rows that share a doc_id none is lost. Quality rejects null, empty and blank texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from journeyline.llm import decontam, minhash, mixing, quality, scratch, sharding


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: that with the smallest doc_id (a null is the greatest)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    # stored, so that a row has the same key wherever it is read again
    rows = scratch.save(docs.select(row, F.monotonically_increasing_id().alias("key")), "keyed")
    groups = minhash.near_duplicates(rows.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")))
    groups = groups.select(F.col("doc_id").alias("key"), "component_id")
    ids = rows.select("key", F.col("row.doc_id").cast("long").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first")
    kept = groups.join(ids, "key").groupBy("component_id").agg(first).select("first.key")
    return rows.join(scratch.save(kept, "kept"), "key", "left_semi").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs)


STAGES = [("quality", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", source_mixing), ("sharding", shards)]

#: zstandard ratios can't be told in SQL: the tests hold the stages against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
