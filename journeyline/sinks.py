"""Model materialisation.

* ``view``      -> a temporary view over the lazy DataFrame (recomputed by each reader);
* ``ephemeral`` -> nothing is stored; the DataFrame is passed on to its consumers;
* ``table``     -> the whole relation is rewritten (overwrite) as Parquet under
                   ``<base>/<domain>/<name>`` and read back, which also cuts the lineage.

Each domain (staging, campaign_performance, attribution, funnel, ...) is its own folder,
the analog of one schema per domain. Tables get a ``last_updated`` build stamp, added only
here so that query results stay comparable between runs.
"""

from __future__ import annotations

import time
import zlib

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Default materialisation per model folder; a model may override it.
FOLDER_DEFAULTS = {"example": "view", "staging": "view", "intermediate": "ephemeral"}


def materialization(folder: str, override: str | None = None) -> str:
    return override or FOLDER_DEFAULTS.get(folder, "table")


def write_model(spark: SparkSession, df: DataFrame, name: str, domain: str, base_path: str,
                materialized: str = "table", stamp: bool = True,
                partition_by: list[str] | None = None,
                bucket_by: tuple[int, str] | None = None,
                observe: tuple[Observation, list[Column]] | None = None) -> DataFrame:
    """Materialise one model and return the relation its consumers should read.

    ``observe`` counts while a table is written: aggregates that the observation holds when the write has ended. They are taken
    in the tasks that write, after any shuffle, since a shuffle's tasks may run twice when an executor is lost.

    ``bucket_by=(n, column)`` stores the table as ``n`` hash buckets of ``column`` and registers
    it in the session catalog (data under the same path): readers then know the table is
    partitioned by ``column`` and run per-column windows, aggregations and joins without a
    shuffle. Use it only when no value of ``column`` holds a large share of the rows.
    """
    if materialized == "ephemeral":
        return df
    if materialized == "view":
        df.createOrReplaceTempView(name)
        return df
    if materialized != "table":
        raise ValueError(f"unknown materialization: {materialized}")
    out = df.withColumn("last_updated", F.current_timestamp()) if stamp else df
    path = f"{base_path.rstrip('/')}/{domain}/{name}"
    def watched(rows: DataFrame) -> DataFrame:
        return rows.observe(observe[0], *observe[1]) if observe else rows

    if bucket_by:
        buckets, column = bucket_by
        table = f"{domain}_{name}_{zlib.crc32(path.encode()):08x}"  # same folder -> same catalog name
        # one shuffle by the bucket column, so that each bucket is one file
        watched(out.repartition(buckets, column)).write.mode("overwrite").bucketBy(buckets, column).option("path", path).saveAsTable(table)
        return spark.table(table)
    if partition_by:
        # Group rows by partition value (few files per directory); adaptive execution splits
        # a partition value that holds a large share of the rows across several tasks.
        watched(out.hint("rebalance", *partition_by)).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        watched(out).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def publish_table(spark: SparkSession, df: DataFrame, name: str, schema: str, base_path: str, stamp: bool = True) -> DataFrame:
    """Write one build of a model as a catalog table and point the view ``<schema>.<name>`` at it; returns the view's rows.

    Each build is a table of its own, ``<schema>.<name>__<build>`` with its data under ``<base>/<schema>/<name>/<build>``. The
    view moves only after the write has ended, so readers keep the build before while a new one is written and if it
    fails. Older builds stay until ``drop_old_builds``."""
    out = df.withColumn("last_updated", F.current_timestamp()) if stamp else df
    build = f"b{time.time_ns()}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    path = f"{base_path.rstrip('/')}/{schema}/{name}/{build}"
    try:
        out.write.option("path", path).saveAsTable(f"`{schema}`.`{name}__{build}`", format="parquet")
    except Exception:
        _delete(spark, path)  # what the failed write left
        raise
    spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.`{name}` AS SELECT * FROM `{schema}`.`{name}__{build}`")
    return spark.table(f"`{schema}`.`{name}`")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def builds(spark: SparkSession, name: str, schema: str) -> list[str]:
    """The catalog tables of a model's builds, oldest first."""
    prefix = f"{name}__b"
    rows = spark.sql(f"SHOW TABLES IN `{schema}`").collect()  # one entry for each table
    return sorted((r["tableName"] for r in rows if r["tableName"].startswith(prefix.lower())), key=lambda t: int(t[len(prefix):]))


def drop_old_builds(spark: SparkSession, name: str, schema: str, keep: int = 1) -> list[str]:
    """Drop all but the newest ``keep`` builds from the catalog, files included; returns their names. The view's is never dropped."""
    old = builds(spark, name, schema)[:-max(keep, 1)]
    for table in old:
        where = spark.sql(f"DESCRIBE FORMATTED `{schema}`.`{table}`").where("col_name = 'Location'").first()["data_type"]
        spark.sql(f"DROP TABLE `{schema}`.`{table}`")
        _delete(spark, where)  # an external table keeps its files
    return old


# The reference's ORDER BY of each mart (O1-O3). A stored table has no order, so
# ``write_model`` does not sort; readers that display a mart apply this.
DISPLAY_ORDER = {
    "mart_campaign_performance": "total_revenue",
    "mart_attribution_analysis": "linear_attribution_revenue",
    "mart_conversion_funnel": "sessions_landing",
}


def for_display(df: DataFrame, name: str) -> DataFrame:
    """The mart in the reference's display order (descending; a distributed range-partitioned sort)."""
    return df.orderBy(F.desc(DISPLAY_ORDER[name]))
