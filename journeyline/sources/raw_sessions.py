"""Date-sharded raw session source (S1, S2) and its writer.

A warehouse wildcard table ``ga_sessions_*`` (one physical table per day, filtered by
``_TABLE_SUFFIX``) becomes one Parquet dataset Hive-partitioned by the string column
``date`` (yyyyMMdd). The inclusive suffix range turns into a partition filter, so only
the selected day directories are listed and read; nested struct leaves that a query
does not use are pruned from the Parquet read schema.

Exports often keep the table-per-day names instead: ``<base>/ga_sessions_20170701/*.parquet``. ``read_shards`` picks the
shards by their names before any file is opened and takes ``date`` from the name; ``read_days`` reads the ``date=``
layout for the days of another table, which Spark turns into dynamic partition pruning.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import RAW_SESSIONS

# The reference's shard range.
REFERENCE_START, REFERENCE_END = "20170701", "20170731"


def shard_range(df: DataFrame, start: str, end: str) -> DataFrame:
    """Keep shards whose suffix lies in [start, end] (string comparison, both ends inclusive)."""
    return df.where(F.col("date").between(F.lit(start), F.lit(end)))


def read_sessions(spark: SparkSession, path: str, start: str = REFERENCE_START,
                  end: str = REFERENCE_END) -> DataFrame:
    """Read a ``date=``-partitioned raw session dataset restricted to a shard range."""
    return shard_range(spark.read.schema(RAW_SESSIONS).parquet(path), start, end)


def write_sessions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write raw sessions as one directory per day.

    Rows are grouped by ``date`` first so each task writes few day directories (a day with a
    large share of the rows is split over several tasks by adaptive execution); dynamic
    partition overwrite replaces only the days present in ``df``.
    """
    (df.hint("rebalance", "date")
       .write.mode(mode)
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy("date")
       .parquet(path))


SHARD_PREFIX = "ga_sessions_"


def write_shards(df: DataFrame, base: str) -> None:
    """Write raw sessions as one table per day, ``<base>/ga_sessions_<yyyyMMdd>``; days in ``df`` replace what is there.

    One job writes all days into a folder of its own; each finished day then takes its name (a rename of a directory), so a
    reader finds a whole shard or none. Rows without a date belong to no shard and are an error."""
    spark = df.sparkSession
    if not df.where(F.col("date").isNull()).isEmpty():
        raise ValueError("sessions without a date belong to no shard")
    fs, path = files_of(spark, base)
    staging = f"{base.rstrip('/')}/.writing-{uuid.uuid4().hex}"
    write_sessions(df, staging)
    for found in fs.listStatus(path(staging)):  # one entry for each day
        name = found.getPath().getName()
        if name.startswith("date="):
            target = path(f"{base.rstrip('/')}/{SHARD_PREFIX}{name[len('date='):]}")
            fs.delete(target, True)
            if not fs.rename(found.getPath(), target):
                raise OSError(f"can't publish shard {target}")
    fs.delete(path(staging), True)


def shard_paths(spark: SparkSession, base: str, start: str, end: str) -> list[str]:
    """Paths of the shards whose suffix lies in [start, end], from one listing of names."""
    fs, path = files_of(spark, base)
    names = {f.getPath().getName(): f.getPath().toString() for f in fs.listStatus(path(base))}
    return [names[n] for n in sorted(names) if n.startswith(SHARD_PREFIX) and start <= n[len(SHARD_PREFIX):] <= end]


def read_shards(spark: SparkSession, base: str, start: str = REFERENCE_START, end: str = REFERENCE_END) -> DataFrame:
    """Read the per-day tables of a suffix range; only their files are listed and opened."""
    stored = StructType([f for f in RAW_SESSIONS.fields if f.name != "date"])
    paths = shard_paths(spark, base, start, end)
    if not paths:
        return spark.createDataFrame([], RAW_SESSIONS)
    day = F.regexp_extract("_metadata.file_path", SHARD_PREFIX + r"([^/]+)/[^/]+$", 1)
    return spark.read.schema(stored).parquet(*paths).select("*", day.alias("date"))


def read_days(spark: SparkSession, path: str, days: DataFrame, column: str = "date") -> DataFrame:
    """Read the ``date=`` layout for the distinct days (yyyyMMdd) of a table: a join that prunes directories at run time."""
    wanted = days.select(F.col(column).alias("date")).where("date is not null").distinct()
    return spark.read.schema(RAW_SESSIONS).parquet(path).join(wanted, "date", "left_semi").select(*RAW_SESSIONS.fieldNames())


def files_of(spark: SparkSession, base: str):
    """The file system of a path, and its constructor of paths."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path
