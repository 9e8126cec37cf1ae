"""Intermediate tables in the shared folder that the cluster names in ``spark.checkpoint.dir``.

A saved table cuts the lineage: a lost executor repeats only what came after it. The folder is read from the
session; only where it is unset (tests) a local one is made. ``clear`` removes this application's tables.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

import journeyline

_CONF = "spark.checkpoint.dir"
ARROW_BYTES = 4 << 20
_SHIPPED: set[str] = set()


def root(spark: SparkSession) -> str:
    base = spark.conf.get(_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_CONF} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-scratch-")
        spark.conf.set(_CONF, base)
    return f"{base}/llm-{spark.sparkContext.applicationId}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete this application's scratch tables; only frames already written elsewhere survive it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(journeyline.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="llm-package-"), "journeyline-package.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(package):
            for name in (n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                out.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package, and bound the Arrow batches that workers get by bytes: rows hold whole texts of any length."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark
