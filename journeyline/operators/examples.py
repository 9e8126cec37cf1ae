"""The starter example model pair (S8, U1, F3) and its tests.

``first_example``: two literal one-row selects combined with UNION ALL (duplicates kept),
ids 1 and NULL. ``second_example``: rows of the first with ``id = 1`` (NULL is dropped).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def first_example(spark: SparkSession) -> DataFrame:
    one = spark.range(1).select(F.lit(1).cast("int").alias("id"))
    null = spark.range(1).select(F.lit(None).cast("int").alias("id"))
    return one.unionByName(null)


def second_example(first: DataFrame) -> DataFrame:
    return first.where(F.col("id") == 1)
