"""Positions, totals and tiles per key equal window functions, also where one key holds a third of all rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from journeyline.operators.per_key import ntiles, sequence_within, totals_within
from journeyline.plans.queries import staged


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def hot(spark):
    """9000 sessions: one visitor and the NULL visitor have a third each; starts tie, some are NULL, some before 1970."""
    n = F.col("id")
    return spark.range(0, 9000, 1, 6).select(
        F.when(n % 3 == 0, "hot").when(n % 3 == 1, (n % 700).cast("string")).alias("visitor_id"),
        F.when(n % 101 != 0, F.timestamp_seconds((F.xxhash64("id") % 500000) * 60)).alias("start"),
        F.when(n % 50 != 0, F.concat(F.lit("s"), F.lpad((n - n % 7).cast("string"), 6, "0"))).alias("session_id"),
        n.alias("row"), (n % 5).alias("x"), F.to_date(F.timestamp_seconds((n % 40) * 86400)).alias("day")).cache()


@pytest.mark.parametrize("seconds", [1, 3600, 10 ** 9])
def test_sequence_equals_the_window(hot, seconds):
    w = Window.partitionBy("visitor_id")
    want = hot.select("row", F.row_number().over(w.orderBy("start", "session_id", "row")).cast("bigint").alias("seq"),
                      F.count(F.lit(1)).over(w).alias("n"), F.sum("x").over(w).alias("sum_x"), F.max("day").over(w).alias("last"),
                      F.min(F.when(F.col("x") == 3, F.col("day"))).over(w).alias("first"))
    got = sequence_within(hot, "visitor_id", "start", ["session_id", "row"], bucket_seconds=seconds, key_aggs={
        "sum_x": ("sum", F.col("x")), "last": ("max", F.col("day")), "first": ("min", F.when(F.col("x") == 3, F.col("day")))})
    assert _same(got.select(*want.columns), want)


def test_sequence_on_sessions(spark):
    stg = staged(spark, SF_CHECK)
    want = stg.select("session_id", F.row_number().over(
        Window.partitionBy("visitor_id").orderBy("session_start_timestamp", "session_id")).cast("bigint").alias("seq"))
    got = sequence_within(stg, "visitor_id", "session_start_timestamp", ["session_id"])
    assert _same(got.select("session_id", "seq"), want)


def test_totals_equal_the_join(hot):
    per_key = hot.groupBy("visitor_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("x").alias("sum_x"), F.min("day").alias("first"),
                                            F.countDistinct("session_id").alias("sessions"))
    want = hot.join(per_key, hot.visitor_id.eqNullSafe(per_key.visitor_id)).select("row", "rows", "sum_x", "first", "sessions")
    got = totals_within(hot, "visitor_id", F.coalesce("session_id", F.col("row").cast("string")),
                        {"rows": ("sum", F.lit(1)), "sum_x": ("sum", F.col("x")), "first": ("min", F.col("day"))}, {"sessions": "session_id"})
    assert got.columns[:len(hot.columns)] == hot.columns
    assert _same(got.select(*want.columns), want)


def test_no_task_of_the_join_holds_a_visitor_whole(spark, hot):
    """The rows of the hot visitor are dealt over the partitions, not to one."""
    got = totals_within(hot, "visitor_id", F.col("row"), {"rows": ("sum", F.lit(1))})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        per_task = [r["count"] for r in got.where("visitor_id = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(per_task) >= 8 and max(per_task) < 2 * 3000 / 8


@pytest.mark.parametrize("rows", [0, 1, 3, 5, 7, 4003])
def test_ntiles_equal_the_window(spark, rows):
    n = F.col("id")
    v = spark.range(rows).select((F.xxhash64("id") % 100000).cast("string").alias("k"), n, (n % 3).alias("few"),
                                 F.when(n % 4 == 0, F.pow(F.lit(3.0), n % 30).cast("long") * -1).otherwise((F.xxhash64(n, F.lit(1)) % 10 ** 9)).alias("wide"))
    v = v.withColumn("k", F.concat("k", F.lit("-"), n.cast("string")))
    w = {m: F.ntile(5).over(Window.orderBy(m, "k")).cast("bigint").alias(f"t_{m}") for m in ("few", "wide")}
    got = ntiles(v, "k", {"t_few": F.col("few"), "t_wide": F.col("wide")}, 5)
    assert _same(got, v.select("k", *w.values()))


def test_rfm_needs_no_checkpoint_and_no_window_over_all_visitors(spark, caplog):
    from journeyline.operators.journey_models import rfm_segments
    plan = rfm_segments(staged(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in plan and "SinglePartition" not in plan
