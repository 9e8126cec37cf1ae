"""Sums beyond 64 bits, the bucketed write, and metrics that follow the guide on NULL visitors and band edges."""

import glob

from pyspark.sql import functions as F

from conftest import hand_rows
from journeyline import sinks
from journeyline.functions.numeric import share_of
from journeyline.operators import attribution, journey_models, metrics
from journeyline.operators.staging import stg_sessions
from journeyline.schemas import RAW_SESSIONS


def _session(visitor, visit, micros, pageviews=3, bounces=None):
    return (visitor, visit, 1499000000 + visit, (1, 3, pageviews, 70, bounces, 1, micros), ("google", "organic", "(not set)", None, None),
            ("browser", "desktop", "os"), ("Canada", None), "20170702")


def test_ten_visitors_with_a_billion_dollars_each(spark):
    raw = spark.createDataFrame([_session(f"v{i}", i, 10**15) for i in range(10)], RAW_SESSIONS)
    stg = stg_sessions(raw)
    row = attribution.mart_attribution_analysis(stg).collect()[0]
    assert row["linear_attribution_revenue"] == 1e10
    assert journey_models.u_shaped_attribution(stg).collect()[0]["u_shaped_revenue"] == 1e10
    assert journey_models.w_shaped_attribution(stg).collect()[0]["w_shaped_revenue"] == 1e10


def test_pair_weights_of_one_visitor_with_millions_of_conversions(spark):
    n = 2_200_000
    one = spark.createDataFrame([_session("v", 1, 1_000_000)], RAW_SESSIONS)
    raw = (one.crossJoin(F.broadcast(spark.range(n)))
           .withColumn("visitId", F.col("id").cast(one.schema["visitId"].dataType)).drop("id").select(*one.columns))
    row = attribution.mart_attribution_analysis(stg_sessions(raw)).collect()[0]
    assert row["avg_sessions_per_visitor"] == n
    assert row["avg_session_position_in_journey"] == (n + 1) / 2


def test_share_is_exact_for_large_amounts(spark):
    cases = [(7, 3, 1000), (9 * 10**18, 7, 1000), (5, 2, 1), (0, 4, 300), (9223372036854775807, 2_200_000, 1000)]
    got = spark.createDataFrame(cases, "a long, n long, s long").collect()
    for a, n, s in got:
        value = spark.range(1).select(share_of(F.lit(a).cast("bigint"), F.lit(n).cast("bigint"), s)).first()[0]
        assert int(value) == (2 * a * s + n) // (2 * n)


def test_bucketed_write_makes_one_file_for_each_bucket(spark, tmp_path):
    df = spark.range(0, 5000, 1, 16).withColumn("visitor_id", (F.col("id") % 97).cast("string"))
    sinks.write_model(spark, df, "many_tasks", "staging", str(tmp_path), stamp=False, bucket_by=(4, "visitor_id"))
    assert 0 < len(glob.glob(f"{tmp_path}/staging/many_tasks/*.parquet")) <= 4


def test_null_visitors_are_no_visitors(spark):
    rows = [_session("A", 1, 10**6), _session("B", 2, None, bounces=1), _session(None, 3, 10**6)]
    stg = stg_sessions(spark.createDataFrame(rows, RAW_SESSIONS)).cache()
    assert sum(r["visitors"] for r in metrics.new_vs_returning(stg).collect()) == 2
    assert sum(r["visitors"] for r in journey_models.rfm_segments(stg).collect()) == 2
    assert sum(r["visitors"] for r in journey_models.days_to_conversion(stg).collect()) == 2


def test_exits_are_sessions_without_a_conversion(spark):
    stg = stg_sessions(spark.createDataFrame(hand_rows(), RAW_SESSIONS))
    want = stg.where("is_converted = 0").count()
    assert sum(r["exits"] for r in metrics.exit_distribution(stg).collect()) == want


def test_last_band_starts_beyond_its_edge(spark):
    df = spark.createDataFrame([(69.9,), (70.0,), (70.1,), (None,)], "x double")
    labels = [r[0] for r in df.select(metrics.band("x", [30, 50, 70], ["a", "b", "c", "d"], last_beyond=True)).collect()]
    assert labels == ["c", "c", "d", None]
