"""Stored raw shards, published builds, daily visitor bitmaps and cuboids."""

import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, hand_rows
from journeyline import sinks
from journeyline.operators import cuboids
from journeyline.operators.campaign import mart_campaign_performance
from journeyline.operators.distinct_visitors import daily_states, distinct_visitors, extend_numbers
from journeyline.operators.staging import stg_sessions
from journeyline.plans.queries import staged
from journeyline.schemas import RAW_SESSIONS
from journeyline.sources.raw_sessions import read_days, read_shards, write_sessions, write_shards


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="jl-stored-", dir="/tmp")


# ---- raw shards --------------------------------------------------------------------------------


def test_shards_are_picked_by_name(spark, hand_raw, folder):
    write_shards(hand_raw, folder)
    got = read_shards(spark, folder, "20170702", "20170706")
    assert _same(got.select(*RAW_SESSIONS.fieldNames()), hand_raw.where("date between '20170702' and '20170706'"))
    days = {re.search(r"ga_sessions_(\d+)/", f).group(1) for f in got.inputFiles()}
    assert days == {r[-1] for r in hand_rows() if "20170702" <= r[-1] <= "20170706"}  # no other file is listed
    assert stg_sessions(got).count() == got.count()
    assert read_shards(spark, folder, "20180101", "20180131").count() == 0
    assert not [n for n in os.listdir(folder) if n.startswith(".writing")]


def test_a_shard_is_replaced_whole(spark, hand_raw, folder):
    write_shards(hand_raw, folder)
    again = hand_raw.where("date = '20170701'").limit(1)
    write_shards(again, folder)
    assert read_shards(spark, folder, "20170701", "20170701").count() == 1
    assert read_shards(spark, folder, "00000000", "99999999").count() == 15 - hand_raw.where("date = '20170701'").count() + 1
    with pytest.raises(ValueError):
        write_shards(hand_raw.withColumn("date", F.lit(None).cast("string")), folder)


def test_days_of_another_table_prune_directories(spark, hand_raw, folder):
    write_sessions(hand_raw, folder)
    days = spark.createDataFrame([("20170703", 1), ("20170705", 1), ("20170705", 1), ("20170709", 0), (None, 1)], "day string, on int")
    days.write.parquet(f"{folder}-days")
    got = read_days(spark, folder, spark.read.parquet(f"{folder}-days").where("on = 1"), "day")
    assert _same(got, hand_raw.where("date in ('20170703', '20170705')"))
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()


# ---- published builds --------------------------------------------------------------------------


def test_readers_keep_the_build_before(spark, hand_stg, folder):
    mart = mart_campaign_performance(hand_stg)
    first = sinks.publish_table(spark, mart, "mart_x", "jl_publish", folder)
    assert _same(first.drop("last_updated"), mart)
    broken = mart.withColumn("total_sessions", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception):
        sinks.publish_table(spark, broken, "mart_x", "jl_publish", folder)
    assert _same(spark.table("jl_publish.mart_x").drop("last_updated"), mart)
    half = mart.where("traffic_source = 'google'")
    sinks.publish_table(spark, half, "mart_x", "jl_publish", folder)
    assert _same(spark.table("jl_publish.mart_x").drop("last_updated"), half)
    before = sinks.builds(spark, "mart_x", "jl_publish")
    dropped = sinks.drop_old_builds(spark, "mart_x", "jl_publish")
    assert dropped == before[:-1] and sinks.builds(spark, "mart_x", "jl_publish") == before[-1:]
    assert _same(spark.table("jl_publish.mart_x").drop("last_updated"), half)
    assert len([n for n in os.listdir(f"{folder}/jl_publish/mart_x") if not n.startswith(".")]) == 1


# ---- distinct visitors -------------------------------------------------------------------------


def test_numbers_are_dense_and_never_change(spark):
    stg = staged(spark, SF_SMALL)
    early, n = stg.where("session_date < DATE'2024-01-10'"), stg.select("visitor_id").distinct().count()
    known = extend_numbers(early).cache()
    every = extend_numbers(stg, known)
    assert sorted(r.visitor_no for r in every.collect()) == list(range(1, n + 1))
    assert _same(every.join(known.select("visitor_id"), "visitor_id", "left_semi"), known)
    assert _same(extend_numbers(early, known), known)


def test_states_of_days_merge_to_the_true_count(spark, folder):
    stg = staged(spark, SF_SMALL).withColumn("visitor_id", F.when(F.crc32(F.col("session_id").cast("binary")) % 9 != 0, F.col("visitor_id")))
    numbers = None
    for k, (lo, hi) in enumerate([("2024-01-01", "2024-01-12"), ("2024-01-13", "2024-01-31")]):  # stored day by day, merged later
        part = stg.where(F.col("session_date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
        numbers = extend_numbers(part, numbers)
        numbers.write.parquet(f"{folder}/numbers-{k}")
        numbers = spark.read.parquet(f"{folder}/numbers-{k}")
        daily_states(part, numbers).write.mode("append").parquet(f"{folder}/states")
    states = spark.read.parquet(f"{folder}/states")
    got = distinct_visitors(states, {"device_category": "device_category", "week": F.trunc("session_date", "week")})
    want = stg.where("visitor_id is not null").groupBy("device_category", F.trunc("session_date", "week").alias("week")).agg(
        F.countDistinct("visitor_id").alias("visitors"))
    assert _same(got, want)
    whole = distinct_visitors(states, {"all": F.lit(1)}).first()
    assert whole.visitors == stg.select("visitor_id").where("visitor_id is not null").distinct().count()


def test_states_use_several_blocks(spark):
    """Numbers beyond 32,768 go into blocks of their own."""
    sessions = spark.range(70000).select(F.concat(F.lit("v"), "id").alias("visitor_id"), F.lit("s").alias("traffic_source"), F.lit("m").alias("traffic_medium"),
                                         F.lit(None).cast("string").alias("campaign_name"), F.lit("d").alias("device_category"), F.lit("c").alias("country"),
                                         F.to_date(F.lit("2024-01-01")).alias("session_date"))
    states = daily_states(sessions, extend_numbers(sessions))
    assert states.count() == 3 and distinct_visitors(states, {"campaign_name": "campaign_name"}).collect() == [("(not set)", 70000)]


def test_a_state_is_as_large_as_what_it_holds(spark):
    """A group of one visitor holds one word, not a whole block; words and blocks merge at their edges, with NULL dimensions."""
    numbers = spark.createDataFrame([(f"v{n}", n) for n in (1, 63, 64, 65, 128, 32767, 32768, 32769, 65536, 65537)], "visitor_id string, visitor_no long")
    sessions = (numbers.join(spark.range(30)).where("visitor_no % 2 = 1 or id < 20 or visitor_no = 64")
                .select("visitor_id", F.lit("s").alias("traffic_source"), F.lit(None).cast("string").alias("traffic_medium"),
                        F.when(F.col("id") % 3 != 0, F.concat(F.lit("c"), F.col("id") % 3)).alias("campaign_name"), F.col("id").cast("string").alias("device_category"),
                        F.when(F.col("id") % 2 == 0, "n").alias("country"), F.expr("date_add(DATE'2024-01-01', CAST(id AS INT))").alias("session_date")))
    sessions = sessions.unionByName(sessions)
    states = daily_states(sessions, numbers).cache()
    held = sessions.join(numbers, "visitor_id").groupBy("device_category").agg(F.countDistinct("visitor_no").alias("n")).agg(F.sum("n")).first()[0]
    rows = states.collect()
    assert len(rows) == 30 * 3 and sum(len(r.visitors) for r in rows) <= held
    assert {r.block for r in rows} == {1, 2, 3} and all(len(r.visitors) == 1 for r in rows if r.block == 3)
    named = {"campaign_name": F.coalesce("campaign_name", F.lit("(not set)")), "traffic_medium": F.col("traffic_medium"), "country": F.col("country")}
    want = sessions.groupBy(*[c.alias(n) for n, c in named.items()]).agg(F.countDistinct("visitor_id").alias("visitors"))
    assert _same(distinct_visitors(states, {n: n for n in named}), want)
    assert distinct_visitors(states, {"all": F.lit(1)}).collect() == [(1, 10)]


# ---- cuboids -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def cubes(spark):
    stg = staged(spark, SF_SMALL).withColumn("country", F.when(F.col("country") != "NATION_3", F.col("country")))
    return stg, cuboids.build_cuboids(stg, tempfile.mkdtemp(prefix="jl-cubes-", dir="/tmp") + "/cubes")


def test_every_cuboid_sums_to_the_sessions(cubes):
    stg, stored = cubes
    per = {int(r.grouping_id): (r.n, r.s, r.rev) for r in stored.groupBy("grouping_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sessions").alias("s"), F.sum("revenue_micros").alias("rev")).collect()}
    total = stg.agg(F.count(F.lit(1)), F.sum("transaction_revenue_micros")).first()
    assert sorted(per) == list(range(32)) and {v[1:] for v in per.values()} == {tuple(total)}
    assert per[cuboids.grouping_id(["country"])][0] == stg.select("country").distinct().count()
    assert per[31][0] == 1


@pytest.mark.parametrize("by, filters", [([], {"country": None}), (["country"], {}), (["device_category"], {"country": ["NATION_1", None], "traffic_source": "google"}),
                                         (["session_date", "channel_grouping"], {"session_date": ("between", "2024-01-05", "2024-01-09")}), ([], {"country": "nowhere"})])
def test_slices_equal_the_sessions(cubes, by, filters):
    stg, stored = cubes
    want = cuboids._filter(cuboids.finest(stg), filters).groupBy(*by).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in cuboids.MEASURES])
    assert _same(cuboids.slice_of(stored, by, filters), want)


def test_a_query_reads_one_cuboid_with_its_filters_pushed_down(cubes):
    _, stored = cubes
    df = cuboids.kpis(stored, ["device_category"], {"country": ["NATION_1", "NATION_2"], "session_date": ("between", "2024-01-05", "2024-01-09")})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" not in plan
    assert f"grouping_id#" in plan.split("PartitionFilters")[1] and f"= {cuboids.grouping_id(['device_category', 'country', 'session_date'])}" in plan
    assert "In(country, [NATION_1,NATION_2])" in plan.split("PushedFilters")[1] and "GreaterThanOrEqual(session_date" in plan


def test_building_reads_the_sessions_once_and_expands_nothing(cubes):
    stg, _ = cubes
    plan = cuboids.finest(stg)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert cuboids.parent(("country",)) == ("channel_grouping", "country") and cuboids.parent(tuple(cuboids.DIMS[:-1])) == tuple(cuboids.DIMS)
    with pytest.raises(ValueError):
        cuboids.grouping_id(["hour"])


def test_cuboids_of_no_sessions(spark, folder):
    stored = cuboids.build_cuboids(staged(spark, SF_SMALL).where("1 = 0"), f"{folder}/none")
    assert cuboids.kpis(stored, []).first().sessions == 0
