"""Registry of named queries: ``(spark, sf_dir) -> DataFrame`` over the driver's tables.

Every query starts from the sessions adapter over ``events`` + ``nation`` (the test data has
no web-session table), then runs the library's operators on the whole result.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.channels import campaign_identifier, channel_grouping
from .. import sinks
from ..operators import attribution as attr
from ..operators import cuboids as cube
from ..operators import dashboard as dash
from ..operators import distinct_visitors as dv
from ..operators import funnel, metrics, quality
from ..operators import journey_models as jm
from ..operators.campaign import int_campaign_metrics, mart_campaign_performance
from ..operators.staging import stg_sessions
from ..sources.events_adapter import load_raw_sessions
from ..session import checkpoint_dir
from ..sources.raw_sessions import read_days, read_shards, shard_range, write_sessions, write_shards
from ..streaming.incremental import daily_table, mart_table, start_campaign_refresh


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


_MODELS: dict[tuple, DataFrame] = {}
_TABLES: dict[tuple, DataFrame] = {}  # stored, so nothing is persisted


def model(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A model relation built once per session and input directory and persisted.

    Like a warehouse table that several dashboards read, the staged sessions and the marts
    are shared by many queries. MEMORY_AND_DISK keeps them across queries; a lost block
    is recomputed from lineage.
    """
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, name)
    if key not in _MODELS:
        _MODELS[key] = build().persist(StorageLevel.MEMORY_AND_DISK)
    return _MODELS[key]


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table that ``build`` writes, once per session and input directory."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = build()
    return _TABLES[key]


def release_models(spark: SparkSession) -> int:
    """Unpersist every model this session built through ``model()``; returns how many."""
    keys = [k for k in _MODELS if k[0] == id(spark) and k[1] == spark.sparkContext.applicationId]
    for k in keys:
        _MODELS.pop(k).unpersist()
    return len(keys)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        return stg_sessions(load_raw_sessions(spark, sf_dir))
    return model(spark, sf_dir, "stg_ga_sessions", build)


# Marts are tables, as in the reference: built once per session and input folder by their
# own query (or on first use), then read by the data tests and the dashboards.
def _campaign_mart(spark, sf_dir):
    return model(spark, sf_dir, "mart_campaign_performance",
                 lambda: mart_campaign_performance(staged(spark, sf_dir)))


def _attribution_mart(spark, sf_dir):
    return model(spark, sf_dir, "mart_attribution_analysis",
                 lambda: attr.mart_attribution_analysis(staged(spark, sf_dir)))


def _funnel_mart(spark, sf_dir):
    return model(spark, sf_dir, "mart_conversion_funnel",
                 lambda: funnel.mart_conversion_funnel(staged(spark, sf_dir)))


def _scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one, for tables that a query writes and reads back."""
    return f"{checkpoint_dir(spark).rstrip('/')}/journeyline/{name}-{uuid.uuid4().hex}"


def _raw_leaves(raw: DataFrame) -> DataFrame:
    return raw.select(
        "fullVisitorId", "visitId", "visitStartTime", "date",
        F.col("totals.visits").alias("totals_visits"), F.col("totals.hits").alias("totals_hits"),
        F.col("totals.pageviews").alias("totals_pageviews"),
        F.col("totals.timeOnSite").alias("totals_time_on_site"),
        F.col("totals.bounces").alias("totals_bounces"),
        F.col("totals.transactions").alias("totals_transactions"),
        F.col("totals.transactionRevenue").alias("totals_transaction_revenue"),
        F.col("trafficSource.source").alias("traffic_source"),
        F.col("trafficSource.medium").alias("traffic_medium"),
        F.col("trafficSource.campaign").alias("traffic_campaign"),
        F.col("device.deviceCategory").alias("device_category"),
        F.col("geoNetwork.country").alias("country"))


@query("src_shard_range")
def q_src_shard_range(spark, sf_dir):
    """The shard-range filter on the raw nested records, leaves read by path."""
    return _raw_leaves(shard_range(load_raw_sessions(spark, sf_dir), "20240108", "20240121"))


@query("src_stored_shards")
def q_src_stored_shards(spark, sf_dir):
    """One stored table per day, picked by its name's suffix."""
    base = _scratch(spark, "shards")
    write_shards(load_raw_sessions(spark, sf_dir), base)
    return _raw_leaves(read_shards(spark, base, "20240108", "20240121"))


@query("src_days_of_a_table")
def q_src_days_of_a_table(spark, sf_dir):
    """The stored ``date=`` layout, read for the days of another table (dynamic partition pruning): days with a
    purchase of 250 or more."""
    path = _scratch(spark, "raw")
    write_sessions(load_raw_sessions(spark, sf_dir), path)
    big = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_type = 'purchase' and value >= 250")
    return _raw_leaves(read_days(spark, path, big.select(F.date_format("ts", "yyyyMMdd").alias("date"))))


@query("stg_sessions")
def q_stg_sessions(spark, sf_dir):
    return staged(spark, sf_dir)


# ---- campaign performance ------------------------------------------------------------


@query("channel_grouping_full")
def q_channel_grouping_full(spark, sf_dir):
    """Channel of every (source, medium) seen, with its session count."""
    return (staged(spark, sf_dir).groupBy("traffic_source", "traffic_medium")
            .agg(F.count(F.lit(1)).alias("sessions"))
            .withColumn("channel_grouping", channel_grouping(full=True)))


@query("channel_grouping_short")
def q_channel_grouping_short(spark, sf_dir):
    """The attribution/funnel variant of the channel rule."""
    return (staged(spark, sf_dir).groupBy("traffic_source", "traffic_medium")
            .agg(F.count(F.lit(1)).alias("sessions"))
            .withColumn("channel_grouping", channel_grouping(full=False)))


@query("campaign_identifier")
def q_campaign_identifier(spark, sf_dir):
    """Identifier of every raw (source, medium, campaign)."""
    return (staged(spark, sf_dir).groupBy("traffic_source", "traffic_medium", "campaign_name")
            .agg(F.count(F.lit(1)).alias("sessions"))
            .withColumn("campaign_identifier", campaign_identifier()))


@query("int_campaign_metrics")
def q_int_campaign_metrics(spark, sf_dir):
    return int_campaign_metrics(staged(spark, sf_dir))


@query("mart_campaign_performance")
def q_mart_campaign_performance(spark, sf_dir):
    return _campaign_mart(spark, sf_dir)


@query("campaign_daily_refreshed")
def q_campaign_daily_refreshed(spark, sf_dir):
    """The daily table built by the stream, in several micro-batches of stored days, read through its manifest."""
    raw, out = _scratch(spark, "raw"), _scratch(spark, "refresh")
    write_sessions(load_raw_sessions(spark, sf_dir), raw)
    start_campaign_refresh(spark, raw, out, available_now=True, files_per_batch=12).awaitTermination()
    return daily_table(spark, out)


@query("campaign_mart_refreshed")
def q_campaign_mart_refreshed(spark, sf_dir):
    """The campaign mart of the newest snapshot."""
    raw, out = _scratch(spark, "raw"), _scratch(spark, "refresh")
    write_sessions(load_raw_sessions(spark, sf_dir), raw)
    start_campaign_refresh(spark, raw, out, available_now=True, files_per_batch=12).awaitTermination()
    return mart_table(spark, out)


def _visitor_states(spark, sf_dir):
    """The stored daily visitor states."""
    def build():
        base = _scratch(spark, "visitors")
        stg = staged(spark, sf_dir)
        dv.extend_numbers(stg).write.parquet(f"{base}/numbers")
        dv.daily_states(stg, spark.read.parquet(f"{base}/numbers")).write.partitionBy("session_date").parquet(f"{base}/states")
        return spark.read.parquet(f"{base}/states").withColumn("session_date", F.col("session_date").cast("date"))
    return stored(spark, sf_dir, "visitor_states", build)


@query("distinct_visitors_weekly")
def q_distinct_visitors_weekly(spark, sf_dir):
    """True distinct visitors by campaign, device and week, merged from stored daily states."""
    return dv.distinct_visitors(_visitor_states(spark, sf_dir), {
        "campaign_name": "campaign_name", "device_category": "device_category", "week": F.trunc("session_date", "week")})


@query("distinct_visitors_by_channel")
def q_distinct_visitors_by_channel(spark, sf_dir):
    """M6: true distinct visitors by channel over all days, from the same states."""
    return dv.distinct_visitors(_visitor_states(spark, sf_dir), {"channel_grouping": channel_grouping(full=True)})


# ---- attribution ------------------------------------------------------------------------


@query("session_sequence")
def q_session_sequence(spark, sf_dir):
    """W1 + W2: position of each session in its visitor's journey and the journey length."""
    seq = attr.sequenced_sessions(staged(spark, sf_dir))
    return seq.select("session_id", "visitor_id", "session_start_timestamp", "session_sequence",
                      "total_sessions_per_visitor")


@query("touch_flags")
def q_touch_flags(spark, sf_dir):
    """First / last touch flags and the linear weight."""
    df = attr.with_touch_flags(attr.sequenced_sessions(staged(spark, sf_dir)))
    return df.select("session_id", "visitor_id", "session_sequence", "total_sessions_per_visitor",
                     "is_first_touch", "is_last_touch", "linear_weight")


@query("int_session_attribution")
def q_int_session_attribution(spark, sf_dir):
    return attr.int_session_attribution(staged(spark, sf_dir))


@query("mart_attribution_analysis")
def q_mart_attribution_analysis(spark, sf_dir):
    return _attribution_mart(spark, sf_dir)


# ---- funnel -------------------------------------------------------------------------------


@query("funnel_flags")
def q_funnel_flags(spark, sf_dir):
    """The four stage flags of every session."""
    return funnel.funnel_sessions(staged(spark, sf_dir)).select(
        "session_id", "reached_landing", "reached_engagement", "reached_deep_engagement", "reached_conversion")


@query("funnel_exit_stage")
def q_funnel_exit_stage(spark, sf_dir):
    """Sessions per exit stage."""
    return (funnel.funnel_sessions(staged(spark, sf_dir)).groupBy("funnel_exit_stage")
            .agg(F.count(F.lit(1)).alias("sessions")))


@query("engagement_score")
def q_engagement_score(spark, sf_dir):
    """C14: engagement score of every session (NULL when pageviews is NULL)."""
    return funnel.funnel_sessions(staged(spark, sf_dir)).select("session_id", "engagement_score")


@query("visitor_journey")
def q_visitor_journey(spark, sf_dir):
    return funnel.visitor_journey(staged(spark, sf_dir))


@query("int_funnel_steps")
def q_int_funnel_steps(spark, sf_dir):
    return funnel.int_funnel_steps(staged(spark, sf_dir))


@query("mart_conversion_funnel")
def q_mart_conversion_funnel(spark, sf_dir):
    return _funnel_mart(spark, sf_dir)


# ---- data tests ------------------------------------------------------------------------


DQ_START, DQ_END = _dt.date(2024, 1, 1), _dt.date(2024, 1, 31)


@query("dq_staging")
def q_dq_staging(spark, sf_dir):
    return quality.run_checks(staged(spark, sf_dir), "stg_ga_sessions", quality.staging_tests(DQ_START, DQ_END))


@query("dq_campaign")
def q_dq_campaign(spark, sf_dir):
    return quality.run_checks(_campaign_mart(spark, sf_dir), "mart_campaign_performance", quality.CAMPAIGN_TESTS)


@query("dq_attribution")
def q_dq_attribution(spark, sf_dir):
    return quality.run_checks(_attribution_mart(spark, sf_dir), "mart_attribution_analysis",
                              quality.ATTRIBUTION_TESTS)


@query("dq_funnel")
def q_dq_funnel(spark, sf_dir):
    return quality.run_checks(_funnel_mart(spark, sf_dir), "mart_conversion_funnel", quality.FUNNEL_TESTS)


# ---- dashboard ---------------------------------------------------------------------------


for _name, _fn, _mart in [
    ("dash_campaign_kpis", dash.campaign_kpis, _campaign_mart),
    ("dash_roas_by_channel", dash.roas_by_channel, _campaign_mart),
    ("dash_device_share", dash.device_share, _campaign_mart),
    ("dash_campaign_table", dash.campaign_table, _campaign_mart),
    ("dash_attribution_totals", dash.attribution_totals, _attribution_mart),
    ("dash_attribution_by_channel", dash.attribution_by_channel, _attribution_mart),
    ("dash_channel_roles", dash.channel_roles, _attribution_mart),
    ("dash_attribution_table", dash.attribution_table, _attribution_mart),
    ("dash_funnel_totals", dash.funnel_totals, _funnel_mart),
    ("dash_dropoff_distribution", dash.dropoff_distribution, _funnel_mart),
    ("dash_dropoff_table", dash.dropoff_table, _funnel_mart),
    ("dash_health_by_channel", dash.health_by_channel, _funnel_mart),
]:
    QUERIES[_name] = (lambda fn, mart: lambda spark, sf_dir: fn(mart(spark, sf_dir)))(_fn, _mart)


def _cuboids(spark, sf_dir):
    return stored(spark, sf_dir, "cuboids", lambda: cube.build_cuboids(staged(spark, sf_dir), _scratch(spark, "cuboids")))


PAGE_FILTERS = {"country": ["NATION_1", "NATION_4", "NATION_7"], "session_date": ("between", _dt.date(2024, 1, 8), _dt.date(2024, 1, 21))}


@query("dash_kpis_filtered")
def q_dash_kpis_filtered(spark, sf_dir):
    """K1 + K13: the first page's figures for three countries and two weeks."""
    return cube.kpis(_cuboids(spark, sf_dir), [], PAGE_FILTERS)


@query("dash_channel_device_filtered")
def q_dash_channel_device_filtered(spark, sf_dir):
    """K2-K4 + K13: by channel and device, for three countries and two weeks."""
    return cube.kpis(_cuboids(spark, sf_dir), ["channel_grouping", "device_category"], PAGE_FILTERS)


@query("dash_daily_country")
def q_dash_daily_country(spark, sf_dir):
    """K4 + K13: by day and country, mobile sessions of two channels."""
    return cube.kpis(_cuboids(spark, sf_dir), ["session_date", "country"],
                     {"device_category": "mobile", "channel_grouping": ["Paid Search", "Social"]})


@query("dash_funnel_filtered")
def q_dash_funnel_filtered(spark, sf_dir):
    """K9-K11 + K13: the funnel by channel for one country."""
    return cube.funnel(_cuboids(spark, sf_dir), ["channel_grouping"], {"country": "NATION_4"})


# ---- published tables ----------------------------------------------------------------------


def _readback(name: str, schema: str, mart):
    def run(spark, sf_dir):
        rows = mart(spark, sf_dir)
        return sinks.publish_table(spark, rows, name, schema, _scratch(spark, "published")).select(*rows.columns)
    run.__doc__ = f"S3/S5/S6: {name} as a build in schema {schema}, read through its view."
    return run


for _name, _schema, _mart in [("mart_campaign_performance", "campaign_performance", _campaign_mart),
                              ("mart_attribution_analysis", "attribution", _attribution_mart),
                              ("mart_conversion_funnel", "funnel", _funnel_mart)]:
    QUERIES[f"{_name}_readback"] = _readback(_name, _schema, _mart)


# ---- metrics -------------------------------------------------------------------------------

for _name, _fn in [
    ("metric_new_vs_returning", metrics.new_vs_returning),
    ("metric_goal_completion", metrics.goal_completion),
    ("metric_engagement_rate", metrics.engagement_rate),
    ("metric_page_depth", metrics.page_depth),
    ("metric_dwell_time", metrics.dwell_time),
    ("metric_revenue_per_visitor", metrics.revenue_per_visitor),
    ("metric_exit_distribution", metrics.exit_distribution),
    ("metric_country", metrics.country_metrics),
]:
    QUERIES[_name] = (lambda fn: lambda spark, sf_dir: fn(staged(spark, sf_dir)))(_fn)


@query("metric_cost_per_session")
def q_metric_cost_per_session(spark, sf_dir):
    return metrics.cost_per_session(_campaign_mart(spark, sf_dir))


@query("metric_benchmark_bands")
def q_metric_benchmark_bands(spark, sf_dir):
    return metrics.benchmark_bands(_campaign_mart(spark, sf_dir))


@query("metric_assisted_conversions")
def q_metric_assisted_conversions(spark, sf_dir):
    return metrics.assisted_conversions(attr.int_session_attribution(staged(spark, sf_dir)))


@query("metric_journey_assists")
def q_metric_journey_assists(spark, sf_dir):
    return metrics.journey_assists(staged(spark, sf_dir))


# ---- roadmap models (R1-R7) -----------------------------------------------------------

for _name, _fn in [("attr_u_shaped", jm.u_shaped_attribution), ("attr_w_shaped", jm.w_shaped_attribution),
                   ("attr_time_decay", jm.time_decay_attribution), ("cohort_retention", jm.cohort_retention)]:
    QUERIES[_name] = (lambda fn: lambda spark, sf_dir: fn(staged(spark, sf_dir)))(_fn)
for _name, _fn in [("daily_trend", jm.daily_trend), ("days_to_conversion", jm.days_to_conversion),
                   ("rfm_segments", jm.rfm_segments)]:
    QUERIES[_name] = (lambda fn: lambda spark, sf_dir: fn(staged(spark, sf_dir)))(_fn)


@query("segment_kmeans")
def q_segment_kmeans(spark, sf_dir):
    """K-means segments in exact arithmetic."""
    return jm.kmeans_segments(staged(spark, sf_dir))
