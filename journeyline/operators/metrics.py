"""Metrics the metric guide defines and the models make derivable.

Every metric is an aggregation over the staged sessions, the funnel/attribution session
rows or a mart. Distinct visitor counts go through a (group, visitor) aggregation first,
so a hot visitor is reduced map-side before any shuffle on the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.channels import channel_grouping
from ..functions.numeric import long_lit, round_to, safe_div, share_pct, usd_from_micros
from .attribution import sequenced_sessions
from .funnel import visitor_totals, funnel_sessions
from .per_key import running_within

# Dwell-time buckets (seconds, left-closed) and benchmark bands.
DWELL_BUCKETS = [(0, "0-30s"), (30, "30-60s"), (60, "1-3min"), (180, "3-5min"), (300, "5-10min"), (600, "10min+")]
# (column, edges of the bands in ascending order, labels for each band); the last band starts beyond its edge
BENCHMARK_BANDS = [
    ("bounce_rate_pct", [30, 50, 70], ["Excellent", "Good", "Average", "Poor"]),
    ("conversion_rate_pct", [1, 2, 3], ["Poor", "Average", "Good", "Excellent"]),
    ("avg_pageviews_per_session", [2, 3, 4], ["Poor", "Average", "Good", "Excellent"]),
    ("avg_time_on_site_sec", [60, 180, 300], ["Poor", "Average", "Good", "Excellent"]),
    ("roas", [2.0, 4.0, 8.0], ["Poor", "Average", "Good", "Excellent"]),
]
PAGE_DEPTHS = [3, 5]


def band(c, edges, labels, last_beyond: bool = False) -> Column:
    """Label of the left-closed band [edge_i, edge_i+1) that holds the value; NULL stays NULL.
    With ``last_beyond`` the last band holds only values greater than the last edge."""
    value = F.col(c) if isinstance(c, str) else c
    rule = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        rule = rule.when(value <= edge if last_beyond and edge == edges[-1] else value < edge, label)
    return rule.otherwise(labels[-1])


def new_vs_returning(stg: DataFrame) -> DataFrame:
    """M1: visitors with one session (New) vs more (Returning)."""
    v = visitor_totals(funnel_sessions(stg)).where(F.col("visitor_id").isNotNull())
    kind = F.when(F.col("total_sessions") == 1, "New").otherwise("Returning")
    g = v.groupBy(kind.alias("visitor_type")).agg(
        F.count(F.lit(1)).alias("visitors"), F.sum("total_sessions").alias("sessions"),
        F.sum("ever_converted").alias("converting_visitors"), F.sum("_rev_micros").alias("_rev"))
    return g.select("visitor_type", "visitors", "sessions", "converting_visitors",
                    usd_from_micros("_rev").alias("revenue"), share_pct("visitors").alias("share_of_visitors_pct"))


def goal_completion(stg: DataFrame) -> DataFrame:
    """M2: sessions reaching each funnel stage, as a percentage of all sessions."""
    stages = ["reached_landing", "reached_engagement", "reached_deep_engagement", "reached_conversion"]
    totals = funnel_sessions(stg).agg(F.count(F.lit(1)).alias("sessions"), *[F.sum(s).alias(s) for s in stages])
    long = totals.unpivot("sessions", stages, "stage", "sessions_reached")
    return long.select("stage", "sessions_reached", "sessions",
                       round_to(safe_div("sessions_reached", "sessions") * 100, 2).alias("completion_rate_pct"))


def engagement_rate(stg: DataFrame) -> DataFrame:
    """M3: non-bounced share of sessions by channel."""
    g = stg.groupBy(channel_grouping(full=True).alias("channel_grouping")).agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("is_bounced").alias("bounced_sessions"))
    return g.withColumn("engagement_rate_pct",
                        round_to(safe_div(F.col("sessions") - F.col("bounced_sessions"), "sessions") * 100, 2))


def page_depth(stg: DataFrame) -> DataFrame:
    """M4: share of sessions with at least 3 / 5 pageviews, by device."""
    g = stg.groupBy("device_category").agg(
        F.count(F.lit(1)).alias("sessions"),
        *[F.count_if(F.col("pageviews") >= d).alias(f"sessions_{d}plus") for d in PAGE_DEPTHS])
    return g.select("*", *[round_to(safe_div(f"sessions_{d}plus", "sessions") * 100, 2).alias(f"pct_{d}plus")
                           for d in PAGE_DEPTHS])


def dwell_time(stg: DataFrame) -> DataFrame:
    """M5: sessions by time-on-site bucket (NULL time counts as 0 s)."""
    edges = [e for e, _ in DWELL_BUCKETS[1:]]
    labels = [label for _, label in DWELL_BUCKETS]
    bucket = band(F.coalesce(F.col("time_on_site_seconds"), F.lit(0)), edges, labels)
    g = stg.groupBy(bucket.alias("dwell_bucket")).agg(F.count(F.lit(1)).alias("sessions"))
    return g.withColumn("share_of_sessions_pct", share_pct("sessions"))


def revenue_per_visitor(stg: DataFrame) -> DataFrame:
    """M6: revenue per distinct visitor, by channel."""
    micros = F.coalesce(F.col("transaction_revenue_micros"), long_lit(0))
    per_visitor = stg.groupBy(channel_grouping(full=True).alias("channel_grouping"), "visitor_id").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum(micros).alias("_rev"))
    g = per_visitor.groupBy("channel_grouping").agg(  # count(visitor_id): a NULL visitor is not a visitor
        F.count("visitor_id").alias("visitors"), F.sum("sessions").alias("sessions"), F.sum("_rev").alias("_rev"))
    revenue = usd_from_micros("_rev")
    return g.select("channel_grouping", "visitors", "sessions", revenue.alias("revenue"),
                    round_to(F.try_divide(revenue, F.col("visitors").cast("double")), 2).alias("revenue_per_visitor"))


def cost_per_session(campaign_mart: DataFrame) -> DataFrame:
    """M7: placeholder cost per session, by channel."""
    g = campaign_mart.groupBy("channel_grouping").agg(
        F.sum("total_sessions").alias("sessions"), F.sum("estimated_cost").alias("estimated_cost"))
    return g.withColumn("cost_per_session", round_to(safe_div("estimated_cost", "sessions"), 4))


def exit_distribution(stg: DataFrame) -> DataFrame:
    """M8: where sessions that do not convert leave the funnel (a converted bounce is no exit)."""
    g = (funnel_sessions(stg).where(F.col("is_converted") == 0)
         .groupBy("funnel_exit_stage").agg(F.count(F.lit(1)).alias("exits")))
    return g.withColumn("share_of_exits_pct", share_pct("exits"))


def benchmark_bands(campaign_mart: DataFrame) -> DataFrame:
    """M9: each campaign-mart row banded Poor / Average / Good / Excellent on five metrics."""
    keys = ["traffic_source", "traffic_medium", "campaign_name", "device_category"]
    return campaign_mart.select(
        *keys, "channel_grouping",
        *[band(c, edges, labels, last_beyond=True).alias(f"{c}_band") for c, edges, labels in BENCHMARK_BANDS])


def country_metrics(stg: DataFrame) -> DataFrame:
    """Conversion rate and revenue by country, best revenue first."""
    micros = F.coalesce(F.col("transaction_revenue_micros"), long_lit(0))
    g = stg.groupBy("country").agg(F.count(F.lit(1)).alias("sessions"), F.sum("is_converted").alias("conversions"),
                                   F.sum(micros).alias("_rev"))
    return (g.select("country", "sessions", "conversions",
                     round_to(safe_div("conversions", "sessions") * 100, 2).alias("conversion_rate_pct"),
                     usd_from_micros("_rev").alias("revenue"))
            .orderBy(F.desc("revenue"), F.desc("conversion_rate_pct"), "country"))


def assisted_conversions(attributed_sessions: DataFrame) -> DataFrame:
    """Converting visitors a channel touched in a session other than the visitor's last.

    Input: per-session attribution rows (``int_session_attribution``).
    """
    assists = attributed_sessions.where((F.col("visitor_conversions") > 0) & (F.col("is_last_touch") == 0))
    per_visitor = assists.groupBy(channel_grouping(full=False).alias("channel_grouping"), "visitor_id").agg(
        F.count(F.lit(1)).alias("sessions"))
    return per_visitor.groupBy("channel_grouping").agg(
        F.count(F.lit(1)).alias("assisted_conversions"), F.sum("sessions").alias("assisted_sessions"))


def journey_assists(stg: DataFrame) -> DataFrame:
    """M11 in journey order, by channel: a visitor's sessions up to a conversion are that conversion's journey, the converting
    session closes it, and the others assist it. A session after the visitor's last conversion assists nothing.

    ``assisted_conversions``: conversions that the channel assisted with at least one session; ``closed_conversions``: those
    it closed; ``assist_ratio``: assisted per closed. A session's journey is the number of conversions before it, a
    running sum (operators/per_key.py)."""
    s = sequenced_sessions(stg.where(F.col("visitor_id").isNotNull()), keep=True)
    s = running_within(s, "visitor_id", "session_start_timestamp", ["session_id"], {"_through": F.col("is_converted")})
    s = s.withColumn("journey", F.col("_through") - F.col("is_converted")).where(F.col("journey") < F.col("visitor_conversions"))
    closes = F.col("is_converted") == 1
    per_journey = s.groupBy(channel_grouping(full=False).alias("channel_grouping"), "visitor_id", "journey").agg(
        F.count_if(~closes).alias("assists"), F.count_if(closes).alias("closed"))
    g = per_journey.groupBy("channel_grouping").agg(
        F.count_if(F.col("assists") > 0).alias("assisted_conversions"), F.sum("assists").alias("assisting_sessions"),
        F.sum("closed").alias("closed_conversions"))
    return g.withColumn("assist_ratio", round_to(safe_div("assisted_conversions", "closed_conversions"), 2))
