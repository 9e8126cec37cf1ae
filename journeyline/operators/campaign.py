"""Campaign performance: daily campaign metrics (A1) and the campaign mart.

COUNT(DISTINCT session_id) and COUNT(DISTINCT visitor_id) are computed in three
aggregation levels instead of Spark's Expand-based distinct plan:
(keys, visitor, session) -> (keys, visitor) -> keys. The first shuffle is on a
near-unique key, the next two carry map-side partial aggregates, so neither a hot
visitor nor a hot campaign lands whole in one task, and no row is replicated.
Revenue travels as integer micros and becomes dollars once, at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.channels import campaign_identifier, channel_grouping, coalesce_campaign
from ..functions.numeric import round_to, safe_div, usd_from_micros

DAILY_KEYS = ["traffic_source", "traffic_medium", "campaign_name", "session_date", "device_category", "country"]
MART_KEYS = ["traffic_source", "traffic_medium", "campaign_name", "campaign_identifier", "channel_grouping",
             "device_category"]

# Placeholder cost per paid session.
PAID_SEARCH_COST_PER_SESSION = 1.0
PAID_SOCIAL_COST_PER_SESSION = 0.5

INT_CAMPAIGN_COLUMNS = [
    "traffic_source", "traffic_medium", "campaign_name", "campaign_identifier", "channel_grouping",
    "session_date", "device_category", "country", "sessions", "unique_visitors", "total_hits",
    "total_pageviews", "total_time_on_site", "bounces", "conversions", "total_transactions", "revenue",
    "avg_pageviews_per_session", "avg_time_on_site", "bounce_rate_pct", "conversion_rate_pct",
    "revenue_per_session", "revenue_per_conversion", "sessions_per_visitor", "pages_per_session",
]

MART_CAMPAIGN_COLUMNS = [
    "traffic_source", "traffic_medium", "campaign_name", "campaign_identifier", "channel_grouping",
    "device_category", "total_sessions", "total_unique_visitors", "total_pageviews", "total_bounces",
    "total_conversions", "total_revenue", "revenue_per_session", "revenue_per_conversion",
    "sessions_per_visitor", "conversion_rate_pct", "bounce_rate_pct", "avg_time_on_site_sec",
    "avg_pageviews_per_session", "engagement_quality_score", "estimated_cost", "roas", "cac",
]


def daily_campaign_metrics(stg: DataFrame) -> DataFrame:
    """Daily campaign metrics plus the exact integer revenue (``revenue_micros``) the mart needs."""
    # COALESCE the campaign before grouping so NULL and '(not set)' form one group.
    base = stg.select(
        "traffic_source", "traffic_medium", coalesce_campaign().alias("campaign_name"), "session_date",
        "device_category", "country", "visitor_id", "session_id", "hits",
        F.coalesce("pageviews", F.lit(0)).alias("pv"),
        F.coalesce("time_on_site_seconds", F.lit(0)).alias("tos"),
        "is_bounced", "is_converted",
        F.coalesce("transactions", F.lit(0)).alias("txn"),
        F.coalesce("transaction_revenue_micros", F.lit(0)).alias("rev"),
    )
    sums = ["hits", "pv", "tos", "is_bounced", "is_converted", "txn", "rev"]
    per_session = base.groupBy(*DAILY_KEYS, "visitor_id", "session_id").agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in sums])
    # count() of the id column: COUNT(DISTINCT ...) ignores a NULL id
    per_visitor = per_session.groupBy(*DAILY_KEYS, "visitor_id").agg(
        F.count("session_id").alias("sessions"), F.sum("rows").alias("rows"), *[F.sum(c).alias(c) for c in sums])
    g = per_visitor.groupBy(*DAILY_KEYS).agg(
        F.sum("sessions").alias("sessions"), F.count("visitor_id").alias("unique_visitors"),
        F.sum("rows").alias("rows"), *[F.sum(c).alias(c) for c in sums])

    revenue = usd_from_micros("rev")
    return g.select(
        *DAILY_KEYS,
        channel_grouping(full=True).alias("channel_grouping"),
        campaign_identifier().alias("campaign_identifier"),
        F.col("sessions"), F.col("unique_visitors"),
        F.col("hits").alias("total_hits"),
        F.col("pv").alias("total_pageviews"),
        F.col("tos").alias("total_time_on_site"),
        F.col("is_bounced").alias("bounces"),
        F.col("is_converted").alias("conversions"),
        F.col("txn").alias("total_transactions"),
        revenue.alias("revenue"),
        F.col("rev").alias("revenue_micros"),
        round_to(safe_div("pv", "rows"), 2).alias("avg_pageviews_per_session"),
        round_to(safe_div("tos", "rows"), 2).alias("avg_time_on_site"),
        round_to(safe_div("is_bounced", "sessions") * 100, 2).alias("bounce_rate_pct"),
        round_to(safe_div("is_converted", "sessions") * 100, 2).alias("conversion_rate_pct"),
        round_to(F.try_divide(revenue, F.col("sessions").cast("double")), 2).alias("revenue_per_session"),
        round_to(F.try_divide(revenue, F.col("is_converted").cast("double")), 2).alias("revenue_per_conversion"),
        round_to(safe_div("sessions", "unique_visitors"), 2).alias("sessions_per_visitor"),
        round_to(safe_div("pv", "sessions"), 2).alias("pages_per_session"),
    )


def int_campaign_metrics(stg: DataFrame) -> DataFrame:
    """One row per source x medium x campaign x date x device x country (25 columns)."""
    return daily_campaign_metrics(stg).select(*INT_CAMPAIGN_COLUMNS)


def _hundredths(c: str):
    """A value already rounded to 2 places, as exact integer hundredths."""
    return F.round(F.col(c) * 100).cast("bigint")


def mart_campaign_performance(stg: DataFrame) -> DataFrame:
    """Campaign mart: the daily rows rolled up over date and country (23 columns + writer stamp).

    ``total_unique_visitors`` is the sum of daily distinct counts, as in the reference.
    Session-weighted averages use the rounded daily values, as integer hundredths, so the
    sum is exact and a single division yields the average.
    """
    return mart_from_daily(daily_campaign_metrics(stg))


def mart_from_daily(daily: DataFrame) -> DataFrame:
    """The campaign mart from daily rows (``daily_campaign_metrics`` output)."""
    m = daily.groupBy(*MART_KEYS).agg(
        F.sum("sessions").alias("total_sessions"),
        F.sum("unique_visitors").alias("total_unique_visitors"),
        F.sum("total_pageviews").alias("total_pageviews"),
        F.sum("bounces").alias("total_bounces"),
        F.sum("conversions").alias("total_conversions"),
        F.sum("revenue_micros").alias("revenue_micros"),
        F.sum(F.col("sessions") * _hundredths("avg_time_on_site")).alias("w_time_h"),
        F.sum(F.col("sessions") * _hundredths("avg_pageviews_per_session")).alias("w_pv_h"),
    )
    total_revenue = usd_from_micros("revenue_micros")
    sessions = F.col("total_sessions").cast("double")
    avg_time = F.col("w_time_h").cast("double") / (F.lit(100.0) * sessions)
    avg_pv = F.col("w_pv_h").cast("double") / (F.lit(100.0) * sessions)
    bounce_ratio = safe_div("total_bounces", "total_sessions")
    quality = ((F.lit(100.0) - bounce_ratio * 100) * 0.4
               + F.least(F.lit(100.0), avg_pv * 10) * 0.3
               + F.least(F.lit(100.0), avg_time / 6) * 0.3)
    paid_search = F.col("channel_grouping") == "Paid Search"
    paid = F.col("channel_grouping").isin("Paid Search", "Social") & (F.col("traffic_medium") == "cpc")
    cost = (F.when(paid_search, sessions * PAID_SEARCH_COST_PER_SESSION)
            .when((F.col("channel_grouping") == "Social") & (F.col("traffic_medium") == "cpc"),
                  sessions * PAID_SOCIAL_COST_PER_SESSION)
            .otherwise(F.lit(0.0)))
    paid_cost = F.when(paid_search, sessions * PAID_SEARCH_COST_PER_SESSION).otherwise(
        sessions * PAID_SOCIAL_COST_PER_SESSION)
    return m.select(
        *MART_KEYS,
        "total_sessions", "total_unique_visitors", "total_pageviews", "total_bounces", "total_conversions",
        total_revenue.alias("total_revenue"),
        round_to(F.try_divide(total_revenue, sessions), 2).alias("revenue_per_session"),
        round_to(F.try_divide(total_revenue, F.col("total_conversions").cast("double")), 2)
        .alias("revenue_per_conversion"),
        round_to(safe_div("total_sessions", "total_unique_visitors"), 2).alias("sessions_per_visitor"),
        round_to(safe_div("total_conversions", "total_sessions") * 100, 2).alias("conversion_rate_pct"),
        round_to(bounce_ratio * 100, 2).alias("bounce_rate_pct"),
        round_to(avg_time, 2).alias("avg_time_on_site_sec"),
        round_to(avg_pv, 2).alias("avg_pageviews_per_session"),
        round_to(quality, 1).alias("engagement_quality_score"),
        cost.alias("estimated_cost"),
        F.when(paid, round_to(F.try_divide(total_revenue, paid_cost), 2)).alias("roas"),
        F.when(paid, round_to(F.try_divide(paid_cost, F.col("total_conversions").cast("double")), 2)).alias("cac"),
    )
