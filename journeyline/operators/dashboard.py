"""The dashboard's queries over the three marts.

Each function takes a mart and optional equality filters (K13: channel, device, country,
role), and returns a small aggregate. Shares use a window over the already aggregated
rows (a handful of groups), never over the mart rows. Sums and averages of values that
the marts already rounded are taken as exact integers of cents (or tenths), so every
engine reports the same figure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import avg_rounded, round_to, safe_div, share_pct, sum_rounded, sum_usd
from .funnel import stage_metrics


def apply_filters(df: DataFrame, filters: dict | None) -> DataFrame:
    """Page filters are equality predicates on mart dimensions."""
    for column, value in (filters or {}).items():
        df = df.where(F.col(column).isin(list(value)) if isinstance(value, (list, tuple, set))
                      else F.col(column) == value)
    return df


# ---- page 1: campaign performance ------------------------------------------------------------
def campaign_kpis(mart: DataFrame, filters: dict | None = None) -> DataFrame:
    """K1: revenue, sessions, conversions, average of row conversion rates, average ROAS."""
    m = apply_filters(mart, filters)
    return m.agg(
        round_to(sum_usd("total_revenue"), 2).alias("total_revenue"),
        F.sum("total_sessions").alias("total_sessions"),
        F.sum("total_conversions").alias("total_conversions"),
        round_to(avg_rounded("conversion_rate_pct"), 2).alias("avg_conversion_rate_pct"),
        round_to(avg_rounded("roas"), 2).alias("avg_roas"),
        round_to(safe_div(F.sum("total_conversions"), F.sum("total_sessions")) * 100, 2)
        .alias("overall_conversion_rate_pct"),
    )


def roas_by_channel(mart: DataFrame, filters: dict | None = None) -> DataFrame:
    """K2: ROAS of paid rows by channel (rows without ROAS are left out)."""
    m = apply_filters(mart, filters).where(F.col("roas").isNotNull())
    return m.groupBy("channel_grouping").agg(
        F.count(F.lit(1)).alias("campaign_rows"),
        round_to(avg_rounded("roas"), 2).alias("avg_roas"),
        round_to(sum_usd("total_revenue"), 2).alias("total_revenue"),
        round_to(F.sum("estimated_cost"), 2).alias("total_cost"),
        round_to(safe_div(sum_usd("total_revenue"), F.sum("estimated_cost")), 2).alias("pooled_roas"),
    )


def device_share(mart: DataFrame, filters: dict | None = None) -> DataFrame:
    """K3: share of conversions (and sessions) by device, with each device's conversion rate."""
    g = apply_filters(mart, filters).groupBy("device_category").agg(
        F.sum("total_sessions").alias("sessions"), F.sum("total_conversions").alias("conversions"),
        round_to(sum_usd("total_revenue"), 2).alias("revenue"))
    return g.select(
        "device_category", "sessions", "conversions", "revenue",
        share_pct("conversions").alias("share_of_conversions_pct"),
        share_pct("sessions").alias("share_of_sessions_pct"),
        round_to(safe_div("conversions", "sessions") * 100, 2).alias("conversion_rate_pct"))


def campaign_table(mart: DataFrame, filters: dict | None = None) -> DataFrame:
    """K4: channel x source table: sessions, conversions, rate, revenue, ROAS, quality score."""
    g = apply_filters(mart, filters).groupBy("channel_grouping", "traffic_source").agg(
        F.sum("total_sessions").alias("sessions"), F.sum("total_conversions").alias("conversions"),
        sum_usd("total_revenue").alias("_revenue"), F.sum("estimated_cost").alias("_cost"),
        F.sum(F.col("total_sessions") * F.round(F.col("engagement_quality_score") * 10).cast("bigint"))
        .alias("_q_tenths"))
    return g.select(
        "channel_grouping", "traffic_source", "sessions", "conversions",
        round_to(safe_div("conversions", "sessions") * 100, 2).alias("conversion_rate_pct"),
        round_to(F.col("_revenue"), 2).alias("revenue"),
        F.when(F.col("_cost") > 0, round_to(F.try_divide(F.col("_revenue"), F.col("_cost")), 2)).alias("roas"),
        round_to(F.col("_q_tenths").cast("double") / (F.col("sessions").cast("double") * 10.0), 2)
        .alias("quality_score"),
    ).orderBy(F.desc("revenue"), "channel_grouping", "traffic_source")


# ---- page 2: attribution ---------------------------------------------------------------------
def attribution_totals(mart: DataFrame, filters: dict | None = None) -> DataFrame:
    """K5: total revenue credited by each model (equal when every conversion is credited)."""
    m = apply_filters(mart, filters)
    return m.agg(*[round_to(sum_rounded(c), 2).alias(c) for c in
                   ["first_touch_revenue", "last_touch_revenue", "linear_attribution_revenue"]])


def attribution_by_channel(mart: DataFrame, filters: dict | None = None) -> DataFrame:
    """K6: revenue by channel under the three models, one row per (channel, model)."""
    g = apply_filters(mart, filters).groupBy("channel_grouping").agg(
        round_to(sum_rounded("first_touch_revenue"), 2).alias("first_touch"),
        round_to(sum_rounded("last_touch_revenue"), 2).alias("last_touch"),
        round_to(sum_rounded("linear_attribution_revenue"), 2).alias("linear"))
    return g.unpivot("channel_grouping", ["first_touch", "last_touch", "linear"], "attribution_model", "revenue")


def channel_roles(mart: DataFrame, filters: dict | None = None) -> DataFrame:
    """K7: distribution of channel roles, by mart rows and by sessions (the base is not stated)."""
    g = apply_filters(mart, filters).groupBy("channel_role").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_sessions").alias("sessions"))
    return g.select("channel_role", "rows", "sessions", share_pct("rows").alias("share_of_rows_pct"),
                    share_pct("sessions").alias("share_of_sessions_pct"))


def attribution_table(mart: DataFrame, filters: dict | None = None) -> DataFrame:
    """K8: the attribution table, sorted by linear revenue."""
    return (apply_filters(mart, filters)
            .select("traffic_source", "traffic_medium", "campaign_name", "channel_grouping", "channel_role",
                    "total_sessions", "first_touch_revenue", "last_touch_revenue", "linear_attribution_revenue",
                    "avg_sessions_per_visitor")
            .orderBy(F.desc("linear_attribution_revenue"), "traffic_source", "traffic_medium", "campaign_name"))


# ---- page 3: funnel --------------------------------------------------------------------------
STAGES = ["sessions_landing", "sessions_engagement", "sessions_deep_engagement", "sessions_conversion"]


def funnel_totals(mart: DataFrame, filters: dict | None = None) -> DataFrame:
    """K9: stage totals and the overall rate as a ratio of sums (not an average of rates)."""
    g = apply_filters(mart, filters).agg(*[F.sum(c).alias(c) for c in STAGES])
    land = "sessions_landing"
    return g.select(
        *STAGES,
        round_to(safe_div("sessions_conversion", land) * 100, 2).alias("overall_conversion_rate_pct"),
        round_to(safe_div("sessions_engagement", land) * 100, 2).alias("landing_to_engagement_pct"),
        round_to(safe_div("sessions_deep_engagement", "sessions_engagement") * 100, 2)
        .alias("engagement_to_deep_pct"),
        round_to(safe_div("sessions_conversion", "sessions_deep_engagement") * 100, 2)
        .alias("deep_to_conversion_pct"))


def dropoff_distribution(mart: DataFrame, filters: dict | None = None) -> DataFrame:
    """Share of primary drop-off stages, by mart rows and by landing sessions."""
    g = apply_filters(mart, filters).groupBy("primary_dropoff_stage").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("sessions_landing").alias("sessions"))
    return g.select("primary_dropoff_stage", "rows", "sessions", share_pct("rows").alias("share_of_rows_pct"),
                    share_pct("sessions").alias("share_of_sessions_pct"))


def dropoff_table(mart: DataFrame, filters: dict | None = None) -> DataFrame:
    """Stage counts, rates, biggest drop-off and health score by channel x device x country."""
    keys = ["channel_grouping", "device_category", "country"]
    g = apply_filters(mart, filters).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in STAGES])
    return stage_metrics(g).select(
        *keys, *STAGES, "primary_dropoff_stage", "landing_to_engagement_rate", "engagement_to_deep_rate",
        "deep_to_conversion_rate", "overall_conversion_rate", "funnel_health_score")


def health_by_channel(mart: DataFrame, filters: dict | None = None) -> DataFrame:
    """Average funnel health score by channel (rows without a score are skipped)."""
    return apply_filters(mart, filters).groupBy("channel_grouping").agg(
        F.count(F.lit(1)).alias("rows"), F.count("funnel_health_score").alias("scored_rows"),
        round_to(avg_rounded("funnel_health_score", 1), 2).alias("avg_funnel_health_score"))
