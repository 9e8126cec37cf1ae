"""Conversion funnel: stage flags (C10-C14), visitor journey (A4, C15), the join of
visitor totals back to sessions (J2) and the funnel mart (A5, C23-C27).

The funnel is not nested: conversion is independent of the engagement stages, so stage
counts need not decrease and drop-off rates can be negative. The reference keeps that,
and so does this module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.channels import campaign_identifier, channel_grouping, coalesce_campaign
from ..functions.numeric import flag, long_lit, round_to, safe_div, usd_from_micros
from ..functions.scores import (EXIT_STAGES, engagement_score, engagement_score_tenths, funnel_exit_stage,
                                reached_conversion, reached_deep_engagement, reached_engagement)
from .per_key import totals_within

SESSION_COLUMNS = ["session_id", "visitor_id", "session_date", "session_start_timestamp", "traffic_source",
                   "traffic_medium", "campaign_name", "device_category", "country", "hits", "pageviews",
                   "time_on_site_seconds", "is_bounced", "is_converted", "revenue_usd", "transactions"]
FLAG_COLUMNS = ["reached_landing", "reached_engagement", "reached_deep_engagement", "reached_conversion",
                "funnel_exit_stage", "engagement_score"]
VISITOR_COLUMNS = ["visitor_total_sessions", "visitor_sessions_at_engagement", "visitor_conversions",
                   "visitor_ever_converted", "visitor_total_revenue", "visitor_avg_engagement_score",
                   "visitor_days_active"]
JOURNEY_COLUMNS = ["visitor_id", "total_sessions", "sessions_at_landing", "sessions_at_engagement",
                   "sessions_at_deep_engagement", "sessions_with_conversion", "ever_converted", "total_revenue",
                   "avg_engagement_score", "first_session_date", "last_session_date"]
MART_KEYS = ["traffic_source", "traffic_medium", "campaign_name", "device_category", "country"]
MART_FUNNEL_COLUMNS = [
    "traffic_source", "traffic_medium", "campaign_name", "campaign_identifier", "channel_grouping",
    "device_category", "country", "sessions_landing", "sessions_engagement", "sessions_deep_engagement",
    "sessions_conversion", "visitors_landing", "visitors_converted", "visitor_conversion_rate",
    "landing_to_engagement_rate", "engagement_to_deep_rate", "deep_to_conversion_rate", "overall_conversion_rate",
    "dropoff_after_landing_pct", "dropoff_after_engagement_pct", "dropoff_after_deep_pct", "primary_dropoff_stage",
    "exits_at_landing", "exits_after_landing", "exits_at_engagement", "exits_at_deep_engagement", "exits_converted",
    "avg_engagement_score", "avg_visitor_engagement_score", "avg_visitor_days_active", "total_revenue",
    "revenue_per_visitor_conversion", "revenue_per_conversion", "revenue_per_landing", "funnel_health_score",
]
# Health-score weights of the three stage rates.
HEALTH_WEIGHTS = (0.3, 0.3, 0.4)
EXIT_COUNT_COLUMNS = ["exits_at_landing", "exits_after_landing", "exits_at_engagement", "exits_at_deep_engagement",
                      "exits_converted"]


def funnel_sessions(stg: DataFrame) -> DataFrame:
    """Session rows with the four stage flags, exit stage and engagement score.

    Two helper columns ride along for exact sums: ``_score_tenths`` and ``_rev_micros``.
    """
    return stg.select(
        *SESSION_COLUMNS,
        long_lit(1).alias("reached_landing"),
        reached_engagement().alias("reached_engagement"),
        reached_deep_engagement().alias("reached_deep_engagement"),
        reached_conversion().alias("reached_conversion"),
        funnel_exit_stage().alias("funnel_exit_stage"),
        engagement_score().alias("engagement_score"),
        engagement_score_tenths().alias("_score_tenths"),
        F.coalesce(F.col("transaction_revenue_micros"), long_lit(0)).alias("_rev_micros"),
    )


def visitor_totals(fs: DataFrame) -> DataFrame:
    """A4 with exact sums; COUNT(DISTINCT session_id) in two levels."""
    sums = ["reached_landing", "reached_engagement", "reached_deep_engagement", "reached_conversion",
            "_rev_micros", "_score_tenths"]
    per_session = fs.groupBy("visitor_id", "session_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.max("is_converted").alias("ever_converted"),
        F.count("_score_tenths").alias("_scores"), F.min("session_date").alias("first_session_date"),
        F.max("session_date").alias("last_session_date"), *[F.sum(c).alias(c) for c in sums])
    return per_session.groupBy("visitor_id").agg(
        F.count("session_id").alias("total_sessions"), F.sum("_rows").alias("_rows"),
        F.max("ever_converted").alias("ever_converted"), F.sum("_scores").alias("_scores"),
        F.min("first_session_date").alias("first_session_date"),
        F.max("last_session_date").alias("last_session_date"), *[F.sum(c).alias(c) for c in sums])


def visitor_journey(stg: DataFrame) -> DataFrame:
    """One row per visitor: sessions per stage, conversion, revenue, engagement, first/last date."""
    v = visitor_totals(funnel_sessions(stg))
    return v.select(
        "visitor_id", "total_sessions",
        F.col("reached_landing").alias("sessions_at_landing"),
        F.col("reached_engagement").alias("sessions_at_engagement"),
        F.col("reached_deep_engagement").alias("sessions_at_deep_engagement"),
        F.col("reached_conversion").alias("sessions_with_conversion"),
        "ever_converted",
        usd_from_micros("_rev_micros").alias("total_revenue"),
        F.try_divide(F.col("_score_tenths").cast("double"), F.col("_scores") * 10.0).alias("avg_engagement_score"),
        "first_session_date", "last_session_date")


def _funnel_steps(stg: DataFrame) -> DataFrame:
    """Sessions with their visitor's totals. A NULL visitor equals none, so its totals are NULL."""
    fs = funnel_sessions(stg)
    # rows of one session share a bucket; sessions without an id are told apart by their start
    spread = F.coalesce("session_id", F.col("session_start_timestamp").cast("string"))
    t = totals_within(fs, "visitor_id", spread, {
        "_engaged": ("sum", F.col("reached_engagement")), "_converted": ("sum", F.col("reached_conversion")),
        "_ever": ("max", F.col("is_converted")), "_micros": ("sum", F.col("_rev_micros")),
        "_tenths": ("sum", F.col("_score_tenths")), "_scores": ("sum", flag(F.col("_score_tenths").isNotNull())),
        "_first": ("min", F.col("session_date")), "_last": ("max", F.col("session_date"))}, {"_sessions": "session_id"})
    totals = {
        "visitor_total_sessions": F.col("_sessions"), "visitor_sessions_at_engagement": F.col("_engaged"),
        "visitor_conversions": F.col("_converted"), "visitor_ever_converted": F.col("_ever"),
        "visitor_total_revenue": usd_from_micros("_micros"),
        "visitor_avg_engagement_score": F.try_divide(F.col("_tenths").cast("double"), F.col("_scores") * 10.0),
        "visitor_days_active": F.datediff("_last", "_first").cast("bigint")}
    known = F.col("visitor_id").isNotNull()
    return t.select(*fs.columns, *[F.when(known, v).alias(name) for name, v in totals.items()])


def int_funnel_steps(stg: DataFrame) -> DataFrame:
    """Session rows with stage flags and their visitor's journey totals (29 columns)."""
    return _funnel_steps(stg).select(*SESSION_COLUMNS, *FLAG_COLUMNS, *VISITOR_COLUMNS)


def mart_conversion_funnel(stg: DataFrame) -> DataFrame:
    """Funnel mart by source x medium x campaign (coalesced) x device x country."""
    steps = _funnel_steps(stg)
    exits = {name: flag(F.col("funnel_exit_stage") == stage) for name, stage in zip(EXIT_COUNT_COLUMNS, EXIT_STAGES)}
    rows = steps.select(
        "traffic_source", "traffic_medium", coalesce_campaign().alias("campaign_name"), "device_category",
        "country", "visitor_id", "session_id", "reached_engagement", "reached_deep_engagement",
        "reached_conversion", "visitor_ever_converted", "_score_tenths", "visitor_days_active",
        F.col("visitor_avg_engagement_score").cast("decimal(38,18)").alias("_vavg"),
        F.when(F.col("reached_conversion") == 1, F.col("_rev_micros")).otherwise(long_lit(0)).alias("_conv_micros"),
        *[e.alias(n) for n, e in exits.items()])
    flags = ["reached_engagement", "reached_deep_engagement", "reached_conversion", *EXIT_COUNT_COLUMNS]
    sums = ["_score_tenths", "_vavg", "visitor_days_active", "_conv_micros"]
    counts = [F.count("_score_tenths").alias("_n_score"), F.count("_vavg").alias("_n_vavg"),
              F.count("visitor_days_active").alias("_n_days")]
    # Conditional COUNT(DISTINCT) in three levels (session, visitor, group): no Expand.
    per_session = rows.groupBy(*MART_KEYS, "visitor_id", "session_id").agg(
        *[F.max(c).alias(c) for c in flags], F.max("visitor_ever_converted").alias("_vconv"),
        *counts, *[F.sum(c).alias(c) for c in sums])
    # count() / sum() over non-NULL ids only: COUNT(DISTINCT ...) ignores a NULL id
    has_session = F.col("session_id").isNotNull()
    per_visitor = per_session.groupBy(*MART_KEYS, "visitor_id").agg(
        F.count("session_id").alias("_sessions"),
        *[F.coalesce(F.sum(F.when(has_session, F.col(c))), long_lit(0)).alias(c) for c in flags],
        F.max(F.when(F.col("_vconv") == 1, 1).otherwise(0)).alias("_vconv"),
        *[F.sum(c).alias(c) for c in ["_n_score", "_n_vavg", "_n_days", *sums]])
    g = per_visitor.groupBy(*MART_KEYS).agg(
        F.sum("_sessions").alias("sessions_landing"),
        F.sum("reached_engagement").alias("sessions_engagement"),
        F.sum("reached_deep_engagement").alias("sessions_deep_engagement"),
        F.sum("reached_conversion").alias("sessions_conversion"),
        F.count("visitor_id").alias("visitors_landing"),
        F.coalesce(F.sum(F.when(F.col("visitor_id").isNotNull(), F.col("_vconv"))), long_lit(0))
        .cast("bigint").alias("visitors_converted"),
        *[F.sum(c).alias(c) for c in EXIT_COUNT_COLUMNS],
        *[F.sum(c).alias(c) for c in ["_n_score", "_n_vavg", "_n_days", *sums]])

    m = stage_metrics(g).select(
        "*",
        round_to(F.try_divide(F.col("_score_tenths").cast("double"), F.col("_n_score") * 10.0), 2)
        .alias("avg_engagement_score"),
        round_to(F.try_divide(F.col("_vavg").cast("double"), F.col("_n_vavg").cast("double")), 2)
        .alias("avg_visitor_engagement_score"),
        round_to(safe_div("visitor_days_active", "_n_days"), 2).alias("avg_visitor_days_active"),
    )
    revenue = usd_from_micros("_conv_micros")
    return m.select(
        *MART_KEYS[:3],
        campaign_identifier().alias("campaign_identifier"),
        channel_grouping(full=False).alias("channel_grouping"),
        *MART_KEYS[3:],
        "sessions_landing", "sessions_engagement", "sessions_deep_engagement", "sessions_conversion",
        "visitors_landing", "visitors_converted", "visitor_conversion_rate", "landing_to_engagement_rate",
        "engagement_to_deep_rate", "deep_to_conversion_rate", "overall_conversion_rate",
        "dropoff_after_landing_pct", "dropoff_after_engagement_pct", "dropoff_after_deep_pct",
        "primary_dropoff_stage",
        *EXIT_COUNT_COLUMNS,
        "avg_engagement_score", "avg_visitor_engagement_score", "avg_visitor_days_active",
        round_to(revenue, 2).alias("total_revenue"),
        round_to(F.try_divide(revenue, F.col("visitors_converted").cast("double")), 2)
        .alias("revenue_per_visitor_conversion"),
        round_to(F.try_divide(revenue, F.col("sessions_conversion").cast("double")), 2).alias("revenue_per_conversion"),
        round_to(F.try_divide(revenue, F.col("sessions_landing").cast("double")), 2).alias("revenue_per_landing"),
        "funnel_health_score",
    )


def stage_metrics(df: DataFrame) -> DataFrame:
    """Stage rates, drop-off rates (4 places), primary drop-off stage and health score
    from the columns sessions_landing / _engagement / _deep_engagement / _conversion, plus the
    visitor conversion rate when visitors_landing / visitors_converted are present."""
    def rate(a, b):
        return round_to(safe_div(a, b), 4)

    land, eng, deep, conv = (F.col(c) for c in ["sessions_landing", "sessions_engagement",
                                                 "sessions_deep_engagement", "sessions_conversion"])
    if "visitors_landing" in df.columns:
        df = df.withColumn("visitor_conversion_rate", rate("visitors_converted", "visitors_landing"))
    df = df.withColumns({
        "landing_to_engagement_rate": rate("sessions_engagement", "sessions_landing"),
        "engagement_to_deep_rate": rate("sessions_deep_engagement", "sessions_engagement"),
        "deep_to_conversion_rate": rate("sessions_conversion", "sessions_deep_engagement"),
        "overall_conversion_rate": rate("sessions_conversion", "sessions_landing"),
        "dropoff_after_landing_pct": round_to(safe_div(land - eng, land), 4),
        "dropoff_after_engagement_pct": round_to(safe_div(eng - deep, eng), 4),
        "dropoff_after_deep_pct": round_to(safe_div(deep - conv, deep), 4),
    })
    w1, w2, w3 = HEALTH_WEIGHTS
    dl, de, dd = (F.col(c) for c in ["dropoff_after_landing_pct", "dropoff_after_engagement_pct",
                                      "dropoff_after_deep_pct"])
    # the greatest drop-off, the earlier stage on a tie; without sessions at a later stage its drop-off is 0
    candidates = [(dl, 3, "Landing"), (F.coalesce(de, F.lit(0.0)), 2, "Engagement"),
                  (F.coalesce(dd, F.lit(0.0)), 1, "Deep Engagement")]
    stage = F.array_max(F.array(*[F.struct(r.alias("rate"), F.lit(o).alias("turn"), F.lit(s).alias("stage"))
                                  for r, o, s in candidates]))["stage"]
    health = round_to((F.col("landing_to_engagement_rate") * 100) * w1 + (F.col("engagement_to_deep_rate") * 100) * w2
                      + (F.col("deep_to_conversion_rate") * 100) * w3, 1)
    return df.withColumns({"primary_dropoff_stage": stage, "funnel_health_score": health})
