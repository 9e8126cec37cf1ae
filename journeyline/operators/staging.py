"""Staging: raw nested session record -> flat one-row-per-session table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import flag, usd_from_micros


def stg_sessions(raw: DataFrame) -> DataFrame:
    """The 25 staged columns; struct leaves are read by path so Parquet prunes the rest."""
    t, ts, d, g = "totals.", "trafficSource.", "device.", "geoNetwork."
    return raw.select(
        F.concat(F.col("fullVisitorId"), F.lit("-"), F.col("visitId").cast("string"), F.lit("-"),
                 F.col("date")).alias("session_id"),
        F.col("fullVisitorId").alias("visitor_id"),
        F.col("visitId").alias("visit_id"),
        F.to_date(F.col("date"), "yyyyMMdd").alias("session_date"),
        F.timestamp_seconds(F.col("visitStartTime")).alias("session_start_timestamp"),
        F.col(ts + "source").alias("traffic_source"),
        F.col(ts + "medium").alias("traffic_medium"),
        F.col(ts + "campaign").alias("campaign_name"),
        F.col(ts + "keyword").alias("keyword"),
        F.col(ts + "adContent").alias("ad_content"),
        F.col(t + "visits").alias("visits"),
        F.col(t + "hits").alias("hits"),
        F.col(t + "pageviews").alias("pageviews"),
        F.col(t + "timeOnSite").alias("time_on_site_seconds"),
        F.col(t + "bounces").alias("bounces"),
        F.col(t + "transactions").alias("transactions"),
        F.col(t + "transactionRevenue").alias("transaction_revenue_micros"),
        F.col(d + "browser").alias("browser"),
        F.col(d + "deviceCategory").alias("device_category"),
        F.col(d + "operatingSystem").alias("operating_system"),
        F.col(g + "country").alias("country"),
        F.col(g + "city").alias("city"),
        flag(F.col(t + "bounces") == 1).alias("is_bounced"),
        flag(F.col(t + "transactions") >= 1).alias("is_converted"),
        usd_from_micros(F.coalesce(F.col(t + "transactionRevenue"), F.lit(0))).alias("revenue_usd"),
    )

