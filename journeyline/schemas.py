"""Explicit schemas: the raw nested session record and the staged session table."""

from __future__ import annotations

from pyspark.sql.types import (DateType, DoubleType, LongType, StringType, StructField,
                               StructType, TimestampType)


def _fields(kind, *names):
    return [StructField(n, kind, True) for n in names]


TOTALS = StructType(_fields(LongType(), "visits", "hits", "pageviews", "timeOnSite", "bounces",
                            "transactions", "transactionRevenue"))
TRAFFIC_SOURCE = StructType(_fields(StringType(), "source", "medium", "campaign", "keyword", "adContent"))
DEVICE = StructType(_fields(StringType(), "browser", "deviceCategory", "operatingSystem"))
GEO_NETWORK = StructType(_fields(StringType(), "country", "city"))

# One raw session record; ``date`` (yyyyMMdd string) is the shard / partition column.
RAW_SESSIONS = StructType([
    StructField("fullVisitorId", StringType(), True),
    StructField("visitId", LongType(), True),
    StructField("visitStartTime", LongType(), True),
    StructField("totals", TOTALS, True),
    StructField("trafficSource", TRAFFIC_SOURCE, True),
    StructField("device", DEVICE, True),
    StructField("geoNetwork", GEO_NETWORK, True),
    StructField("date", StringType(), True),
])

# The staged, flat, one-row-per-session table (25 columns).
STG_SESSIONS = StructType([
    StructField("session_id", StringType()),
    StructField("visitor_id", StringType()),
    StructField("visit_id", LongType()),
    StructField("session_date", DateType()),
    StructField("session_start_timestamp", TimestampType()),
    *_fields(StringType(), "traffic_source", "traffic_medium", "campaign_name", "keyword", "ad_content"),
    *_fields(LongType(), "visits", "hits", "pageviews", "time_on_site_seconds", "bounces", "transactions",
             "transaction_revenue_micros"),
    *_fields(StringType(), "browser", "device_category", "operating_system", "country", "city"),
    *_fields(LongType(), "is_bounced", "is_converted"),
    StructField("revenue_usd", DoubleType()),
])
