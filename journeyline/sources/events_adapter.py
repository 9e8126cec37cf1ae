"""Raw session records derived from the driver's ``events`` and ``nation`` tables.

The test data has no web-session table, so the raw nested session record is built
from the event stream with exact integer rules (shared with the DuckDB oracle):

* visitor: ``user_id % 10 = 9`` -> ``"{user_id}.e{event_id}"``, else
  ``"{user_id}.{(es div 86400) div (1 + user_id % 6)}"`` where ``es`` is the floor of
  the event's epoch seconds (UTC);
* sessions: within a visitor, ordered by ``(ts, event_id)``, a new session starts when
  the gap in ``es`` to the previous event exceeds 8 hours.

Sessionization does not sort a visitor's events in one task. Time is cut into 8-hour
buckets; an event can open a session only if it is the first of its bucket, and then
only if the previous bucket of the same visitor is empty or ended more than 8 hours
earlier (events two buckets back are always more than 8 hours away). So the job is:
(1) one aggregation of events to (visitor, bucket) with map-side partial aggregation,
(2) a window over the bucket rows of each visitor (at most one row per 8 hours of the
covered time span, whatever the visitor's event count) to find session starts, and
(3) a second aggregation of the bucket rows into sessions. Every session measure is
distributive (count, sum, min, max), so the event rows are shuffled exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import flag, idiv, long_lit

GAP_SECONDS = 28_800
SECONDS_PER_DAY = 86_400

# Fixed values of the adapter: traffic index -> (source, medium, campaign rule).
# Campaign rule: None = NULL, a plain string = that value, "<Prefix> {k%7}" = prefix + k % 7,
# "bing-parity" = '(not set)' for even k and NULL for odd k.
TRAFFIC = [
    (0, "google", "organic", "(not set)"),
    (1, "google", "cpc", "Brand {k%7}"),
    (2, "(direct)", "(none)", "(not set)"),
    (3, "partner.example", "referral", None),
    (4, "youtube.com", "referral", "(not set)"),
    (5, "facebook.com", "(not set)", "Promo {k%7}"),
    (6, "newsletter", "email", "Digest {k%7}"),
    (7, "community", "social", "(not set)"),
    (8, "facebook.com", "cpc", "Retarget {k%7}"),
    (9, "dfa", "cpm", "Display {k%7}"),
    (10, "bing", "organic", "bing-parity"),
    (11, "twitter.com", "(none)", "(not set)"),
    (12, "duckduckgo", "organic", "(not set)"),
]
PURCHASE_MIN_VALUE = 60.0


def _visitor_id(user, event_id, es):
    period = idiv(idiv(es, SECONDS_PER_DAY), F.lit(1) + user % 6)
    return (F.when(user % 10 == 9, F.concat(user.cast("string"), F.lit(".e"), event_id.cast("string")))
            .otherwise(F.concat(user.cast("string"), F.lit("."), period.cast("string"))))


def _sql_text(v) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def _campaign_sql(campaign) -> str:
    if campaign == "bing-parity":
        return "CASE WHEN k % 2 = 0 THEN '(not set)' END"
    if campaign is not None and "{k%7}" in campaign:
        return f"concat({_sql_text(campaign.replace('{k%7}', ''))}, CAST(k % 7 AS STRING))"
    return _sql_text(campaign)


def _traffic(position: int):
    """One CASE over the traffic index ``ti`` (built as a single expression, not call by call)."""
    if position == 3:
        branches = " ".join(f"WHEN {t[0]} THEN {_campaign_sql(t[3])}" for t in TRAFFIC)
    else:
        branches = " ".join(f"WHEN {t[0]} THEN {_sql_text(t[position])}" for t in TRAFFIC)
    return F.expr(f"CASE ti {branches} END")


def event_buckets(events: DataFrame) -> DataFrame:
    """Events aggregated to (visitor, 8-hour bucket): the only shuffle of event rows."""
    es = F.unix_seconds(F.col("ts").cast("timestamp"))
    is_purchase = (F.col("event_type") == "purchase") & (F.col("value") >= PURCHASE_MIN_VALUE)
    ev = events.select(
        F.col("user_id").alias("user_id"),
        _visitor_id(F.col("user_id"), F.col("event_id"), es).alias("visitor"),
        idiv(es, GAP_SECONDS).alias("bucket"),
        es.alias("es"),
        F.col("event_id"),
        flag(F.col("event_type").isin("view", "click")).alias("pv"),
        flag(is_purchase).alias("txn"),
        F.when(is_purchase, F.round(F.col("value") * 100).cast("bigint") * 10_000)
         .otherwise(long_lit(0)).alias("rev_micros"),
    )
    return ev.groupBy("visitor", "bucket").agg(
        F.min("user_id").alias("user_id"),
        F.count(F.lit(1)).alias("hits"),
        F.sum("pv").alias("pv"),
        F.sum("txn").alias("txn"),
        F.sum("rev_micros").alias("rev_micros"),
        F.min("es").alias("first_es"),
        F.max("es").alias("last_es"),
        F.min("event_id").alias("k"),
    )


def sessions_from_events(events: DataFrame, nation: DataFrame) -> DataFrame:
    """Raw nested session records (schema ``RAW_SESSIONS``) from events + nation."""
    buckets = event_buckets(events)
    by_visitor = Window.partitionBy("visitor").orderBy("bucket")
    prev_bucket = F.lag("bucket").over(by_visitor)
    prev_last = F.lag("last_es").over(by_visitor)
    opens = (prev_bucket.isNull() | (prev_bucket != F.col("bucket") - 1)
             | (F.col("first_es") - prev_last > GAP_SECONDS))
    session_of_bucket = F.last(F.when(F.col("opens"), F.col("bucket")), ignorenulls=True).over(
        by_visitor.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sessions = (buckets.withColumn("opens", opens)
                .withColumn("session_bucket", session_of_bucket)
                .groupBy("visitor", "session_bucket")
                .agg(F.min("user_id").alias("user_id"),
                     F.sum("hits").alias("hits"),
                     F.sum("pv").alias("pv"),
                     F.sum("txn").alias("txn"),
                     F.sum("rev_micros").alias("rev_micros"),
                     F.min("first_es").alias("start_es"),
                     F.max("last_es").alias("end_es"),
                     F.min("k").alias("k")))

    k, user = F.col("k"), F.col("user_id")
    ti = F.when(user % 10 == 9, F.lit(12)).otherwise((user + k % 3) % 12)
    device = (F.when(k % 10 == 0, "tablet").when((k % 10).isin(1, 2, 3), "mobile").otherwise("desktop"))
    # nation is a 25-row dimension: Spark broadcasts it from its own size estimate.
    countries = nation.select(F.col("n_nationkey").cast("bigint").alias("nation_key"), F.col("n_name"))
    start = F.col("start_es")
    return (sessions.withColumn("ti", ti).withColumn("nation_key", user % 25)
            .join(countries, "nation_key", "left")
            .select(
                F.col("visitor").alias("fullVisitorId"),
                start.alias("visitId"),
                start.alias("visitStartTime"),
                F.struct(
                    long_lit(1).alias("visits"),
                    F.col("hits").cast("bigint").alias("hits"),
                    F.nullif(F.col("pv"), long_lit(0)).cast("bigint").alias("pageviews"),
                    F.nullif(F.col("end_es") - start, long_lit(0)).cast("bigint").alias("timeOnSite"),
                    F.when(F.col("hits") == 1, long_lit(1)).alias("bounces"),
                    F.nullif(F.col("txn"), long_lit(0)).cast("bigint").alias("transactions"),
                    F.nullif(F.col("rev_micros"), long_lit(0)).cast("bigint").alias("transactionRevenue"),
                ).alias("totals"),
                F.struct(
                    _traffic(1).alias("source"),
                    _traffic(2).alias("medium"),
                    _traffic(3).alias("campaign"),
                    F.lit(None).cast("string").alias("keyword"),
                    F.lit(None).cast("string").alias("adContent"),
                ).alias("trafficSource"),
                F.struct(
                    F.lit("browser").alias("browser"),
                    device.alias("deviceCategory"),
                    F.lit("os").alias("operatingSystem"),
                ).alias("device"),
                F.struct(
                    F.col("n_name").alias("country"),
                    F.lit(None).cast("string").alias("city"),
                ).alias("geoNetwork"),
                F.date_format(F.timestamp_seconds(start), "yyyyMMdd").alias("date"),
            ))


def load_raw_sessions(spark, sf_dir: str) -> DataFrame:
    """Raw sessions for one scale-factor directory of the driver's tables."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return sessions_from_events(events, nation)
