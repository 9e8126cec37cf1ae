"""Multi-touch attribution: session sequence (W1, W2), touch flags (C4-C6), credited
revenue (C7-C9) and the attribution mart (A3, C19-C22).

The reference pairs every session of a visitor with every converting session of the
same visitor (a LEFT self-join: n sessions x k conversions rows) and sums credit over
the pairs. Pairs are never materialised here: a session's credit over its k pairs is a
closed form of per-visitor totals (k, and the summed conversion revenue R):

* first-touch credit = R if the session is the visitor's first, else 0;
* last-touch credit  = R if it is the visitor's last, else 0;
* linear credit      = R / n;
* a session stands for ``greatest(k, 1)`` pair rows, which weights the mart averages.

So the work is linear in sessions even when one visitor has millions of sessions and
conversions, and the per-visitor totals come from the same pass that numbers
the sessions (operators/per_key.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.channels import campaign_identifier, channel_grouping
from ..functions.numeric import exact, flag, long_lit, round_to, safe_div, share_of, usd_from_micros, usd_from_nanos
from .per_key import sequence_within

MART_KEYS = ["traffic_source", "traffic_medium", "campaign_name"]

# Channel-role and journey-complexity thresholds.
ROLE_RATIO = 1.5
BALANCED_SPREAD = 0.2
JOURNEY_BANDS = [(1.2, "Single-touch"), (2.5, "Short journey"), (4.0, "Medium journey")]
LONG_JOURNEY = "Long journey"

INT_ATTRIBUTION_COLUMNS = [
    "session_id", "visitor_id", "session_date", "session_start_timestamp", "traffic_source", "traffic_medium",
    "campaign_name", "is_converted", "revenue_usd", "session_sequence", "total_sessions_per_visitor",
    "is_first_touch", "is_last_touch", "linear_weight", "visitor_conversions", "attribution_rows",
    "conversion_revenue", "first_conversion_date", "last_conversion_date", "first_touch_revenue",
    "last_touch_revenue", "linear_attribution_revenue",
]

MART_ATTRIBUTION_COLUMNS = [
    "traffic_source", "traffic_medium", "campaign_name", "campaign_identifier", "channel_grouping",
    "channel_role", "journey_complexity", "total_sessions", "total_visitors", "avg_sessions_per_visitor",
    "avg_session_position_in_journey", "first_touch_sessions", "first_touch_conversions", "first_touch_revenue",
    "first_touch_revenue_per_session", "last_touch_sessions", "last_touch_conversions", "last_touch_revenue",
    "last_touch_revenue_per_session", "linear_conversions", "linear_attribution_revenue",
    "linear_revenue_per_session", "first_vs_last_revenue_diff", "first_vs_last_pct_diff",
]


def sequenced_sessions(stg: DataFrame, keep: bool = False) -> DataFrame:
    """Staged sessions with W1/W2 and the visitor's conversion totals attached. ``keep``: see ``sequence_within``."""
    micros = F.coalesce(F.col("transaction_revenue_micros"), long_lit(0))
    base = stg.select("visitor_id", "session_id", "session_date", "session_start_timestamp", "traffic_source",
                      "traffic_medium", "campaign_name", "is_converted", "revenue_usd",
                      micros.alias("revenue_micros"))
    converted = F.col("is_converted") == 1
    seq = sequence_within(
        base, "visitor_id", "session_start_timestamp", ["session_id"],  # ties on start time broken by session_id
        seq_col="session_sequence", count_col="total_sessions_per_visitor",
        key_aggs={
            "visitor_conversions": ("sum", F.col("is_converted")),
            "conversion_micros": ("sum", F.when(converted, F.col("revenue_micros")).otherwise(long_lit(0))),
            "first_conversion_date": ("min", F.when(converted, F.col("session_date"))),
            "last_conversion_date": ("max", F.when(converted, F.col("session_date"))),
            "visitor_first_date": ("min", F.col("session_date")),
        }, keep=keep)
    # The conversion join matches on visitor_id equality, so a NULL visitor pairs with nothing.
    no_visitor = F.col("visitor_id").isNull()
    return seq.withColumns({
        "visitor_conversions": F.when(no_visitor, long_lit(0)).otherwise(F.col("visitor_conversions")),
        "conversion_micros": F.when(no_visitor, long_lit(0)).otherwise(F.col("conversion_micros")),
        "first_conversion_date": F.when(~no_visitor, F.col("first_conversion_date")),
        "last_conversion_date": F.when(~no_visitor, F.col("last_conversion_date")),
    })


def with_touch_flags(seq: DataFrame) -> DataFrame:
    n = F.col("total_sessions_per_visitor")
    return (seq.withColumn("is_first_touch", flag(F.col("session_sequence") == 1))
               .withColumn("is_last_touch", flag(F.col("session_sequence") == n))
               .withColumn("linear_weight", F.lit(1.0) / n.cast("double")))


def _credits() -> dict[str, Column]:
    k, r = F.col("visitor_conversions"), F.col("conversion_micros")
    return {
        "first_micros": F.when((k > 0) & (F.col("is_first_touch") == 1), r).otherwise(long_lit(0)),
        "last_micros": F.when((k > 0) & (F.col("is_last_touch") == 1), r).otherwise(long_lit(0)),
        "attribution_rows": F.greatest(k, long_lit(1)),
    }


def _product(a: Column, b: Column, digits_b: int = 18) -> Column:
    """Exact product of two integers below 10^(38 - digits_b) and 10^digits_b: sums grow with the cube of a visitor's sessions."""
    return exact(a.cast(f"decimal({37 - digits_b},0)") * b.cast(f"decimal({digits_b},0)"))


def int_session_attribution(stg: DataFrame) -> DataFrame:
    """One row per session with its attribution credit summed over the visitor's conversions."""
    df = with_touch_flags(sequenced_sessions(stg))
    c = _credits()
    has = F.col("visitor_conversions") > 0
    n = F.col("total_sessions_per_visitor").cast("double")
    return df.select(
        *INT_ATTRIBUTION_COLUMNS[:15],
        c["attribution_rows"].alias("attribution_rows"),
        F.when(has, usd_from_micros("conversion_micros")).alias("conversion_revenue"),
        "first_conversion_date", "last_conversion_date",
        usd_from_micros(c["first_micros"]).alias("first_touch_revenue"),
        usd_from_micros(c["last_micros"]).alias("last_touch_revenue"),
        F.when(has, F.col("conversion_micros").cast("double") / (n * 1_000_000.0))
         .otherwise(F.lit(0.0)).alias("linear_attribution_revenue"),
    )


def mart_attribution_analysis(stg: DataFrame) -> DataFrame:
    """Attribution mart by source x medium x raw campaign (NULL campaign is its own group)."""
    df = with_touch_flags(sequenced_sessions(stg))
    rows = df.select(
        *MART_KEYS, "visitor_id", "session_id", F.col("is_first_touch").alias("f"), F.col("is_last_touch").alias("l"),
        F.col("session_sequence").alias("seq"), F.col("total_sessions_per_visitor").alias("n"),
        F.col("visitor_conversions").alias("k"), F.col("conversion_micros").alias("r"))
    # A visitor's sessions share n, k and R, so these are carried (max) and the credit is worked out once for each group and
    # visitor; 64-bit counts until then, decimals only in the last sums. Distinct counts in three levels: session,
    # visitor, group (see operators/campaign.py).
    shared = [F.max(c).alias(c) for c in ("n", "k", "r")]
    per_session = rows.groupBy(*MART_KEYS, "visitor_id", "session_id").agg(
        F.max("f").alias("f"), F.max("l").alias("l"), F.count(F.lit(1)).alias("rows"), F.sum("seq").alias("seq"), *shared)
    # count() / sum() over non-NULL ids only: COUNT(DISTINCT ...) ignores a NULL id
    has_session = F.col("session_id").isNotNull()
    per_visitor = per_session.groupBy(*MART_KEYS, "visitor_id").agg(
        F.count("session_id").alias("sessions"), F.sum(F.when(has_session, F.col("f"))).alias("f_sessions"),
        F.sum(F.when(has_session, F.col("l"))).alias("l_sessions"), F.sum("f").alias("f"), F.sum("l").alias("l"),
        F.sum("rows").alias("rows"), F.sum("seq").alias("seq"), *shared)
    h, pairs = flag(F.col("k") > 0), F.greatest("k", long_lit(1))
    per_visitor = per_visitor.withColumns({
        "h": h, "f_conv": F.when(F.col("f") > 0, h).otherwise(long_lit(0)), "l_conv": F.when(F.col("l") > 0, h).otherwise(long_lit(0)),
        "first_micros": F.col("r") * F.col("f") * h, "last_micros": F.col("r") * F.col("l") * h,
        # linear credit R/n in whole nano-dollars, rounded half up, for exact sums
        "linear_nanos": F.when(F.col("k") > 0, _product(share_of(F.col("r"), F.col("n"), 1000), F.col("rows"), 13)).otherwise(exact(F.lit(0))),
        "w": _product(F.col("rows"), pairs), "seq_w": _product(F.col("seq"), pairs),
        "n_w": _product(_product(F.col("rows"), F.col("n"), 12), pairs, 12)})
    sums = ["first_micros", "last_micros", "linear_nanos", "w", "seq_w", "n_w"]
    has_visitor = F.col("visitor_id").isNotNull()
    g = per_visitor.groupBy(*MART_KEYS).agg(
        F.sum("sessions").alias("total_sessions"), F.count("visitor_id").alias("total_visitors"),
        F.coalesce(F.sum("f_sessions"), long_lit(0)).alias("first_touch_sessions"),
        F.coalesce(F.sum(F.when(has_visitor, F.col("f_conv"))), long_lit(0)).alias("first_touch_conversions"),
        F.coalesce(F.sum("l_sessions"), long_lit(0)).alias("last_touch_sessions"),
        F.coalesce(F.sum(F.when(has_visitor, F.col("l_conv"))), long_lit(0)).alias("last_touch_conversions"),
        F.coalesce(F.sum(F.when(has_visitor, F.col("h"))), long_lit(0)).alias("linear_conversions"),
        *[F.sum(s).alias(s) for s in sums])

    first, last = usd_from_micros("first_micros"), usd_from_micros("last_micros")
    linear = usd_from_nanos("linear_nanos")
    avg_visits = safe_div("n_w", "w")
    role = (F.when(first > last * ROLE_RATIO, "Initiator")
            .when(last > first * ROLE_RATIO, "Closer")
            .when(F.try_divide(F.abs(first - last), F.nullif(first, F.lit(0.0))) < BALANCED_SPREAD, "Balanced")
            .otherwise("Mixed"))
    journey = F.when(F.lit(False), F.lit(None).cast("string"))
    for upper, label in JOURNEY_BANDS:
        journey = journey.when(avg_visits <= upper, label)
    journey = journey.otherwise(LONG_JOURNEY)
    return g.select(
        *MART_KEYS,
        campaign_identifier().alias("campaign_identifier"),
        channel_grouping(full=False).alias("channel_grouping"),
        role.alias("channel_role"), journey.alias("journey_complexity"),
        "total_sessions", "total_visitors",
        round_to(avg_visits, 2).alias("avg_sessions_per_visitor"),
        round_to(safe_div("seq_w", "w"), 2).alias("avg_session_position_in_journey"),
        "first_touch_sessions", "first_touch_conversions",
        round_to(first, 2).alias("first_touch_revenue"),
        round_to(F.try_divide(first, F.col("first_touch_sessions").cast("double")), 2)
        .alias("first_touch_revenue_per_session"),
        "last_touch_sessions", "last_touch_conversions",
        round_to(last, 2).alias("last_touch_revenue"),
        round_to(F.try_divide(last, F.col("last_touch_sessions").cast("double")), 2)
        .alias("last_touch_revenue_per_session"),
        "linear_conversions",
        round_to(linear, 2).alias("linear_attribution_revenue"),
        round_to(F.try_divide(linear, F.col("total_sessions").cast("double")), 2).alias("linear_revenue_per_session"),
        round_to(first - last, 2).alias("first_vs_last_revenue_diff"),
        round_to(F.try_divide(first - last, first) * 100, 2).alias("first_vs_last_pct_diff"),
    )
