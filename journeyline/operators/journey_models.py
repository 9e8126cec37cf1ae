"""Roadmap models with a definite formula: position-based and time-decay attribution (R1-R3),
cohort retention (R4), daily trend (R5), RFM segments (R6) and days to conversion (R7).

Position-based credit is a fixed share of the visitor's converting revenue R per session
position, computed in whole nano-dollars (R in micros x 1000, rounded half up) as decimals so sums
are exact. Time-decay credits are rounded to decimals before they are summed. Per-visitor figures come from the session sequence and totals of operators/per_key.py.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.channels import campaign_identifier, channel_grouping
from ..functions.numeric import exact, idiv, long_lit, round_to, safe_div, share_of, share_pct, usd_from_micros, usd_from_nanos
from .attribution import MART_KEYS, sequenced_sessions
from .per_key import ntiles, running_within, totals_within

# Position shares (percent) and the time-decay half-life in days.
U_SHAPE = (40, 20, 40)          # first, all middle sessions together, last
W_SHAPE = (30, 30, 30, 10)      # first, middle (position ceil(n/2)), last, all others together
HALF_LIFE_DAYS = 7.0


def _share_nanos(r: Column, percent: int, parts) -> Column:
    """round_half_up(R_micros * 1000 * percent/100 / parts) as DECIMAL(38,0) nano-dollars."""
    return share_of(r, parts, 10 * percent)


def _u_shaped(r, seq, n) -> Column:
    first, middle, last = U_SHAPE
    return (F.when(n == 1, _share_nanos(r, 100, 1))
            .when(n == 2, _share_nanos(r, 50, 1))
            .when(seq == 1, _share_nanos(r, first, 1))
            .when(seq == n, _share_nanos(r, last, 1))
            .otherwise(_share_nanos(r, middle, n - 2)))


def _w_shaped(r, seq, n) -> Column:
    first, middle, last, others = W_SHAPE
    mid = idiv(n + 1, 2)
    return (F.when(n == 1, _share_nanos(r, 100, 1))
            .when(n == 2, _share_nanos(r, 50, 1))
            .when(n == 3, _share_nanos(r, 100, 3))
            .when(seq == 1, _share_nanos(r, first, 1))
            .when(seq == n, _share_nanos(r, last, 1))
            .when(seq == mid, _share_nanos(r, middle, 1))
            .otherwise(_share_nanos(r, others, n - 3)))


def _by_campaign(df: DataFrame, nanos: Column, name: str) -> DataFrame:
    g = df.select(*MART_KEYS, nanos.alias("_nanos")).groupBy(*MART_KEYS).agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("_nanos").alias("_nanos"))
    return g.select(*MART_KEYS, campaign_identifier().alias("campaign_identifier"),
                    channel_grouping(full=False).alias("channel_grouping"), "sessions",
                    round_to(usd_from_nanos("_nanos"), 2).alias(name))


def u_shaped_attribution(stg: DataFrame) -> DataFrame:
    """40 % first touch, 40 % last touch, 20 % spread over the sessions between
    (one session: 100 %, two sessions: 50 / 50)."""
    s = sequenced_sessions(stg)
    r, seq, n = F.col("conversion_micros"), F.col("session_sequence"), F.col("total_sessions_per_visitor")
    return _by_campaign(s, F.when(F.col("visitor_conversions") > 0, _u_shaped(r, seq, n)).otherwise(exact(F.lit(0))),
                        "u_shaped_revenue")


def w_shaped_attribution(stg: DataFrame) -> DataFrame:
    """R2: 30 % first, 30 % middle session (position ceil(n/2)), 30 % last, 10 % over the rest
    (one session: 100 %, two: 50 / 50, three: a third each)."""
    s = sequenced_sessions(stg)
    r, seq, n = F.col("conversion_micros"), F.col("session_sequence"), F.col("total_sessions_per_visitor")
    return _by_campaign(s, F.when(F.col("visitor_conversions") > 0, _w_shaped(r, seq, n)).otherwise(exact(F.lit(0))),
                        "w_shaped_revenue")


def time_decay_attribution(stg: DataFrame, half_life_days: float = HALF_LIFE_DAYS) -> DataFrame:
    """Each conversion credits the visitor's sessions up to it, in proportion to 2^(-days before the conversion / half-life).

    The pairs are not listed. With x = 2^(days since the visitor's first session / half-life), a conversion's weights sum to
    P / x, P being the running sum of x up to it, so a session's credit is its x times the sum of revenue / P over the
    conversions at or after it: two running sums. Sessions without a visitor or a start have no place in a journey and get
    no credit. A journey may span 1,000 half-lives (19 years
    of seven days) before x leaves the range of a double."""
    order = ("visitor_id", "session_start_timestamp", ["session_id"])
    s = sequenced_sessions(stg, keep=True)
    placed = F.col("visitor_id").isNotNull() & F.col("session_start_timestamp").isNotNull()
    x = F.when(placed, F.pow(F.lit(2.0), F.datediff("session_date", "visitor_first_date") / half_life_days))
    s = running_within(s.withColumn("_x", x), *order, {"_p": F.col("_x")}, keep=True)
    share = F.when((F.col("is_converted") == 1) & F.col("_x").isNotNull(), usd_from_micros("revenue_micros") / F.col("_p"))
    s = running_within(s, *order, {"_later": share}, reverse=True)
    credit = (F.coalesce("_x", F.lit(0.0)) * F.col("_later")).cast("decimal(28,9)")
    g = s.select(*MART_KEYS, credit.alias("_credit")).groupBy(*MART_KEYS).agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("_credit").alias("_credit"))
    return g.select(*MART_KEYS, campaign_identifier().alias("campaign_identifier"),
                    channel_grouping(full=False).alias("channel_grouping"), "sessions",
                    round_to(F.col("_credit").cast("double"), 2).alias("time_decay_revenue"))


def cohort_retention(stg: DataFrame) -> DataFrame:
    """Visitors by the week of their first session, active again 0, 1, 2 ... weeks later.
    Sessions without a visitor id belong to no cohort."""
    stg = stg.where(F.col("visitor_id").isNotNull())
    days = stg.groupBy("visitor_id", "session_date").agg(F.count(F.lit(1)).alias("_s"))
    s = totals_within(days, "visitor_id", F.col("session_date"), {"first_date": ("min", F.col("session_date"))})
    active = (s.select(F.trunc("first_date", "week").alias("cohort_week"),
                       idiv(F.datediff("session_date", "first_date"), 7).alias("weeks_since_first"), "visitor_id")
              .groupBy("cohort_week", "weeks_since_first", "visitor_id").agg(F.count(F.lit(1)).alias("_s")))
    g = active.groupBy("cohort_week", "weeks_since_first").agg(F.count("visitor_id").alias("visitors"))
    # cohort sizes: one row per cohort week (a handful of rows)
    size = F.max(F.when(F.col("weeks_since_first") == 0, F.col("visitors"))).over(Window.partitionBy("cohort_week"))
    return g.withColumn("cohort_size", size).withColumn(
        "retention_pct", round_to(safe_div("visitors", "cohort_size") * 100, 2))


def daily_trend(stg: DataFrame) -> DataFrame:
    """Sessions, conversions and revenue per day over a complete calendar, with the
    same weekday of the previous week and the week-over-week change in sessions."""
    micros = F.coalesce(F.col("transaction_revenue_micros"), long_lit(0))
    daily = stg.groupBy("session_date").agg(F.count(F.lit(1)).alias("sessions"),
                                            F.sum("is_converted").alias("conversions"), F.sum(micros).alias("_rev"))
    calendar = (stg.agg(F.min("session_date").alias("lo"), F.max("session_date").alias("hi"))
                .select(F.explode(F.sequence("lo", "hi")).alias("session_date")))
    # the calendar has one row per day of the range; the window below orders those days only
    by_day = Window.orderBy("session_date")
    t = (calendar.join(daily, "session_date", "left")
         .select("session_date", F.coalesce("sessions", long_lit(0)).alias("sessions"),
                 F.coalesce("conversions", long_lit(0)).alias("conversions"),
                 usd_from_micros(F.coalesce("_rev", long_lit(0))).alias("revenue")))
    prev = F.lag("sessions", 7).over(by_day)
    return t.withColumn("sessions_prev_week", prev).withColumn(
        "wow_sessions_change_pct",
        round_to(safe_div(F.col("sessions") - F.col("sessions_prev_week"), "sessions_prev_week") * 100, 2))


def days_to_conversion(stg: DataFrame) -> DataFrame:
    """Days from a converting visitor's first session to their first conversion."""
    v = stg.where(F.col("visitor_id").isNotNull()).groupBy("visitor_id").agg(
        F.min("session_date").alias("first_date"),
        F.min(F.when(F.col("is_converted") == 1, F.col("session_date"))).alias("first_conversion_date"))
    days = v.where(F.col("first_conversion_date").isNotNull()).select(
        F.datediff("first_conversion_date", "first_date").cast("bigint").alias("days_to_conversion"))
    g = days.groupBy("days_to_conversion").agg(F.count(F.lit(1)).alias("visitors"))
    return g.withColumn("share_of_converters_pct", share_pct("visitors"))


RFM_BUCKETS = 5


def rfm_segments(stg: DataFrame) -> DataFrame:
    """Recency / frequency / monetary scores 1-5 per visitor (NTILE, 5 = best), reported
    per score cell. The tiles are exact and ordered by the measure and then ``visitor_id``, so ties split the same way
    every run; ``per_key.ntiles`` finds all three at once without a window over all visitors."""
    micros = F.coalesce(F.col("transaction_revenue_micros"), long_lit(0))
    stg = stg.where(F.col("visitor_id").isNotNull())  # a NULL visitor is not a visitor
    per_session = stg.groupBy("visitor_id", "session_id").agg(F.max("session_date").alias("d"),
                                                              F.sum(micros).alias("_rev"))
    v = per_session.groupBy("visitor_id").agg(F.max("d").alias("last_date"), F.count(F.lit(1)).alias("frequency"),
                                              F.sum("_rev").alias("monetary_micros"))
    # fewer days since the last session are better: the order of recency, falling, is that of the last date
    scores = ntiles(v, "visitor_id", {"r_score": F.unix_date("last_date"), "f_score": F.col("frequency"),
                                      "m_score": F.col("monetary_micros")}, RFM_BUCKETS)
    g = v.join(scores, "visitor_id").groupBy("r_score", "f_score", "m_score").agg(
        F.count(F.lit(1)).alias("visitors"), F.sum("frequency").alias("sessions"),
        F.sum("monetary_micros").alias("_rev"))
    return g.select("r_score", "f_score", "m_score", "visitors", "sessions", usd_from_micros("_rev").alias("revenue"))


SEGMENT_FEATURES = ["sessions", "engaged_sessions", "conversions", "revenue_micros", "days_active"]
#: Features are scaled to whole numbers from 0 to this, so distances and centres are exact on every engine.
SEGMENT_SCALE = 10_000


def visitor_features(stg: DataFrame) -> DataFrame:
    """One row for each visitor: the features as integers."""
    from .funnel import funnel_sessions, visitor_totals

    return visitor_totals(funnel_sessions(stg.where(F.col("visitor_id").isNotNull()))).select(
        "visitor_id", F.col("total_sessions").alias("sessions"), F.col("reached_engagement").alias("engaged_sessions"),
        F.col("reached_conversion").alias("conversions"), F.col("_rev_micros").alias("revenue_micros"),
        F.datediff("last_session_date", "first_session_date").cast("bigint").alias("days_active"))


def _distance(scaled: list[str], centre: list[int]) -> Column:
    return sum((F.col(z) - long_lit(c)) * (F.col(z) - long_lit(c)) for z, c in zip(scaled, centre))


def _nearest(scaled: list[str], centres: list[list[int]]) -> Column:
    """The number of the nearest centre, the first on a tie."""
    return F.array_min(F.array(*[F.struct(_distance(scaled, c).alias("d"), long_lit(j).alias("j")) for j, c in enumerate(centres)]))["j"]


def kmeans_segments(stg: DataFrame, k: int = 4, max_iter: int = 10) -> DataFrame:
    """K-means visitor segments, one row for each: visitors and the mean of each feature.

    Lloyd's iterations as aggregations over the scaled features, which are stored once; only the k centres come to the driver. All
    steps are exact, so reruns and other engines agree: features are scaled to integers by their greatest value,
    a centre is its visitors' sum divided without rest, the start is the mean and then, each time, the visitor farthest
    from the centres so far (the first by id on a tie). A segment that loses all its visitors keeps its centre."""
    from ..session import checkpoint_dir

    spark = stg.sparkSession
    scaled = [f"z{i}" for i in range(len(SEGMENT_FEATURES))]
    path = f"{checkpoint_dir(spark).rstrip('/')}/journeyline/segments-{uuid.uuid4().hex}"
    visitor_features(stg).write.parquet(f"{path}/features")
    v = spark.read.parquet(f"{path}/features")
    most = v.agg(*[F.max(c) for c in SEGMENT_FEATURES]).first()
    if most[0] is not None:
        v = v.withColumns({z: idiv(F.col(c).cast("decimal(38,0)") * F.lit(SEGMENT_SCALE).cast("decimal(6,0)"), F.lit(max(m, 1)).cast("decimal(38,0)")).cast("bigint")
                           for z, c, m in zip(scaled, SEGMENT_FEATURES, most)})
        v.write.parquet(f"{path}/scaled")
        v = spark.read.parquet(f"{path}/scaled")
        means = [idiv(F.sum(z), F.count(F.lit(1))).alias(z) for z in scaled]
        centres = [list(v.agg(*means).first())]
        while len(centres) < k:
            far = F.least(*[_distance(scaled, c) for c in centres]) if len(centres) > 1 else _distance(scaled, centres[0])
            centres.append(list(v.orderBy(far.desc(), "visitor_id").select(*scaled).first()))
        for _ in range(max_iter):
            found = {r["j"]: [r[z] for z in scaled] for r in v.groupBy(_nearest(scaled, centres).alias("j")).agg(*means).collect()}  # k rows
            moved = [found.get(j, c) for j, c in enumerate(centres)]
            if moved == centres:
                break
            centres = moved
        v = v.withColumn("segment", _nearest(scaled, centres))
    else:
        v = v.withColumn("segment", long_lit(0))
    n = F.count(F.lit(1)).cast("double")
    return v.groupBy("segment").agg(
        F.count(F.lit(1)).alias("visitors"),
        *[round_to(F.sum(c).cast("double") / n, 4).alias(f"avg_{c}") for c in SEGMENT_FEATURES if c != "revenue_micros"],
        round_to(usd_from_micros(F.sum("revenue_micros")) / n, 4).alias("avg_revenue"))
