"""Per-session funnel classification expressions (rules C10-C14)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col, flag

# Exit-stage labels, in rule order.
EXIT_STAGES = ["bounced_at_landing", "dropped_after_landing", "dropped_at_engagement",
               "dropped_at_deep_engagement", "converted", "other"]
DEEP_ENGAGEMENT_MIN_PAGEVIEWS = 3
DEEP_ENGAGEMENT_MIN_SECONDS = 60  # strictly more than this


def reached_engagement(bounced="is_bounced", pageviews="pageviews") -> Column:
    return flag((col(bounced) == 0) & (col(pageviews) > 1))


def reached_deep_engagement(bounced="is_bounced", pageviews="pageviews", time="time_on_site_seconds") -> Column:
    return flag((col(bounced) == 0) & (col(pageviews) >= DEEP_ENGAGEMENT_MIN_PAGEVIEWS)
                & (F.coalesce(col(time), F.lit(0)) > DEEP_ENGAGEMENT_MIN_SECONDS))


def reached_conversion(converted="is_converted") -> Column:
    return flag(col(converted) == 1)


def funnel_exit_stage(bounced="is_bounced", pageviews="pageviews", converted="is_converted") -> Column:
    b, pv, c = col(bounced), col(pageviews), col(converted)
    return (F.when(b == 1, EXIT_STAGES[0])
            .when(pv <= 1, EXIT_STAGES[1])
            .when((pv >= 2) & (pv < 3), EXIT_STAGES[2])
            .when((pv >= 3) & (c == 0), EXIT_STAGES[3])
            .when(c == 1, EXIT_STAGES[4])
            .otherwise(EXIT_STAGES[5]))


def engagement_score_tenths(pageviews="pageviews", time="time_on_site_seconds") -> Column:
    """Engagement score times ten, as an exact bigint: LEAST(1000, pv*100 + time).

    NULL when pageviews is NULL (the warehouse LEAST returns NULL on a NULL input).
    """
    pv = col(pageviews)
    raw = F.least(F.lit(1000).cast("bigint"), pv * 100 + F.coalesce(col(time), F.lit(0)))
    return F.when(pv.isNull(), F.lit(None).cast("bigint")).otherwise(raw)


def engagement_score(pageviews="pageviews", time="time_on_site_seconds") -> Column:
    """LEAST(100, pageviews*10 + COALESCE(time, 0)/10), NULL when pageviews is NULL."""
    return engagement_score_tenths(pageviews, time).cast("double") / F.lit(10.0)
