"""Channel grouping and campaign identifier expressions (rules C1-C3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col

# Fixed values that must equal the reference's rules.
SOCIAL_SOURCES = ["youtube.com", "facebook.com", "twitter.com"]
NOT_SET = "(not set)"
CHANNELS = ["Organic Search", "Paid Search", "Direct", "Referral", "Social", "Email", "Display", "Other"]


def channel_grouping(source="traffic_source", medium="traffic_medium", full: bool = True) -> Column:
    """First matching rule wins.

    ``full=True`` is the campaign-mart variant with the ``email`` and ``social``
    medium branches; ``full=False`` is the attribution/funnel variant without them.
    """
    s, m = col(source), col(medium)
    rule = (F.when(m == "organic", "Organic Search")
            .when(m == "cpc", "Paid Search")
            .when(m == "referral", "Referral")
            .when((m == "(none)") & (s == "(direct)"), "Direct"))
    if full:
        rule = rule.when(m == "email", "Email").when(m == "social", "Social")
    return rule.when(s.isin(SOCIAL_SOURCES), "Social").otherwise("Other")


def campaign_identifier(source="traffic_source", medium="traffic_medium", campaign="campaign_name") -> Column:
    """``source / medium`` plus `` / campaign`` unless the campaign is NULL or '(not set)'.

    NULL when source or medium is NULL (CONCAT propagates NULL).
    """
    c = col(campaign)
    suffix = F.when(c.isNotNull() & (c != NOT_SET), F.concat(F.lit(" / "), c)).otherwise(F.lit(""))
    return F.concat(col(source), F.lit(" / "), col(medium), suffix)


def coalesce_campaign(campaign="campaign_name") -> Column:
    return F.coalesce(col(campaign), F.lit(NOT_SET))
