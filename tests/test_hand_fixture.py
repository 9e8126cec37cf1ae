"""The 15-session hand fixture: every exit stage, channel rule, NULL case, tie and shard edge."""

import pytest
from pyspark.sql import functions as F

from conftest import HAND, session_of
from journeyline.operators import attribution, campaign, funnel

# row -> (bounced, converted, engaged, deep, exit stage, score, seq, total)
EXPECTED = {
    "h01": (1, 0, 0, 0, "bounced_at_landing", 10.0, 1, 1),
    "h02": (0, 0, 1, 0, "dropped_at_engagement", 23.0, 1, 3),
    "h03": (0, 1, 1, 1, "converted", 56.1, 2, 3),
    "h04": (0, 0, 1, 0, "dropped_at_deep_engagement", 36.0, 3, 3),
    "h05": (0, 1, 0, 0, "converted", None, 1, 1),
    "h06": (0, 0, 0, 0, "other", None, 1, 1),
    "h07": (1, 1, 0, 0, "bounced_at_landing", 10.0, 1, 1),
    "h08": (0, 0, 0, 0, "dropped_after_landing", 10.5, 1, 2),
    "h09": (0, 1, 1, 0, "dropped_at_engagement", 21.5, 2, 2),
    "h10": (0, 1, 1, 1, "converted", 100.0, 1, 2),
    "h11": (0, 1, 1, 1, "converted", 36.1, 2, 2),
    "h12": (0, 0, 0, 0, "dropped_after_landing", 10.4, 1, 1),
    "h14": (0, 0, 1, 1, "dropped_at_deep_engagement", 50.0, 1, 1),
    "h15": (0, 0, 1, 0, "dropped_at_engagement", 29.0, 1, 1),
}


def test_shard_range_keeps_14_sessions(hand_stg):
    assert hand_stg.count() == 14
    assert hand_stg.where(F.col("visitor_id") == "I").count() == 0  # 2017-08-01 is outside
    assert hand_stg.where(F.col("visitor_id") == "J").count() == 1  # 2017-07-31 is inside


def test_session_level_rules(hand_stg):
    steps = funnel.int_funnel_steps(hand_stg).collect()
    seq = attribution.sequenced_sessions(hand_stg).collect()
    for row in HAND:
        name, visitor, visit = row[0], row[1], row[2]
        if name == "h13":
            continue
        s = session_of(visitor, visit, steps)
        q = session_of(visitor, visit, seq)
        got = (s["is_bounced"], s["is_converted"], s["reached_engagement"], s["reached_deep_engagement"],
               s["funnel_exit_stage"], s["engagement_score"], q["session_sequence"], q["total_sessions_per_visitor"])
        assert got == EXPECTED[name], name


def test_attribution_mart_rows(hand_stg):
    rows = {(r["traffic_source"], r["traffic_medium"], r["campaign_name"]): r
            for r in attribution.mart_attribution_analysis(hand_stg).collect()}
    assert len(rows) == 13
    expect = {
        ("google", "cpc", "Brand"): (100.0, 0.0, 33.33, 1.0, 3.0, "Initiator", "Medium journey"),
        ("(direct)", "(none)", "(not set)"): (0.0, 0.0, 33.33, 2.0, 3.0, "Mixed", "Medium journey"),
        ("google", "organic", None): (0.0, 100.0, 33.33, 2.0, 2.0, "Closer", "Short journey"),
        ("facebook.com", "cpc", "Retarget"): (120.0, 0.0, 60.0, 1.0, 2.0, "Initiator", "Short journey"),
        ("bing", "organic", "(not set)"): (0.0, 120.0, 60.0, 2.0, 2.0, "Closer", "Short journey"),
        ("newsletter", "email", "Weekly"): (30.0, 30.0, 30.0, 1.0, 1.0, "Balanced", "Single-touch"),
        ("facebook.com", "(not set)", "(not set)"): (10.0, 10.0, 10.0, 1.0, 1.0, "Balanced", "Single-touch"),
        ("youtube.com", "referral", "(not set)"): (0.0, 0.0, 0.0, 1.0, 2.0, "Mixed", "Short journey"),
        ("twitter.com", "(none)", "(not set)"): (0.0, 0.0, 0.0, 2.0, 2.0, "Mixed", "Short journey"),
    }
    for key, want in expect.items():
        r = rows[key]
        got = (r["first_touch_revenue"], r["last_touch_revenue"], r["linear_attribution_revenue"],
               r["avg_session_position_in_journey"], r["avg_sessions_per_visitor"], r["channel_role"],
               r["journey_complexity"])
        assert got == want, key
    for key in [("community", "social", "(not set)"), ("dfa", "cpm", "Display"),
                ("google", "organic", "(not set)"), ("(direct)", "(not set)", "(not set)")]:
        r = rows[key]
        assert (r["channel_role"], r["journey_complexity"], r["linear_attribution_revenue"]) == \
            ("Mixed", "Single-touch", 0.0)


def test_attribution_conserves_revenue_and_fanout(hand_stg):
    per_session = attribution.int_session_attribution(hand_stg)
    t = per_session.agg(F.sum("attribution_rows").alias("pairs"), F.sum("first_touch_revenue").alias("f"),
                        F.sum("last_touch_revenue").alias("l"),
                        F.sum("linear_attribution_revenue").alias("lin")).first()
    assert t["pairs"] == 16  # rows of the reference's session x conversion join
    assert t["f"] == pytest.approx(260) and t["l"] == pytest.approx(260) and t["lin"] == pytest.approx(260)


def test_campaign_and_funnel_marts(hand_stg):
    daily = campaign.int_campaign_metrics(hand_stg)
    mart = campaign.mart_campaign_performance(hand_stg)
    fmart = funnel.mart_conversion_funnel(hand_stg)
    assert daily.count() == 13 and mart.count() == 13 and fmart.count() == 13
    assert mart.agg(F.sum("total_revenue")).first()[0] == pytest.approx(265)
    assert fmart.agg(F.sum("total_revenue")).first()[0] == pytest.approx(260)
    # NULL campaign merges with '(not set)' before grouping (h01 + h12)
    g = mart.where((F.col("traffic_source") == "google") & (F.col("traffic_medium") == "organic")
                   & (F.col("device_category") == "desktop")).collect()
    assert len(g) == 1 and g[0]["campaign_name"] == "(not set)" and g[0]["total_sessions"] == 2
    # channel rules: facebook/cpc is Paid Search; social medium is Social (full) but Other (short)
    ch = {(r["traffic_source"], r["traffic_medium"]): r["channel_grouping"] for r in mart.collect()}
    assert ch[("facebook.com", "cpc")] == "Paid Search"
    assert ch[("community", "social")] == "Social"
    assert ch[("(direct)", "(not set)")] == "Other"
    fch = {(r["traffic_source"], r["traffic_medium"]): r["channel_grouping"] for r in fmart.collect()}
    assert fch[("community", "social")] == "Other"
    assert fch[("newsletter", "email")] == "Other"


def test_staged_schema_is_the_declared_one(hand_stg):
    from journeyline.schemas import STG_SESSIONS
    assert [(f.name, f.dataType) for f in hand_stg.schema.fields] == \
        [(f.name, f.dataType) for f in STG_SESSIONS.fields]
