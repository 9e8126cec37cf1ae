"""Dashboard queries on the hand fixture: totals, ratio-of-sums rate, shares and filters."""

import pytest
from pyspark.sql import functions as F

from journeyline.operators import attribution, campaign, dashboard, funnel


def test_attribution_totals_are_equal(hand_stg):
    t = dashboard.attribution_totals(attribution.mart_attribution_analysis(hand_stg)).first()
    assert t["first_touch_revenue"] == t["last_touch_revenue"] == pytest.approx(260.0, abs=0.02)
    assert t["linear_attribution_revenue"] == pytest.approx(260.0, abs=0.02)


def test_funnel_overall_rate_is_ratio_of_sums(hand_stg):
    t = dashboard.funnel_totals(funnel.mart_conversion_funnel(hand_stg)).first()
    assert t["sessions_landing"] == 14 and t["sessions_conversion"] == 6
    assert t["overall_conversion_rate_pct"] == round(6 / 14 * 100, 2)


def test_shares_sum_to_100_and_filters_apply(hand_stg):
    mart = campaign.mart_campaign_performance(hand_stg)
    share = dashboard.device_share(mart)
    assert share.agg(F.sum("share_of_sessions_pct")).first()[0] == pytest.approx(100, abs=0.02)
    only_desktop = dashboard.campaign_kpis(mart, {"device_category": "desktop"}).first()
    assert only_desktop["total_sessions"] == hand_stg.where("device_category = 'desktop'").count()
    two = dashboard.campaign_kpis(mart, {"channel_grouping": ["Direct", "Paid Search"]}).first()
    assert two["total_sessions"] == 3  # Direct: h03; Paid Search: h02, h10 (h15 is Other)
