"""The bucket-based sessionization equals a brute-force sort-and-scan on a small table."""

import numpy as np
import pandas as pd

from conftest import SF_SMALL
from journeyline import sinks
from journeyline.sources.events_adapter import sessions_from_events


def brute_force_sessions():
    ev = pd.read_parquet(f"{SF_SMALL}/events.parquet")
    es = ev["ts"].astype("datetime64[us]").astype("int64") // 1_000_000
    user = ev["user_id"]
    period = (es // 86400) // (1 + user % 6)
    ev["visitor"] = np.where(user % 10 == 9, user.astype(str) + ".e" + ev["event_id"].astype(str),
                             user.astype(str) + "." + period.astype(str))
    ev["es"] = es
    ev = ev.sort_values(["visitor", "ts", "event_id"])
    gap = ev.groupby("visitor")["es"].diff()
    ev["sn"] = (gap.isna() | (gap > 28800)).astype(int).groupby(ev["visitor"]).cumsum()
    purchase = (ev["event_type"] == "purchase") & (ev["value"] >= 60)
    ev["pv"] = ev["event_type"].isin(["view", "click"]).astype(int)
    ev["txn"] = purchase.astype(int)
    ev["rev"] = np.where(purchase, np.round(ev["value"] * 100).astype("int64") * 10000, 0)
    g = ev.groupby(["visitor", "sn"]).agg(start=("es", "min"), end=("es", "max"), hits=("es", "size"),
                                          pv=("pv", "sum"), txn=("txn", "sum"), rev=("rev", "sum"))
    out = set()
    for (visitor, _), r in g.iterrows():
        def nz(x):
            return None if x == 0 else int(x)
        out.add((visitor, int(r["start"]), int(r["hits"]), nz(r["pv"]), nz(r["end"] - r["start"]), nz(r["txn"]),
                 nz(r["rev"])))
    return out


def test_adapter_matches_brute_force(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    got = {(r["fullVisitorId"], r["visitStartTime"], r["totals"]["hits"], r["totals"]["pageviews"],
            r["totals"]["timeOnSite"], r["totals"]["transactions"], r["totals"]["transactionRevenue"])
           for r in sessions_from_events(events, nation).collect()}
    want = brute_force_sessions()
    assert len(want) == 552  # the profile in FIXTURES.md
    assert got == want


def test_display_order(hand_stg):
    from journeyline.operators.campaign import mart_campaign_performance
    rows = sinks.for_display(mart_campaign_performance(hand_stg), "mart_campaign_performance").collect()
    revenue = [r["total_revenue"] for r in rows]
    assert revenue == sorted(revenue, reverse=True)
