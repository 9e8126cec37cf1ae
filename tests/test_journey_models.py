"""Position-based and time-decay attribution credit every converting dollar exactly once."""

import pytest
from pyspark.sql import functions as F

from journeyline.operators import journey_models as jm


@pytest.mark.parametrize("fn,col", [(jm.u_shaped_attribution, "u_shaped_revenue"),
                                    (jm.w_shaped_attribution, "w_shaped_revenue"),
                                    (jm.time_decay_attribution, "time_decay_revenue")])
def test_models_conserve_converting_revenue(hand_stg, fn, col):
    df = fn(hand_stg)
    assert df.agg(F.sum(col)).first()[0] == pytest.approx(260, abs=0.05)


def test_u_shape_weights(hand_stg):
    rows = {(r["traffic_source"], r["traffic_medium"]): r["u_shaped_revenue"]
            for r in jm.u_shaped_attribution(hand_stg).collect()}
    # visitor B: 3 sessions, $100 converted -> 40 / 20 / 40
    assert rows[("google", "cpc")] == 40.0 and rows[("(direct)", "(none)")] == 20.0
    # visitor G: 2 sessions, $120 -> 60 / 60
    assert rows[("facebook.com", "cpc")] == 60.0 and rows[("bing", "organic")] == 60.0


def test_trend_calendar_is_complete(hand_stg):
    t = jm.daily_trend(hand_stg)
    span = hand_stg.agg(F.datediff(F.max("session_date"), F.min("session_date"))).first()[0]
    assert t.count() == span + 1
    assert t.agg(F.sum("sessions")).first()[0] == 14


def test_kmeans_segments_cover_every_visitor(spark):
    from conftest import SF_SMALL
    from journeyline.plans.queries import staged
    stg = staged(spark, SF_SMALL)
    seg = jm.kmeans_segments(stg, k=3)
    assert seg.count() <= 3
    assert seg.agg(F.sum("visitors")).first()[0] == stg.select("visitor_id").distinct().count()


def test_kmeans_assigns_every_visitor_to_the_nearest_centre_that_is_a_mean(spark):
    """Lloyd's algorithm in plain Python on the same features gives the same segments."""
    from conftest import SF_SMALL
    from journeyline.plans.queries import staged
    stg = staged(spark, SF_SMALL)
    rows = [tuple(r) for r in jm.visitor_features(stg).collect()]
    most = [max(max(r[i] for r in rows), 1) for i in range(1, 6)]
    z = {r[0]: [x * jm.SEGMENT_SCALE // m for x, m in zip(r[1:], most)] for r in rows}

    def dist(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def mean(points):
        return [sum(c) // len(points) for c in zip(*points)]

    centres = [mean(list(z.values()))]
    while len(centres) < 3:
        centres.append(z[min(z, key=lambda v: (-min(dist(z[v], c) for c in centres), v))])
    for _ in range(10):
        members = [[] for _ in centres]
        for p in z.values():
            members[min(range(3), key=lambda j: (dist(p, centres[j]), j))].append(p)
        centres = [mean(m) if m else c for m, c in zip(members, centres)]
    final = [min(range(3), key=lambda j: (dist(z[r[0]], centres[j]), j)) for r in rows]
    got = {r["segment"]: (r["visitors"], r["avg_sessions"], r["avg_revenue"]) for r in jm.kmeans_segments(stg, k=3).collect()}
    for j, (n, sessions, revenue) in got.items():
        own = [r for r, f in zip(rows, final) if f == j]
        assert n == len(own) and sessions == pytest.approx(sum(r[1] for r in own) / n, abs=1e-4)
        assert revenue == pytest.approx(sum(r[4] for r in own) / n / 1e6, abs=1e-4)
    assert sum(n for n, *_ in got.values()) == len(rows)
    assert jm.kmeans_segments(stg.where("1 = 0")).count() == 0


JOURNEYS = [  # visitor, hour, converted, revenue, source: conversions close journeys, sessions after the last one assist nothing
    ("A", 0, 0, 0, "s1"), ("A", 30, 1, 100, "s2"), ("A", 200, 0, 0, "s1"), ("A", 201, 0, 0, "s1"), ("A", 600, 1, 50, "s1"), ("A", 700, 0, 0, "s3"),
    ("B", 5, 1, 10, "s1"), ("B", 6, 1, 20, "s2"), ("C", 1, 0, 0, "s2"), (None, 1, 0, 0, "s2"), (None, 9, 1, 70, "s1")]


@pytest.fixture(scope="module")
def journeys(spark):
    from conftest import hand_rows
    from journeyline.operators.staging import stg_sessions
    from journeyline.schemas import RAW_SESSIONS
    import datetime as dt
    rows = []
    for n, (visitor, hour, converted, usd, source) in enumerate(JOURNEYS):
        start = 1498867200 + hour * 3600
        day = dt.datetime.fromtimestamp(start, dt.timezone.utc).strftime("%Y%m%d")
        medium = {"s1": "organic", "s2": "cpc", "s3": "referral"}[source]
        rows.append((visitor, n, start, (1, 3, 3, 70, None, converted, usd * 10 ** 6), (source, medium, "(not set)", None, None),
                     ("browser", "desktop", "os"), ("Canada", None), day))
    return stg_sessions(spark.createDataFrame(rows, RAW_SESSIONS)).cache()


def test_assists_follow_the_journey(journeys):
    from journeyline.operators import metrics
    got = {r["channel_grouping"]: tuple(r)[1:] for r in metrics.journey_assists(journeys).collect()}
    # A's first conversion (s2) is assisted by s1, the second (s1) by two sessions of s1; s3 comes after both; B's close themselves
    assert got == {"Organic Search": (2, 3, 2, 1.0), "Paid Search": (0, 0, 2, 0.0)}


def test_time_decay_equals_the_pairs(journeys):
    credit = {}
    for visitor in ("A", "B"):
        own = [j for j in JOURNEYS if j[0] == visitor]
        for c in (j for j in own if j[2]):
            weights = [(s, 2 ** (-(c[1] // 24 - s[1] // 24) / 7)) for s in own if s[1] <= c[1]]
            for s, w in weights:
                credit[s[4]] = credit.get(s[4], 0) + c[3] * w / sum(x for _, x in weights)
    got = {r["traffic_source"]: r["time_decay_revenue"] for r in jm.time_decay_attribution(journeys).collect()}
    assert got == {"s1": round(credit["s1"], 2), "s2": round(credit["s2"], 2), "s3": 0.0}
