import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from journeyline.schemas import RAW_SESSIONS  # noqa: E402
from journeyline.session import checkpoint_dir, get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app_name="journeyline-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # tests set their own scratch folder only because none is configured
    yield s
    s.stop()


# Hand fixture: 15 raw sessions (row, visitor, visitId, start, source, medium, campaign,
# device, country, hits, pageviews, time, bounces, transactions, revenue micros).
HAND = [
    ("h01", "A", 101, 1498900000, "google", "organic", "(not set)", "desktop", "United States", 1, 1, None, 1, None, None),
    ("h02", "B", 201, 1498903600, "google", "cpc", "Brand", "desktop", "United States", 4, 2, 30, None, None, None),
    ("h03", "B", 202, 1498990000, "(direct)", "(none)", "(not set)", "desktop", "United States", 9, 5, 61, None, 1, 100000000),
    ("h04", "B", 203, 1499076400, "google", "organic", None, "mobile", "United States", 5, 3, 60, None, None, None),
    ("h05", "C", 301, 1499162800, "newsletter", "email", "Weekly", "desktop", "Canada", 2, None, 120, None, 1, 30000000),
    ("h06", "D", 401, 1499249200, "community", "social", "(not set)", "mobile", "Canada", 3, None, None, None, None, None),
    ("h07", "E", 501, 1499335600, "facebook.com", "(not set)", "(not set)", "tablet", "India", 1, 1, None, 1, 1, 10000000),
    ("h08", "F", 601, 1499422000, "youtube.com", "referral", "(not set)", "mobile", "India", 2, 1, 5, None, None, None),
    ("h09", "F", 602, 1499422000, "twitter.com", "(none)", "(not set)", "mobile", "India", 3, 2, 15, None, 2, None),
    ("h10", "G", 701, 1499508400, "facebook.com", "cpc", "Retarget", "desktop", "United States", 40, 20, 1000, None, 1, 50000000),
    ("h11", "G", 702, 1499594800, "bing", "organic", "(not set)", "desktop", "United States", 6, 3, 61, None, 1, 70000000),
    ("h12", "H", 801, 1498900500, "google", "organic", None, "desktop", "United States", 2, 1, 4, None, None, None),
    ("h13", "I", 901, 1501545600, "google", "organic", "(not set)", "desktop", "United States", 7, 6, 300, None, 1, 999000000),
    ("h14", "J", 111, 1501459200, "dfa", "cpm", "Display", "tablet", "Canada", 3, 3, 200, None, 0, 5000000),
    ("h15", "K", 121, 1499681200, "(direct)", "(not set)", "(not set)", "desktop", "Canada", 2, 2, 90, None, None, None),
]


def hand_rows():
    rows = []
    for (_, visitor, visit, start, src, med, camp, device, country, hits, pv, tos, bounces, txn, rev) in HAND:
        day = dt.datetime.fromtimestamp(start, dt.timezone.utc).strftime("%Y%m%d")
        rows.append((visitor, visit, start, (1, hits, pv, tos, bounces, txn, rev), (src, med, camp, None, None),
                     ("browser", device, "os"), (country, None), day))
    return rows


@pytest.fixture(scope="session")
def hand_raw(spark):
    return spark.createDataFrame(hand_rows(), RAW_SESSIONS)


@pytest.fixture(scope="session")
def hand_stg(spark, hand_raw):
    from journeyline.operators.staging import stg_sessions
    from journeyline.sources.raw_sessions import shard_range
    return stg_sessions(shard_range(hand_raw, "20170701", "20170731")).cache()


def session_of(visitor, visit, rows):
    prefix = f"{visitor}-{visit}-"
    return [r for r in rows if r["session_id"].startswith(prefix)][0]
