"""Incremental refresh: the streamed daily table and mart equal the batch models, and readers only ever see whole snapshots."""

import os
import tempfile

import pytest

from conftest import hand_rows
from journeyline.operators.campaign import int_campaign_metrics, mart_campaign_performance, MART_CAMPAIGN_COLUMNS
from journeyline.operators.staging import stg_sessions
from journeyline.schemas import RAW_SESSIONS
from journeyline.sources.raw_sessions import read_sessions, write_sessions
from journeyline.streaming import incremental
from journeyline.streaming.incremental import daily_table, drop_old, manifest, manifests, mart_table, refresh_days, start_campaign_refresh

ROWS = hand_rows()
FIRST, LATER = [r for r in ROWS if r[-1] < "20170710"], [r for r in ROWS if r[-1] >= "20170710"]


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _write(spark, rows, path):
    write_sessions(spark.createDataFrame(rows, RAW_SESSIONS), path, mode="append")


@pytest.fixture()
def paths():
    root = tempfile.mkdtemp(prefix="jl-stream-", dir="/tmp")
    return os.path.join(root, "raw"), os.path.join(root, "out")


def _is_snapshot_of(spark, out, raw, version=None):
    """The daily table and the mart of a version are those of all sessions in ``raw``."""
    stg = stg_sessions(raw)
    return (_same(daily_table(spark, out, version), int_campaign_metrics(stg))
            and _same(mart_table(spark, out, version).select(*MART_CAMPAIGN_COLUMNS), mart_campaign_performance(stg).select(*MART_CAMPAIGN_COLUMNS)))


def test_campaign_refresh_matches_batch(spark, paths):
    raw, out = paths
    _write(spark, FIRST, raw)
    start_campaign_refresh(spark, raw, out, available_now=True).awaitTermination()
    assert _is_snapshot_of(spark, out, read_sessions(spark, raw))
    _write(spark, LATER, raw)
    start_campaign_refresh(spark, raw, out, available_now=True).awaitTermination()
    assert manifests(spark, out) == [1, 2]
    assert _is_snapshot_of(spark, out, read_sessions(spark, raw, "00000000", "99999999"))
    assert daily_table(spark, out).where("session_date = DATE'2017-08-01'").count() > 0  # no day is held back
    assert _is_snapshot_of(spark, out, spark.createDataFrame(FIRST, RAW_SESSIONS), 1)  # the snapshot before still reads as it was


@pytest.mark.parametrize("step", ["daily", "mart", "manifest"])
def test_a_refresh_that_dies_leaves_the_snapshot_before(spark, paths, monkeypatch, step):
    raw, out = paths
    _write(spark, FIRST, raw)
    days = sorted({r[-1] for r in FIRST})
    assert refresh_days(spark, raw, out, days, stream="s", epoch=0) == 1
    late = sorted({r[-1] for r in LATER}) + [days[0]]
    _write(spark, LATER + [FIRST[0]], raw)  # a day that the first snapshot holds changes too

    class Killed(Exception):
        pass

    def die(*_, **__):
        raise Killed

    target = {"daily": "_daily", "mart": "mart_from_daily", "manifest": "_publish"}[step]  # what runs just after the days, ... are written
    with monkeypatch.context() as m:
        m.setattr(incremental, target, die)
        with pytest.raises(Killed):
            refresh_days(spark, raw, out, late, stream="s", epoch=1)
    assert manifests(spark, out) == [1]
    assert _is_snapshot_of(spark, out, spark.createDataFrame(FIRST, RAW_SESSIONS))
    assert refresh_days(spark, raw, out, late, stream="s", epoch=1) == 2  # Spark repeats the epoch
    assert _is_snapshot_of(spark, out, read_sessions(spark, raw, "00000000", "99999999"))
    assert refresh_days(spark, raw, out, late, stream="s", epoch=1) is None  # and again: nothing to do
    assert manifests(spark, out) == [1, 2] and manifest(spark, out)["epochs"] == {"s": 1}


def test_a_version_is_published_once(spark, paths):
    raw, out = paths
    _write(spark, FIRST, raw)
    refresh_days(spark, raw, out, ["20170701"])
    with pytest.raises(RuntimeError):
        incremental._publish(spark, out, {"version": 1, "days": {}, "epochs": {}})
    assert manifest(spark, out)["days"] == {"2017-07-01": 1}


def test_old_snapshots_are_dropped(spark, paths):
    raw, out = paths
    _write(spark, ROWS, raw)
    days = sorted({r[-1] for r in ROWS})
    for part in (days, days[:3], days[2:4], days[:1]):
        refresh_days(spark, raw, out, part)
    assert drop_old(spark, out, keep=1) == [1, 2, 3]
    assert manifests(spark, out) == [4]
    assert _is_snapshot_of(spark, out, read_sessions(spark, raw, "00000000", "99999999"))  # days of older versions are kept
    assert not os.path.exists(f"{out}/campaign_daily/version=2/session_date=2017-07-01")


def test_no_snapshot_yet(spark, paths):
    assert manifest(spark, paths[1]) is None
    with pytest.raises(FileNotFoundError):
        daily_table(spark, paths[1])
    assert refresh_days(spark, paths[0], paths[1], []) is None
