"""Physical plans: pruning reaches the scan, no Expand for distinct counts, one exchange for W1+W2."""

import os
import tempfile

from journeyline.operators import attribution, campaign, funnel
from journeyline.operators.per_key import sequence_within
from journeyline.sources.raw_sessions import read_sessions, write_sessions
from journeyline.operators.staging import stg_sessions


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shard_range_prunes_partitions_and_nested_columns(spark, hand_raw):
    path = os.path.join(tempfile.mkdtemp(prefix="jl-raw-", dir="/tmp"), "sessions")
    write_sessions(hand_raw, path)
    df = read_sessions(spark, path, "20170701", "20170731")
    assert df.count() == 14
    plan = df.select("totals.hits")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "20170701" in plan
    assert "ReadSchema: struct<totals:struct<hits:bigint>>" in plan
    assert stg_sessions(df).count() == 14


def test_marts_use_no_expand(hand_stg):
    for df in [campaign.mart_campaign_performance(hand_stg), attribution.mart_attribution_analysis(hand_stg),
               funnel.mart_conversion_funnel(hand_stg)]:
        assert "Expand" not in _plan(df)


def test_sessions_are_dealt_by_visitor_and_hour_once(hand_raw):
    """The sessions cross the network once, by visitor and hour, and the join keeps that order; the other exchanges
    carry one row for each visitor and hour: their counts, their running sums, and these on their way back."""
    stg = stg_sessions(hand_raw.repartition(4))  # not cached: a cached table of one partition needs fewer exchanges
    plan = _plan(sequence_within(stg, "visitor_id", "session_start_timestamp", ["session_id"]))
    dealt = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert len(dealt) == 4 and sum("_bucket" in d for d in dealt) == 3
    assert "Broadcast" not in plan
