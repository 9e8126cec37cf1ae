"""Building the whole project writes staging, marts and the test report."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from journeyline import sinks
from journeyline.plans.project import build_project


def test_build_project_on_fixture(spark, hand_raw):
    from journeyline.sources.raw_sessions import shard_range
    out = tempfile.mkdtemp(prefix="jl-build-", dir="/tmp")
    built = build_project(spark, shard_range(hand_raw, "20170701", "20170731"), out,
                          dt.date(2017, 7, 1), dt.date(2017, 7, 31))
    assert built["stg_ga_sessions"].count() == 14
    assert os.path.isdir(os.path.join(out, "staging", "stg_ga_sessions"))
    for name in ["mart_campaign_performance", "mart_attribution_analysis", "mart_conversion_funnel"]:
        assert built[name].count() == 13
        assert "last_updated" in built[name].columns
    report = built["test_report"]
    assert report.count() == 23 + 41 + 37 + 54
    assert report.where(F.col("status") == "fail").count() >= 1  # the non-nested funnel (T11)


def test_tests_are_counted_by_the_writes(spark, hand_raw, monkeypatch):
    """The build's report equals run_checks over the stored tables, which the build itself never calls; failing rows are stored."""
    from journeyline.operators import quality
    from journeyline.sources.raw_sessions import shard_range
    raw = shard_range(hand_raw, "20170701", "20170731").withColumn("fullVisitorId", F.when(F.col("fullVisitorId") != "H", F.col("fullVisitorId")))
    dates = (dt.date(2017, 7, 2), dt.date(2017, 7, 31))  # the first day's rows fail
    with monkeypatch.context() as m:
        m.setattr(quality, "run_checks", None)
        built = build_project(spark, raw, tempfile.mkdtemp(prefix="jl-obs-", dir="/tmp"), *dates)
    got = {(r.model, r.test, r.column_name): (r.failures, r.status) for r in built["test_report"].collect()}
    want, per_test = {}, {}
    for name, checks in [("stg_ga_sessions", quality.staging_tests(*dates)), ("mart_campaign_performance", quality.CAMPAIGN_TESTS),
                         ("mart_attribution_analysis", quality.ATTRIBUTION_TESTS), ("mart_conversion_funnel", quality.FUNNEL_TESTS)]:
        want.update({(r.model, r.test, r.column_name): (r.failures, r.status) for r in quality.run_checks(built[name], name, checks).collect()})
    assert built["test_report"].count() == 155 and got == want
    assert got["stg_ga_sessions", "not_null", "visitor_id"] == (1, "fail")
    for r in built["failing_rows"].groupBy("model", "test", "column_name").count().collect():
        per_test[r["model"], r["test"], r["column_name"]] = r["count"]
    assert per_test == {k: n for k, (n, _) in want.items() if n and k[1] != "unique"}


def test_materializations(spark):
    df = spark.range(3).withColumnRenamed("id", "x")
    assert sinks.materialization("example") == "view"
    assert sinks.materialization("example", "table") == "table"
    assert sinks.materialization("marts") == "table"
    sinks.write_model(spark, df, "jl_view_probe", "example", "/unused", materialized="view")
    assert spark.table("jl_view_probe").count() == 3


def test_staged_table_has_one_layout(spark, hand_raw):
    """By date, whatever the visitors; read back, it has the columns and types of the schema."""
    from journeyline.schemas import STG_SESSIONS
    from journeyline.sources.raw_sessions import shard_range
    raw = shard_range(hand_raw, "20170701", "20170731")
    out = tempfile.mkdtemp(prefix="jl-b-", dir="/tmp")
    built = build_project(spark, raw, out, dt.date(2017, 7, 1), dt.date(2017, 7, 31), run_tests=False)
    assert os.path.isdir(os.path.join(out, "staging", "stg_ga_sessions", "session_date=2017-07-01"))
    stored = built["stg_ga_sessions"]
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in STG_SESSIONS]
    from journeyline.operators.staging import stg_sessions
    assert stored.exceptAll(stg_sessions(raw)).count() == 0


def test_command_line_build(spark, hand_raw):
    from journeyline.__main__ import main
    from journeyline.sources.raw_sessions import write_sessions
    root = tempfile.mkdtemp(prefix="jl-cli-", dir="/tmp")
    write_sessions(hand_raw, os.path.join(root, "raw"))
    main(["--raw", os.path.join(root, "raw"), "--out", os.path.join(root, "out"),
          "--start", "20170701", "--end", "20170731"])
    report = spark.read.parquet(os.path.join(root, "out", "quality", "test_report"))
    assert report.count() == 155
    assert spark.read.parquet(os.path.join(root, "out", "funnel", "mart_conversion_funnel")).count() == 13
