"""Data tests: suite sizes, NULL semantics, scoped ranges, severity and known failures."""

import datetime as dt

from pyspark.sql import functions as F

from journeyline.operators import funnel, quality
from journeyline.operators.examples import first_example, second_example


def test_suite_sizes_match_the_reference():
    assert len(quality.staging_tests()) == 23
    assert len(quality.CAMPAIGN_TESTS) == 41
    assert len(quality.ATTRIBUTION_TESTS) == 37
    assert len(quality.FUNNEL_TESTS) == 54


def test_staging_suite_passes_on_fixture(hand_stg):
    report = quality.run_checks(hand_stg, "stg_ga_sessions", quality.staging_tests(dt.date(2017, 7, 1),
                                                                                  dt.date(2017, 7, 31)))
    assert report.count() == 23
    assert report.where("status != 'pass'").count() == 0


def test_funnel_suite_reports_non_nested_funnel(hand_stg):
    mart = funnel.mart_conversion_funnel(hand_stg)
    rows = {(r["test"], r["column_name"]): r for r in
            quality.run_checks(mart, "mart_conversion_funnel", quality.FUNNEL_TESTS).collect()}
    deep = rows[("expression_is_true", "sessions_deep_engagement >= sessions_conversion")]
    assert deep["failures"] == 3 and deep["status"] == "fail"  # converted without deep engagement
    warn = [r for k, r in rows.items() if r["severity"] == "warn"]
    assert len(warn) == 1 and warn[0]["status"] in ("pass", "warn")


def test_null_passes_everything_but_not_null(spark):
    df = spark.createDataFrame([(1, "a"), (None, None), (5, "z")], "x int, s string")
    checks = [quality.not_null("x"), quality.unique("x"), quality.accepted_values("s", ["a", "b"]),
              quality.accepted_range("x", 0, 3), quality.accepted_range("x", 0, 3, where="x > 4"),
              quality.expression_is_true("x < 3")]
    got = {(r["test"], r["column_name"], r["failures"]) for r in quality.run_checks(df, "t", checks).collect()}
    assert ("not_null", "x", 1) in got and ("unique", "x", 0) in got
    assert ("accepted_values", "s", 1) in got  # 'z' fails, NULL passes
    assert ("accepted_range", "x", 1) in got  # 5 fails (both range tests: one scoped to x > 4)
    assert ("expression_is_true", "x < 3", 1) in got


def test_example_models(spark):
    first = first_example(spark)
    second = second_example(first)
    assert sorted(first.collect(), key=lambda r: (r.id is None, r.id)) == [(1,), (None,)]
    assert second.collect() == [(1,)]
    r1 = {r["test"]: r["failures"] for r in quality.run_checks(first, "first", quality.EXAMPLE_TESTS).collect()}
    r2 = {r["test"]: r["failures"] for r in quality.run_checks(second, "second", quality.EXAMPLE_TESTS).collect()}
    assert r1 == {"unique": 0, "not_null": 1} and r2 == {"unique": 0, "not_null": 0}
    assert first.where(F.col("id").isNull()).count() == 1
