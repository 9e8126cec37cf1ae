"""Declarative data tests (Q1-Q6) evaluated as Spark aggregations.

A test counts failing rows; NULL passes every test except ``not_null``:

* ``unique``               non-NULL values that occur more than once (one failure per value);
* ``not_null``             NULL values;
* ``accepted_values``      values outside a list;
* ``accepted_range``       values outside [min, max] (either bound optional, inclusive),
                           optionally only on rows matching a ``where`` scope;
* ``expression_is_true``   rows where a SQL boolean expression is false.

All tests of a model except ``unique`` run in one aggregation pass (one ``count_if`` per
test over a SQL predicate, partial aggregation on every partition); each ``unique`` test is
one ``groupBy`` with map-side partial counts. The report has one row per test:
``model, test, column_name, failures, severity, status``. ``severity='warn'`` tests are
reported as ``warn`` instead of ``fail``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    test: str
    column: str | None = None
    values: tuple = ()
    min_value: object = None
    max_value: object = None
    where: str | None = None
    expression: str | None = None
    severity: str = "error"

    @property
    def target(self) -> str:
        return self.expression if self.test == "expression_is_true" else self.column


def not_null(c):
    return Check("not_null", c)


def unique(c):
    return Check("unique", c)


def accepted_values(c, values):
    return Check("accepted_values", c, values=tuple(values))


def accepted_range(c, min_value=None, max_value=None, where=None):
    return Check("accepted_range", c, min_value=min_value, max_value=max_value, where=where)


def expression_is_true(expr, severity="error"):
    return Check("expression_is_true", expression=expr, severity=severity)


# ---- the reference's test suites (fixed values) ------------------------------------------
DEVICES = ["desktop", "mobile", "tablet"]
CHANNELS = ["Organic Search", "Paid Search", "Direct", "Referral", "Social", "Email", "Display", "Other"]
DROPOFF_STAGES = ["Landing", "Engagement", "Deep Engagement", "Multiple"]


def staging_tests(first_date: dt.date = dt.date(2017, 7, 1), last_date: dt.date = dt.date(2017, 7, 31)):
    """23 tests; the session_date range is the shard range (the reference's July 2017 by default)."""
    return [
        unique("session_id"), not_null("session_id"),
        not_null("visitor_id"),
        not_null("visit_id"),
        not_null("session_date"), accepted_range("session_date", first_date, last_date),
        not_null("session_start_timestamp"),
        not_null("traffic_source"),
        not_null("traffic_medium"),
        not_null("visits"),
        not_null("hits"), accepted_range("hits", 0),
        accepted_range("time_on_site_seconds", 0),
        not_null("browser"),
        not_null("device_category"), accepted_values("device_category", DEVICES),
        not_null("operating_system"),
        not_null("country"),
        not_null("is_bounced"), accepted_values("is_bounced", [0, 1]),
        not_null("is_converted"), accepted_values("is_converted", [0, 1]),
        accepted_range("revenue_usd", 0),
    ]


CAMPAIGN_TESTS = [
    not_null("traffic_source"),
    not_null("traffic_medium"),
    not_null("channel_grouping"), accepted_values("channel_grouping", CHANNELS),
    not_null("device_category"), accepted_values("device_category", DEVICES),
    not_null("total_sessions"), accepted_range("total_sessions", 1),
    not_null("total_unique_visitors"), accepted_range("total_unique_visitors", 1),
    not_null("total_pageviews"), accepted_range("total_pageviews", 0),
    not_null("total_bounces"), accepted_range("total_bounces", 0),
    not_null("total_conversions"), accepted_range("total_conversions", 0),
    not_null("total_revenue"), accepted_range("total_revenue", 0),
    not_null("revenue_per_session"), accepted_range("revenue_per_session", 0),
    accepted_range("revenue_per_conversion", 0, where="total_conversions > 0"),
    not_null("sessions_per_visitor"), accepted_range("sessions_per_visitor", 1),
    not_null("conversion_rate_pct"), accepted_range("conversion_rate_pct", 0, 100),
    not_null("bounce_rate_pct"), accepted_range("bounce_rate_pct", 0, 100),
    not_null("avg_time_on_site_sec"), accepted_range("avg_time_on_site_sec", 0),
    not_null("avg_pageviews_per_session"), accepted_range("avg_pageviews_per_session", 0),
    not_null("engagement_quality_score"), accepted_range("engagement_quality_score", 0, 100),
    not_null("estimated_cost"), accepted_range("estimated_cost", 0),
    accepted_range("roas", 0, where="estimated_cost > 0"),
    accepted_range("cac", 0, where="total_conversions > 0"),
    expression_is_true("total_revenue >= 0"),
    expression_is_true("total_conversions <= total_sessions"),
    expression_is_true("total_unique_visitors <= total_sessions"),
    expression_is_true("total_bounces <= total_sessions"),
]

ATTRIBUTION_TESTS = [
    not_null("traffic_source"),
    not_null("traffic_medium"),
    not_null("channel_grouping"),
    not_null("channel_role"),
    not_null("journey_complexity"),
    not_null("total_sessions"), accepted_range("total_sessions", 1),
    not_null("total_visitors"), accepted_range("total_visitors", 1),
    not_null("avg_sessions_per_visitor"), accepted_range("avg_sessions_per_visitor", 1),
    not_null("avg_session_position_in_journey"), accepted_range("avg_session_position_in_journey", 1),
    not_null("first_touch_sessions"), accepted_range("first_touch_sessions", 0),
    not_null("first_touch_conversions"), accepted_range("first_touch_conversions", 0),
    not_null("first_touch_revenue"), accepted_range("first_touch_revenue", 0),
    accepted_range("first_touch_revenue_per_session", 0, where="first_touch_conversions > 0"),
    not_null("last_touch_sessions"), accepted_range("last_touch_sessions", 0),
    not_null("last_touch_conversions"), accepted_range("last_touch_conversions", 0),
    not_null("last_touch_revenue"), accepted_range("last_touch_revenue", 0),
    accepted_range("last_touch_revenue_per_session", 0, where="last_touch_conversions > 0"),
    not_null("linear_conversions"), accepted_range("linear_conversions", 0),
    not_null("linear_attribution_revenue"), accepted_range("linear_attribution_revenue", 0),
    not_null("linear_revenue_per_session"), accepted_range("linear_revenue_per_session", 0),
    expression_is_true("first_touch_sessions <= total_sessions"),
    expression_is_true("last_touch_sessions <= total_sessions"),
    expression_is_true("total_visitors <= total_sessions"),
    expression_is_true("first_touch_revenue >= 0 AND last_touch_revenue >= 0 AND linear_attribution_revenue >= 0"),
]

FUNNEL_TESTS = [
    not_null("traffic_source"),
    not_null("traffic_medium"),
    not_null("channel_grouping"),
    not_null("device_category"), accepted_values("device_category", DEVICES),
    not_null("country"),
    not_null("sessions_landing"), accepted_range("sessions_landing", 1),
    not_null("sessions_engagement"), accepted_range("sessions_engagement", 0),
    not_null("sessions_deep_engagement"), accepted_range("sessions_deep_engagement", 0),
    not_null("sessions_conversion"), accepted_range("sessions_conversion", 0),
    not_null("visitors_landing"), accepted_range("visitors_landing", 1),
    not_null("visitors_converted"), accepted_range("visitors_converted", 0),
    accepted_range("landing_to_engagement_rate", 0, 1, where="sessions_landing > 0"),
    accepted_range("engagement_to_deep_rate", 0, 1, where="sessions_engagement > 0"),
    accepted_range("deep_to_conversion_rate", 0, 1, where="sessions_deep_engagement > 0"),
    accepted_range("overall_conversion_rate", 0, 1, where="sessions_landing > 0"),
    accepted_range("visitor_conversion_rate", 0, 1, where="visitors_landing > 0"),
    accepted_range("dropoff_after_landing_pct", 0, 1, where="sessions_landing > 0"),
    accepted_range("dropoff_after_engagement_pct", 0, 1, where="sessions_engagement > 0"),
    accepted_range("dropoff_after_deep_pct", 0, 1, where="sessions_deep_engagement > 0"),
    not_null("primary_dropoff_stage"), accepted_values("primary_dropoff_stage", DROPOFF_STAGES),
    not_null("exits_at_landing"), accepted_range("exits_at_landing", 0),
    not_null("exits_after_landing"), accepted_range("exits_after_landing", 0),
    not_null("exits_at_engagement"), accepted_range("exits_at_engagement", 0),
    not_null("exits_at_deep_engagement"), accepted_range("exits_at_deep_engagement", 0),
    not_null("exits_converted"), accepted_range("exits_converted", 0),
    accepted_range("avg_engagement_score", 0, 100, where="sessions_landing > 0"),
    not_null("avg_visitor_engagement_score"), accepted_range("avg_visitor_engagement_score", 0, 100),
    not_null("avg_visitor_days_active"), accepted_range("avg_visitor_days_active", 0),
    not_null("total_revenue"), accepted_range("total_revenue", 0),
    accepted_range("revenue_per_visitor_conversion", 0, where="visitors_converted > 0"),
    accepted_range("revenue_per_conversion", 0, where="sessions_conversion > 0"),
    not_null("revenue_per_landing"), accepted_range("revenue_per_landing", 0),
    accepted_range("funnel_health_score", 0, 100, where="sessions_landing > 0"),
    expression_is_true("sessions_landing >= sessions_engagement"),
    expression_is_true("sessions_engagement >= sessions_deep_engagement"),
    expression_is_true("sessions_deep_engagement >= sessions_conversion"),
    expression_is_true("ABS(overall_conversion_rate - (sessions_conversion / NULLIF(sessions_landing, 0))) < 0.001",
                       severity="warn"),
]

EXAMPLE_TESTS = [unique("id"), not_null("id")]


# ---- evaluation ---------------------------------------------------------------------------
def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, dt.date):
        return f"DATE'{v.isoformat()}'"
    return repr(v)


def failure_sql(check: Check) -> str:
    """Spark SQL predicate that is true exactly on failing rows (NULL counts as passing)."""
    if check.test == "not_null":
        return f"{_ident(check.column)} IS NULL"
    if check.test == "accepted_values":
        return f"NOT ({_ident(check.column)} IN ({', '.join(_literal(v) for v in check.values)}))"
    if check.test == "accepted_range":
        bounds = []
        if check.min_value is not None:
            bounds.append(f"{_ident(check.column)} >= {_literal(check.min_value)}")
        if check.max_value is not None:
            bounds.append(f"{_ident(check.column)} <= {_literal(check.max_value)}")
        cond = f"NOT ({' AND '.join(bounds)})"
        return f"({check.where}) AND {cond}" if check.where else cond
    if check.test == "expression_is_true":
        return f"NOT ({check.expression})"
    raise ValueError(f"not a row-level test: {check.test}")


REPORT_SCHEMA = "model STRING, test STRING, column_name STRING, failures BIGINT, severity STRING, status STRING"


def row_failures(checks: list[Check]) -> list[Column]:
    """One ``count_if`` for each row-level test, named by its place in ``checks``: for ``select`` or ``observe``."""
    return [F.expr(f"count_if({failure_sql(c)})").alias(f"_t{i}") for i, c in enumerate(checks) if c.test != "unique"]


def _duplicates(df: DataFrame, check: Check) -> DataFrame:
    """One row: values of the column that occur more than once."""
    return (df.where(F.col(check.column).isNotNull()).groupBy(check.column).count()
            .where(F.col("count") > 1).agg(F.count(F.lit(1)).alias("failures")))


def observed_report(stored: DataFrame, model: str, checks: list[Check], failures: dict[str, int]) -> DataFrame:
    """The report of a table whose row-level tests were counted while it was written (``failures``: the observed
    ``row_failures``). Only uniqueness, which no single row shows, reads the stored table."""
    rows = []
    for i, c in enumerate(checks):
        n = _duplicates(stored, c).first()[0] if c.test == "unique" else int(failures.get(f"_t{i}") or 0)
        rows.append((model, c.test, c.target, n, c.severity, "pass" if n == 0 else "warn" if c.severity == "warn" else "fail"))
    return stored.sparkSession.createDataFrame(rows, REPORT_SCHEMA)


def failing_rows(df: DataFrame, model: str, checks: list[Check]) -> DataFrame:
    """The rows that fail row-level tests, once for each test they fail: ``model``, ``test``, ``column_name`` and the row as JSON."""
    named = [F.when(F.expr(failure_sql(c)), F.struct(F.lit(c.test).alias("test"), F.lit(c.target).alias("column_name")))
             for c in checks if c.test != "unique"]
    failed = df.select(F.to_json(F.struct(*df.columns)).alias("row"), F.explode(F.array_compact(F.array(*named))).alias("_f"))
    return failed.select(F.lit(model).alias("model"), "_f.test", "_f.column_name", "row")


def run_checks(df: DataFrame, model: str, checks: list[Check]) -> DataFrame:
    """The test report of one relation (one row per test).

    The tests are SQL predicates, so the whole pass is one ``select`` of ``count_if``
    aggregates; ``stack`` turns its single row into one row per test, and the test
    descriptions (one small row per test) are joined on by broadcast."""
    spark = df.sparkSession
    parts = []
    row_checks = [i for i, c in enumerate(checks) if c.test != "unique"]
    if row_checks:
        counts = df.select(*row_failures(checks))
        pairs = ", ".join(f"{i}, _t{i}" for i in row_checks)
        parts.append(counts.selectExpr(f"stack({len(row_checks)}, {pairs}) AS (_idx, failures)"))
    for i, c in enumerate(checks):
        if c.test == "unique":
            parts.append(_duplicates(df, c).select(F.lit(i).alias("_idx"), "failures"))
    counts_by_test = parts[0]
    for p in parts[1:]:
        counts_by_test = counts_by_test.unionByName(p)
    described = spark.createDataFrame([(i, model, c.test, c.target, c.severity) for i, c in enumerate(checks)],
                                      "_idx INT, model STRING, test STRING, column_name STRING, severity STRING")
    report = counts_by_test.join(F.broadcast(described), "_idx")
    status = (F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail"))
    return report.select("model", "test", "column_name", F.col("failures").cast("bigint").alias("failures"),
                         "severity", status.alias("status"))
