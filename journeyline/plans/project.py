"""Build every model of the project in one Spark application (the analog of a full run).

Order: staged sessions -> the three marts -> data-test reports. The staged table is
written once into the shared checkpoint folder (a stored table cuts the lineage, so a lost
executor only recomputes from the stored files) and every mart reads it back; each mart is
a full-rebuild table with a build stamp. The data tests are counted by the writes (``DataFrame.observe``), so no table is
scanned for them but for uniqueness; rows that fail are stored by model and test.

The staged table is partitioned by ``session_date`` in every build: a refresh replaces days, readers prune days, and
per-visitor work doesn't depend on how rows are stored (operators/per_key.py).
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..operators import attribution, campaign, funnel, quality
from ..operators.staging import stg_sessions
from ..schemas import STG_SESSIONS
from ..session import checkpoint_dir


def default_output(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/journeyline/build-{int(time.time() * 1000)}"


def build_project(spark: SparkSession, raw: DataFrame, out_dir: str | None = None,
                  first_date: dt.date = dt.date(2017, 7, 1), last_date: dt.date = dt.date(2017, 7, 31),
                  run_tests: bool = True) -> dict[str, DataFrame]:
    """Materialise staging, the marts and (optionally) the test reports; return them read back."""
    out = out_dir or default_output(spark)
    built, reports = {}, []

    def write(name: str, domain: str, df: DataFrame, checks: list, **layout) -> DataFrame:
        """Write a model; its row-level tests are counted by the write itself."""
        seen = Observation(f"{name}-tests")
        table = sinks.write_model(spark, df, name, domain, out, observe=(seen, quality.row_failures(checks)) if run_tests else None, **layout)
        if run_tests:
            reports.append((name, checks, table, seen.get))
        return table

    stg = write("stg_ga_sessions", "staging", stg_sessions(raw), quality.staging_tests(first_date, last_date),
                stamp=False, partition_by=["session_date"])
    stg = stg.withColumn("session_date", F.col("session_date").cast("date")).select(*STG_SESSIONS.fieldNames())
    built["stg_ga_sessions"] = stg
    for name, domain, df, checks in [
            ("mart_campaign_performance", "campaign_performance", campaign.mart_campaign_performance(stg), quality.CAMPAIGN_TESTS),
            ("mart_attribution_analysis", "attribution", attribution.mart_attribution_analysis(stg), quality.ATTRIBUTION_TESTS),
            ("mart_conversion_funnel", "funnel", funnel.mart_conversion_funnel(stg), quality.FUNNEL_TESTS)]:
        built[name] = write(name, domain, df, checks)
    if run_tests:
        report, failed = None, None
        for name, checks, table, failures in reports:
            one = quality.observed_report(table, name, checks, failures)
            report = one if report is None else report.unionByName(one)
            if any(failures.values()):  # only then are the rows read again
                rows = quality.failing_rows(built[name], name, checks)
                failed = rows if failed is None else failed.unionByName(rows)
        built["test_report"] = sinks.write_model(spark, report.coalesce(1), "test_report", "quality", out)
        if failed is not None:
            built["failing_rows"] = sinks.write_model(spark, failed, "failing_rows", "quality", out, partition_by=["model", "test"])
    return built
