"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs its whole plan into Spark's ``noop`` sink (nothing is collected to the
driver). An untimed warm-up runs every headline query once on the smallest data set (no
data of the measured set is touched), so JVM class loading and code generation for each
query shape are not timed. Queries then run once each on $BENCH_SF_DIR, in model
order, like one build of the project: ``stg_sessions`` materializes the staged table that
every later query reads (persisted once per session); intermediate models are computed from
it on every call; each ``mart_*`` query builds and persists its mart, which the data tests
and dashboards then read (as they read the materialized tables in the reference). Every
piece of work is therefore timed once. The reported time of each query is that single run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from journeyline.plans.queries import QUERIES  # noqa: E402
from journeyline.session import get_spark  # noqa: E402

HEADLINE = [
    "stg_sessions",
    "int_campaign_metrics",
    "mart_campaign_performance",
    "int_session_attribution",
    "mart_attribution_analysis",
    "int_funnel_steps",
    "mart_conversion_funnel",
    "dq_staging",
    "dq_campaign",
    "dq_attribution",
    "dq_funnel",
    "dash_campaign_kpis",
    "dash_attribution_by_channel",
    "dash_dropoff_table",
    "metric_new_vs_returning",
    "metric_assisted_conversions",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", app_name="journeyline-bench", shuffle_partitions=cpus,
                      extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    # Untimed warm-up on the smallest data set: JVM class loading and code generation only.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in HEADLINE:
            run(spark, name, warm_dir)
    timings = {name: round(run(spark, name, sf_dir), 3) for name in HEADLINE}
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus,
                      "shuffle_partitions": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
