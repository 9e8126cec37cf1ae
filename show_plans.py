"""Print condensed physical plans of the three marts (run after a query, so AQE's final plan).

Usage: python show_plans.py [sf_dir]

The staged table is built from the adapter and stored by date in a fresh scratch folder, as build_project does.
For each mart the script prints the operators that decide the cost: exchanges, joins,
aggregations, windows and scans (projections, filters and sorts are left out).
"""

from __future__ import annotations

import re
import sys
import tempfile

from pyspark.sql import functions as F

from journeyline import sinks
from journeyline.operators import attribution, campaign, funnel
from journeyline.operators.staging import stg_sessions
from journeyline.session import get_spark
from journeyline.sources.events_adapter import load_raw_sessions

SKIP = {"Project", "Filter", "ColumnarToRow", "AdaptiveSparkPlan", "ShuffleQueryStage", "BroadcastQueryStage",
        "AQEShuffleRead", "WholeStageCodegen", "InputAdapter", "Sort", "ReusedExchange", "TableCacheQueryStage"}


def condensed(df) -> list[str]:
    df.write.format("noop").mode("overwrite").save()
    out = []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        m = re.search(r"(\*\(\d+\) )?([A-Z]\w+)(.*)", line)
        if not m or m.group(2) in SKIP:
            continue
        detail = re.sub(r"#\d+L?", "", m.group(3))
        if m.group(2) in ("HashAggregate", "SortAggregate"):
            detail = re.sub(r", functions=.*", ")", detail)
        if m.group(2) == "FileScan":
            detail = " parquet " + " ".join(re.findall(r"(Bucketed: \w+|PartitionFilters: \[[^\]]*\])", detail))
        if m.group(2) == "Exchange":
            detail = re.sub(r", ENSURE_REQUIREMENTS.*", "", detail)
        out.append(" " * (line.index(m.group(2)) // 3) + m.group(2) + detail[:110])
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    base = tempfile.mkdtemp(prefix="jl-plans-", dir="/tmp")
    staged = stg_sessions(load_raw_sessions(spark, sf_dir))
    stg = sinks.write_model(spark, staged, "stg_ga_sessions", "staging", base, stamp=False, partition_by=["session_date"])
    stg = stg.withColumn("session_date", F.col("session_date").cast("date"))
    for name, build in [("mart_campaign_performance", campaign.mart_campaign_performance),
                        ("mart_attribution_analysis", attribution.mart_attribution_analysis),
                        ("mart_conversion_funnel", funnel.mart_conversion_funnel)]:
        lines = condensed(build(stg))
        print(f"### {name} ({sum('Exchange hashpartitioning' in x for x in lines)} shuffle exchanges)\n")
        print("```\n" + "\n".join(lines) + "\n```\n")


if __name__ == "__main__":
    main(sys.argv)
